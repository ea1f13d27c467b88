"""Unions, mixing by ratio, exact splits and samples. Random order is the order of ``md5(seed | key)``: the same on every
engine and however the rows lie."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def united(*dfs: DataFrame) -> DataFrame:
    """All rows, columns by name, missing ones null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows that are drawn first (all if there are fewer). Every task sends its first n at most; for large n see
    ``exact_fraction``."""
    return df.orderBy(draw(key, seed), key).limit(n)


def _position(df: DataFrame, key: str, seed: int, rows: int, per_range: int = 100_000) -> DataFrame:
    """Rows with ``__at``, their 1-based place in the drawn order. The leading digits of the draw part the rows into ranges whose
    sizes are added up first, so that no task orders more than a range: as many ranges as ``rows`` (their number) ask for."""
    drawn = df.withColumn("__draw", draw(key, seed))
    digits = max(1, math.ceil(math.log(max(1, rows / per_range), 16)))
    drawn = drawn.withColumn("__range", F.substring("__draw", 1, digits))
    sizes = drawn.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)))  # over at most 16^digits rows
    w = Window.partitionBy("__range").orderBy("__draw", key)
    placed = drawn.withColumn("__in", F.row_number().over(w)).join(F.broadcast(before.select("__range", "__before")), "__range")
    return placed.withColumn("__at", F.coalesce("__before", F.lit(0)) + F.col("__in"))


def exact_split(df: DataFrame, key: str, ratio: float, seed: int = 42, name: str = "part", first: str = "train", second: str = "test") -> DataFrame:
    """Exactly ``floor(n * ratio)`` rows are ``first``, the others ``second``."""
    total = df.count()
    head = int(total * ratio)
    placed = _position(df, key, seed, total)
    return placed.select(*df.columns, F.when(F.col("__at") <= head, first).otherwise(second).alias(name))


def train_val_split(df: DataFrame, key: str, ratio: float | None = None, seed: int = 42) -> DataFrame:
    """As ``exact_split`` with validation rows; without a ratio 0.9 for fewer than ten rows, else 0.8. Up to five rows give
    exactly one to validation; fewer than two are an error."""
    n = df.count()
    if n < 2:
        raise ValueError("a split needs two rows")
    ratio = (0.9 if n < 10 else 0.8) if ratio is None else ratio
    if n <= 5:
        ratio = (n - 1) / n + 1e-9
    return exact_split(df, key, ratio, seed, "part", "train", "val")


def mix(a: DataFrame, b: DataFrame, key: str, share: float, seed: int = 42, tags: tuple[str, str] = ("a", "b")) -> DataFrame:
    """All rows of ``a`` and as many drawn rows of ``b`` as make ``a`` the given share of the whole, all of ``b`` if there are
    too few; tagged in ``origin``. A share of 1 takes no ``b``, of 0 no ``a`` and all of ``b``."""
    left = a.withColumn("origin", F.lit(tags[0]))
    if share <= 0:
        return b.withColumn("origin", F.lit(tags[1]))
    want = int(a.count() * (1 - share) / share)
    at = _position(b, key, seed, b.count())
    return left.unionByName(at.where(F.col("__at") <= want).select(*b.columns, F.lit(tags[1]).alias("origin")), allowMissingColumns=True)


def mix_stats(mixed: DataFrame, share: float, totals: dict[str, DataFrame], origin: str = "origin") -> DataFrame:
    """(origin, rows, share, wanted_share, available) for each of the two tables of a mix: what it gave, its share of the whole, the share
    asked for, and the rows it has. A table that gave nothing has a row too."""
    rows = None
    for (name, df), wanted in zip(totals.items(), (share, 1 - share)):
        one = df.agg(F.count("*").alias("available")).select(F.lit(name).alias("origin"), F.round(F.lit(wanted), 6).alias("wanted_share"), "available")
        rows = one if rows is None else rows.union(one)
    given = mixed.groupBy(F.col(origin).alias("origin")).agg(F.count("*").alias("rows"))
    counts = rows.join(given, "origin", "left").select("origin", F.coalesce("rows", F.lit(0)).alias("rows"), "wanted_share", "available")
    whole = F.sum("rows").over(Window.partitionBy())  # over two rows
    return counts.select("origin", "rows", F.round(F.coalesce(F.try_divide(F.col("rows"), whole), F.lit(0.0)), 6).alias("share"), "wanted_share", "available")


def removed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    return before.join(after.select(key).distinct(), key, "left_anti")


def assigned_reference(key: str, references: int, seed: int = 42) -> Column:
    """A reproducible pick of one of so many references for each row."""
    return F.pmod(F.conv(F.substring(draw(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(references))
