"""Removal of equal and of similar rows."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.clean import comparable_line, dedup_key
from corpusloom.session import cut, stored


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_longest(df: DataFrame, code: str, description: str, position: str) -> DataFrame:
    """Of rows whose code is equal up to case and spacing the one with the longest description, at equal lengths the first.
    An aggregation with map-side combine, so that a third of all rows under one key is no burden; null codes are one key."""
    best = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct((-F.coalesce(F.length(description), F.lit(0))).alias("n"), F.col(position).alias("p")))
    return df.groupBy(F.xxhash64(dedup_key(code)).alias("__h"), F.md5(dedup_key(code)).alias("__k")).agg(best.alias("__row")).select("__row.*")


def latest_by(df: DataFrame, key: str, position: str) -> DataFrame:
    """Of rows with the same key the one with the highest position."""
    return df.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.col(position)).alias("__row")).select("__row.*")


def _alike(m: difflib.SequenceMatcher, most: float) -> bool:
    return m.real_quick_ratio() >= most and m.quick_ratio() >= most and m.ratio() >= most


def keep_dissimilar(df: DataFrame, group: str, position: str, code: str, most: float = 0.85, small: int = 200) -> DataFrame:
    """Within each group, in order of position, the rows whose code's matching-blocks ratio to every row kept before is below
    ``most``; null is a group too. Groups of up to ``small`` rows go to one task each. Of larger ones equal codes are one, pairs
    are compared by many tasks, ``small`` codes with the group at a time, and rounds over the pairs found tell what is kept: the
    same rows, but in time that grows with the square of the group. For whole tables see the near-duplicate operator."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(position, kind="stable")
        kept: list[str] = []
        keep = []
        m = difflib.SequenceMatcher(None)
        for text in pdf["__t"]:
            m.set_seq2(text)
            similar = False
            for k in kept:
                m.set_seq1(k)
                if _alike(m, most):
                    similar = True
                    break
            keep.append(not similar)
            if not similar:
                kept.append(text)
        return pdf.loc[keep, columns]

    large = df.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("__n")).where(F.col("__n") > small)
    columns = df.columns
    few = df.join(large, F.col(group).eqNullSafe(F.col("__g")), "left_anti").withColumn("__t", comparable_line(F.col(code).cast("string"))).groupBy(group).applyInPandas(run, df.schema)
    return few.unionByName(_dissimilar_of_large(df.join(large, F.col(group).eqNullSafe(F.col("__g"))), df.columns, position, code, most, small))


def _dissimilar_of_large(rows: DataFrame, columns: list[str], position: str, code: str, most: float, block: int) -> DataFrame:
    """``rows`` have their group as __g and its size as __n."""

    @F.pandas_udf(T.BooleanType())
    def alike(earlier: pd.Series, later: pd.Series) -> pd.Series:
        m, out, last = difflib.SequenceMatcher(None), [], None
        for a, b in zip(earlier, later):
            if b != last:
                m.set_seq2(b)
                last = b
            m.set_seq1(a)
            out.append(_alike(m, most))
        return pd.Series(out, dtype=bool)

    order = F.struct(F.col(position).isNull().alias("no"), F.col(position).alias("at"), F.col("__t").alias("t"))
    row = F.struct(*[F.col(c) for c in columns])
    texts = rows.withColumn("__t", comparable_line(F.col(code).cast("string"))).groupBy("__g", "__t").agg(F.min(order).alias("o"), F.min_by(row, order).alias("row"), F.first("__n").alias("n"))
    texts = stored(texts.withColumn("id", F.md5(F.concat(F.to_json(F.struct("__g")), F.lit("\n"), "__t"))), "texts")

    # Each text is in one block of its group and meets the earlier ones of the whole group there.
    blocks = F.ceil(F.col("n") / block).cast("int")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number, as few bytes are long work here
    key = F.concat_ws("/", "salt", F.to_json(F.struct("__g")))
    side = lambda s, salt: texts.withColumn("salt", salt).select(key.alias(f"k{s}"), F.col("id").alias(f"id{s}"), F.col("o").alias(f"o{s}"), F.col("__t").alias(f"t{s}")).repartition(parts, f"k{s}")
    b, a = side("b", F.pmod(F.xxhash64("id"), blocks).cast("int")), side("a", F.explode(F.sequence(F.lit(0), blocks - 1)))
    x, y = F.length("ta"), F.length("tb")
    near = F.least(x, y) * 2 >= (x + y) * F.lit(most - 1e-9)  # a bound on the ratio
    met = b.join(a, (F.col("kb") == F.col("ka")) & (F.col("oa") < F.col("ob")) & near)
    edges = cut(met.where(alike("ta", "tb")).select(F.col("ida").alias("a"), F.col("idb").alias("b")))

    # What no undecided row precedes is kept, and what is like it dropped, until no pair is left.
    dropped = texts.select("id").limit(0)
    while not edges.isEmpty():
        now = cut(edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti").select(F.col("b").alias("id")).distinct())
        dropped = cut(dropped.union(now))
        edges = cut(edges.join(now.withColumnRenamed("id", "a"), "a", "left_anti").join(now.withColumnRenamed("id", "b"), "b", "left_anti").select("a", "b"))
    return texts.join(dropped, "id", "left_anti").select("row.*")


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order, by a window; for small groups."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")

