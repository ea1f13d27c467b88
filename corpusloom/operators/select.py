"""Order, limits, top-k and best-of selection, with ties broken by a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import _c


def sorted_by(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Ascending, nulls last; an unknown column is an error."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to sort by")
    return df.orderBy(F.col(column).asc_nulls_last(), *ties)


def top_k(df: DataFrame, score: Column | str, key: str, k: int) -> DataFrame:
    return df.orderBy(_c(score).desc_nulls_last(), key).limit(k)


def top_k_then(df: DataFrame, score: Column | str, key: str, k: int, condition: Column) -> DataFrame:
    """Of the top k those that fulfil a condition, so perhaps fewer than k."""
    return top_k(df, score, key, k).where(condition)


def top_k_per_group(df: DataFrame, group: str, score: Column | str, key: str, k: int, rank: str = "rank") -> DataFrame:
    """The best k of each group. A window with a limit on its rank, which is pushed below the shuffle, so that hot groups
    send k rows from each task."""
    w = Window.partitionBy(group).orderBy(_c(score).desc_nulls_last(), key)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def best_of(df: DataFrame, group: str, score: str, order: str) -> DataFrame:
    """Each group's row with the highest score, the first of equal ones; an aggregation."""
    best = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct((-F.col(score)).alias("s"), F.col(order).alias("o")))
    return df.where(F.col(score).isNotNull()).groupBy(F.col(group).alias("__g")).agg(best.alias("__r")).select("__r.*")


def ranks_between(df: DataFrame, score: Column | str, key: str, first: int, last: int, rank: str = "rank") -> DataFrame:
    """Rows of rank first to last (1-based) by score. Only the top ``last`` rows are ordered globally."""
    top = top_k(df, score, key, last)
    w = Window.orderBy(_c(score).desc_nulls_last(), key)  # over at most ``last`` rows
    return top.withColumn(rank, F.row_number().over(w)).where(F.col(rank) >= first)


def first_n(df: DataFrame, position: str, n: int) -> DataFrame:
    return df.orderBy(position).limit(n)


def last_n(df: DataFrame, position: str, n: int) -> DataFrame:
    """The last n rows, latest first."""
    return df.orderBy(F.col(position).desc()).limit(n)


def best_of_each(df: DataFrame, group: str, order: Sequence[str], score: Column | str, key: str, each: int = 2, most: int = 6) -> DataFrame:
    """The best few of each group, groups in the given order, the first ``most`` of all with their ``place``. A row that is in several
    groups may come several times."""
    place = F.array_position(F.array(*[F.lit(g) for g in order]), F.col(group))
    best = top_k_per_group(df.where(place > 0), group, score, key, each).orderBy(place, "rank").limit(most)
    w = Window.orderBy(place, "rank")  # over at most ``most`` rows
    return best.withColumn("place", F.row_number().over(w)).drop("rank")
