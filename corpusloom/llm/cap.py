"""Capping records per contributor by parallel bisection of each contributor's cutoff score."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import cut, stored

#: A round counts the records above 2^12 midpoints of each contributor together.
CELL_BITS = 12
_LOWEST = -(2**63) + 1


@F.pandas_udf(T.LongType())
def _ordered_bits(score: pd.Series) -> pd.Series:
    """Longs in the order of the doubles; NaN like null."""
    bits = (score.to_numpy(dtype="float64") + 0.0).view(np.int64)
    bits = np.where(bits < 0, np.int64(_LOWEST) - 1 - bits, bits)
    return pd.Series(np.where(score.isna(), _LOWEST, np.maximum(bits, _LOWEST + 1)))


def as_long(df: DataFrame, score: str) -> Column:
    """The score as a long of the same order; null is lowest."""
    if dict(df.dtypes)[score] in ("tinyint", "smallint", "int", "bigint"):
        return F.when(F.col(score).isNotNull(), F.least(F.col(score).cast("long"), F.lit(-_LOWEST - 1))).otherwise(F.lit(_LOWEST))
    return _ordered_bits(F.col(score).cast("double"))


def cutoffs(counts: DataFrame, caps: DataFrame, few: bool = False) -> DataFrame:
    """(who, cut, above): the largest score with at least ``cap`` records at or above it, and the records above it.

    ``counts`` is (who, score, n), ``caps`` (who, cap), each cap at least 1 and at most the contributor's records. A round cuts
    every contributor's interval [lo, hi] into up to 4,096 cells of equal width, a power of two, and counts all records by cell in
    one aggregation with map-side combine; the running sums from the top are the records above every midpoint, and the cell in
    which they reach the cap is the next interval. No contributor's records are ever sorted or gathered. ``few``: the
    contributors are so few that their bounds may be broadcast.
    """
    side = F.broadcast if few else (lambda x: x)
    counts = counts.join(side(caps.select("who")), "who", "left_semi")
    bounds = cut(counts.groupBy("who").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).join(side(caps), "who"))
    top = Window.partitionBy("who").orderBy(F.desc("cell"))  # over at most 4,097 cells
    while not bounds.where("hi > lo").isEmpty():
        wide = bounds.withColumn("s", F.expr(f"greatest(length(bin(lo ^ hi)) - {CELL_BITS}, 0)"))
        cell = F.expr("if(score > hi, shiftright(hi, s) + 1, shiftright(score, s))")
        cells = counts.join(side(wide), "who").where("score >= lo").groupBy("who", "cap", "lo", "hi", "s", cell.alias("cell")).agg(F.sum("n").alias("n"))
        reached = cells.withColumn("upto", F.sum("n").over(top)).where("upto >= cap").groupBy("who", "cap", "lo", "hi", "s").agg(F.max("cell").alias("cell"))
        first = F.expr("shiftleft(cell, s)")
        bounds = cut(reached.select("who", "cap", F.greatest(F.col("lo"), first).alias("lo"), F.least(F.col("hi"), first.bitwiseOR(F.expr("shiftleft(1L, s) - 1"))).alias("hi")))
    cuts = bounds.select("who", F.col("lo").alias("cut"))
    over = counts.join(side(cuts), "who").groupBy("who").agg(F.sum(F.when(F.col("score") > F.col("cut"), F.col("n")).otherwise(0)).alias("above"))
    return cuts.join(over, "who")


def cap_contributors(df: DataFrame, who: str, score: str, record: str, *, max_count: int | None = None, max_share: float | None = None) -> DataFrame:
    """(record, who, kept): whether each record stays when no contributor may have more than ``max_count`` records, or
    more than ``floor(max_share * all records)``, at least 1. The records with the highest score stay, at equal scores those
    with the smallest id; null scores are lowest. Records with a null contributor are always kept; records that share an id
    stay or go together. ``record`` must be an integer; rows with a null id are kept. Other columns are not read.
    """
    if (max_count is None) == (max_share is None):
        raise ValueError("give either max_count or max_share")
    rows = stored(df.select(F.col(record).cast("long").alias("record"), F.col(who).alias("who"), as_long(df, score).alias("score")), "records")
    cap = max(1, max_count if max_count is not None else int(np.floor(max_share * rows.count() + 1e-9)))
    few = max_share is not None and max_share >= 1e-4  # then at most 1 / max_share contributors exceed the cap
    side = F.broadcast if few else (lambda x: x)
    counts = stored(rows.where("who is not null").groupBy("who", "score").agg(F.count("*").alias("n")), "counts")
    caps = cut(counts.groupBy("who").agg(F.sum("n").alias("n")).where(F.col("n") > cap).select("who", F.lit(cap).cast("long").alias("cap")))
    cuts = cut(cutoffs(counts, caps, few))
    edge = cut(rows.join(side(cuts), "who").where("score = cut and record is not null").select("who", (-F.col("record")).alias("score"), F.lit(1).cast("long").alias("n")))
    room = caps.join(cuts, "who").select("who", (F.col("cap") - F.col("above")).alias("cap"))
    ids = cutoffs(edge, room, few)
    # If records share the id at the boundary and don't all fit, none of them stays.
    fit = edge.join(side(ids), "who").groupBy("who").agg(F.sum(F.when(F.col("score") >= F.col("cut"), 1).otherwise(0)).alias("at"))
    last = room.join(ids, "who").join(fit, "who").select("who", F.when(F.col("at") > F.col("cap"), -F.col("cut") - 1).otherwise(-F.col("cut")).alias("last"))
    limits = cuts.join(last, "who", "left").select("who", "cut", "last")
    kept = F.expr("cut is null or score > cut or record is null or (score = cut and record <= last)")
    return rows.join(side(limits), "who", "left").select("record", "who", kept.alias("kept"))
