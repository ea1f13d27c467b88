"""Time series of prices and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _noise(i: Column, seed: int, k: int) -> Column:
    """Uniform in [0, 1), the same wherever it runs."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(k), i), F.lit(1 << 30)) / float(1 << 30)


def random_bars(spark: SparkSession, n: int = 100, seed: int = 42, start: str = "2024-01-01", price: float = 100.0, drift: float = 0.02) -> DataFrame:
    """Daily bars of a seeded random walk, rounded to cents; high and low enclose open and close. For test series of few bars."""
    w = Window.orderBy("i")
    base = spark.range(n).select(F.col("id").alias("i")).withColumn("step", 1 + (_noise(F.col("i"), seed, 0) - 0.5) * 2 * drift)
    walk = base.withColumn("close", F.round(price * F.exp(F.sum(F.log("step")).over(w)), 2)).withColumn("open", F.lag("close", 1, price).over(w))
    top, low = F.greatest("open", "close"), F.least("open", "close")
    return walk.select(F.date_add(F.to_date(F.lit(start)), F.col("i").cast("int")).alias("date"), "open", F.round(top * (1 + _noise(F.col("i"), seed, 1) * 0.01), 2).alias("high"), F.round(low * (1 - _noise(F.col("i"), seed, 2) * 0.01), 2).alias("low"), "close", (1000 + F.floor(_noise(F.col("i"), seed, 3) * 9000)).alias("volume"))


def moving_average(value: str, n: int, order: str, *by: str) -> Column:
    """The mean of the last n values, null for the first n - 1."""
    w = Window.partitionBy(*by).orderBy(order)
    return F.when(F.row_number().over(w) >= n, F.avg(value).over(w.rowsBetween(-n + 1, 0)))


def crossings(df: DataFrame, value: str, order: str, short: int, long: int, *by: str) -> DataFrame:
    """``signal``: 1 where the short average rises above the long one, -1 where it falls below, else 0."""
    w = Window.partitionBy(*by).orderBy(order)
    out = df.withColumn("short_avg", moving_average(value, short, order, *by)).withColumn("long_avg", moving_average(value, long, order, *by))
    above = F.col("short_avg") > F.col("long_avg")
    before = F.lag(above).over(w)
    return out.withColumn("signal", F.when(above & ~before, 1).when(~above & before, -1).otherwise(0))


def as_of(left: DataFrame, right: DataFrame, by: str, time: str, value: str) -> DataFrame:
    """Each row of ``left`` with the last ``value`` of ``right`` at or before its time: one union and one window instead of a range join."""
    l = left.select(by, time, *[c for c in left.columns if c not in (by, time)], F.lit(None).cast(dict(right.dtypes)[value]).alias("__v"), F.lit(1).alias("__side"))
    r = right.select(by, time, *[F.lit(None).cast(t).alias(c) for c, t in left.dtypes if c not in (by, time)], F.col(value).alias("__v"), F.lit(0).alias("__side"))
    w = Window.partitionBy(by).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return l.union(r).withColumn("as_of", F.last("__v", ignorenulls=True).over(w)).where("__side = 1").drop("__v", "__side")
