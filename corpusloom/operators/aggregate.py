"""Counts, summaries and distributions. All are aggregations with map-side combine; nothing is gathered."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import _c
from corpusloom.session import stored

SCORE_BANDS = ((9.0, "excellent"), (7.0, "good"), (5.0, "average"), (3.0, "poor"))


def histogram(df: DataFrame, name: str, value: Column | str) -> DataFrame:
    """(name, n, percent), by value; null is a value."""
    counts = df.groupBy(_c(value).alias(name)).agg(F.count("*").alias("n"))
    return counts.select(name, "n", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4).alias("percent"))  # over the few values


def breakdown(df: DataFrame, reason: str) -> DataFrame:
    """(reason, n, percent) of the rows that have one, the most frequent first."""
    return histogram(df.where(F.col(reason).isNotNull()), reason, reason).orderBy(F.desc("n"), reason)


def mean_of_scored(df: DataFrame, score: Column | str, digits: int = 2) -> DataFrame:
    """(scored, mean) over the rows with a score; 0.0 for none."""
    return df.agg(F.count(_c(score)).alias("scored"), F.round(F.coalesce(F.avg(_c(score)), F.lit(0.0)), digits).alias("mean"))


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()])


def score_summary(df: DataFrame, score: Column | str, bands: Sequence[tuple[float, str]] = SCORE_BANDS, lowest: str = "very_poor", digits: int = 6) -> DataFrame:
    """Count, mean, extremes and the counts by band; 0.0 for no scores."""
    s, counts, upper = _c(score), [], None
    for least, name in bands:
        c = s >= least
        counts.append(F.count_if(c if upper is None else c & (s < upper)).alias(name))
        upper = least
    counts.append(F.count_if(s < upper).alias(lowest))
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), digits)
    return df.agg(F.count(s).alias("n"), zero(F.avg(s)).alias("mean"), zero(F.min(s)).alias("low"), zero(F.max(s)).alias("high"), *counts)


#: Distinct values that one task puts in order.
VALUES_A_TASK = 1_000_000


def _ranked(df: DataFrame, value: Column | str, by: Sequence[str], per_task: int = VALUES_A_TASK) -> DataFrame:
    """Counts by value with the number of rows at or below: (by, v, upto, total, n). The distinct values take the place of the
    rows. They are ordered in ranges of a bounded number, whose rows are added up first, so that neither a group nor the whole
    has to be ordered by one task."""
    counts = stored(df.select(*by, _c(value).cast("double").alias("v")).where("v is not null").groupBy(*by, "v").agg(F.count("*").alias("n")), "counts")
    ranges = -(-counts.count() // per_task)
    if ranges > 1:
        counts = stored(counts.repartitionByRange(ranges, "v").withColumn("__range", F.spark_partition_id()), "ranges")
    else:
        counts = counts.withColumn("__range", F.lit(0))
    sizes = counts.groupBy(*by, "__range").agg(F.sum("n").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__range")  # over one row for each range
    sizes = sizes.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__range").alias("__r"), (F.sum("__n").over(before) - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy(*by)).alias("total"))
    same = F.col("__range") == F.col("__r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    inside = F.sum("n").over(Window.partitionBy(*by, "__range").orderBy("v"))
    return counts.join(sizes, same).withColumn("upto", F.col("__before") + inside).select(*by, "v", "upto", "total", "n")


def _at(rank: Column) -> Column:
    """The value at a 1-based rank."""
    return F.min(F.when(F.col("upto") >= rank, F.col("v")))


def upper_median(df: DataFrame, value: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """The middle of the sorted values, the upper one of two."""
    return _ranked(df, value, by).groupBy(*by).agg(_at(F.expr("total div 2 + 1")).alias("median"))


def exclusive_quantiles(df: DataFrame, value: Column | str, points: Sequence[float], by: Sequence[str] = (), digits: int = 6, median: bool = False) -> DataFrame:
    """Quantiles at rank (n + 1) p, between neighbours in proportion, the rank kept within 1 and n: p25 and so on. They are asked for
    of at least as many values as parts are cut for them (4 for p25 and p75, 20 for p95, 100 for p99); with fewer, those below one
    half are the least value and the others the greatest. ``median`` adds the upper median."""
    out = [_at(F.expr("total div 2 + 1")).alias("median")] if median else []
    for p in points:
        h = (F.col("total") + 1) * F.lit(p)
        j = F.least(F.greatest(F.floor(h), F.lit(1)), F.greatest(F.col("total") - 1, F.lit(1)))
        low, high, part = _at(j), _at(F.least(j + 1, F.col("total"))), F.max(F.when(F.col("total") > 1, h - j).otherwise(F.lit(0.0)))
        least = Fraction(p).limit_denominator(1000).denominator
        few = F.max("total") < least
        out.append(F.round(F.when(few, F.min("v") if p < 0.5 else F.max("v")).otherwise(low + part * (high - low)), digits).alias(f"p{p * 100:g}".replace(".", "_")))
    return _ranked(df, value, by).groupBy(*by).agg(*out)


def length_stats(df: DataFrame, value: Column | str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    v = _c(value)
    stats = [F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.round(F.avg(v), digits).alias("mean"), F.round(F.coalesce(F.stddev_samp(v), F.lit(0.0)), digits).alias("stdev")]
    return df.groupBy(*by).agg(*stats) if by else df.agg(*stats)


def bucketed(value: Column | str, edges: Sequence[int]) -> Column:
    """``0-499``, ``500-999`` and so on, ``4000+`` from the last edge."""
    v, out = _c(value), None
    for low, high in zip(edges, edges[1:]):
        c = (v >= low) & (v < high)
        out = F.when(c, f"{low}-{high - 1}") if out is None else out.when(c, f"{low}-{high - 1}")
    return out.when(v >= edges[-1], f"{edges[-1]}+")


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Percent, 0 for nothing."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def paired_comparison(df: DataFrame, a: Column | str, b: Column | str, digits: int = 6) -> DataFrame:
    """Means of two scores, wins, losses and ties of the first, and the mean difference; pairs with a null are left out."""
    x, y = _c(a), _c(b)
    return df.where(x.isNotNull() & y.isNotNull()).agg(
        F.count("*").alias("n"), F.round(F.avg(x), digits).alias("mean_a"), F.round(F.avg(y), digits).alias("mean_b"),
        F.count_if(x > y).alias("wins"), F.count_if(x < y).alias("losses"), F.count_if(x == y).alias("ties"), F.round(F.avg(x - y), digits).alias("difference"),
    )


def batch_stats(df: DataFrame, position: str, size: int, accepted: Column) -> DataFrame:
    """Rows and accepted rows of each batch of ``size`` positions."""
    n, ok = F.count("*"), F.count_if(F.coalesce(accepted, F.lit(False)))
    return df.groupBy(F.expr(f"{position} div {size}").alias("batch")).agg(n.alias("total"), ok.alias("accepted"), (n - ok).alias("rejected"), F.round(ok * 100.0 / n, 4).alias("acceptance"))


def agreement_rate(df: DataFrame, a: Column | str, b: Column | str) -> DataFrame:
    same = F.count_if(_c(a).eqNullSafe(_c(b)))
    return df.agg(F.count("*").alias("n"), same.alias("same"), rate(same, F.count("*")).alias("percent"))


def batch_summary(batches: DataFrame, last: int = 5) -> DataFrame:
    """(batches, acceptance, latest): of the rows of ``batch_stats`` their number, the share accepted in percent, and the last few."""
    few = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("batch", "accepted", "total")), asc=False), 1, last), lambda b: F.format_string("%d: %d/%d", b["batch"], b["accepted"], b["total"]))
    # Every task keeps the last few only.
    top = batches.orderBy(F.desc("batch")).limit(last).agg(F.array_join(few, ", ").alias("latest"))
    return batches.agg(F.count("*").alias("batches"), F.round(F.coalesce(F.try_divide(F.sum("accepted") * 100.0, F.sum("total")), F.lit(0.0)), 4).alias("acceptance")).withColumn("one", F.lit(1)).join(top.withColumn("one", F.lit(1)), "one").drop("one")
