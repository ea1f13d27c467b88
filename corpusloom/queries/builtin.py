"""Relational and time-series operators over the star schema and the events: Spark's own, offered beside the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import series
from corpusloom.queries.base import query, table
from corpusloom.session import shared_dir
from corpusloom.streaming import streams


@query("""select n_name, count(*) as orders, round(sum(o_totalprice), 2) as total from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
where r_name = 'ASIA' group by 1""")
def join_inner(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").join(table(spark, d, "region").where("r_name = 'ASIA'"), F.expr("r_regionkey = n_regionkey"))
    customers = table(spark, d, "customer").join(nation, F.expr("n_nationkey = c_nationkey")).select("c_custkey", "n_name")
    return table(spark, d, "orders").join(customers, F.expr("c_custkey = o_custkey")).groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("select c_custkey, count(o_orderkey) as orders from customer left join orders on c_custkey = o_custkey group by 1")
def join_left(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return table(spark, d, "customer").select("c_custkey").join(orders, F.expr("c_custkey = o_custkey"), "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("select coalesce(a.source, b.source) as source, a.n, b.channel from (select source, count(*) as n from documents group by 1) a full join doc_sources b on a.source = b.source")
def join_full(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    b = table(spark, d, "doc_sources").select(F.col("source").alias("s"), "channel")
    return a.join(b, F.expr("source = s"), "full").select(F.coalesce("source", "s").alias("source"), "n", "channel")


@query("select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F') as has_filled from customer")
def join_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    filled = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(filled, "c_custkey", "left_semi").withColumn("has_filled", F.lit(True)).union(c.join(filled, "c_custkey", "left_anti").withColumn("has_filled", F.lit(False)))


@query("""select l_returnflag, l_linestatus, grouping(l_returnflag) as all_flags, grouping(l_linestatus) as all_statuses, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue
from lineitem where l_shipdate <= timestamp '1998-09-02' group by cube (l_returnflag, l_linestatus)""")
def cube_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return rows.cube("l_returnflag", "l_linestatus").agg(F.grouping("l_returnflag").cast("long").alias("all_flags"), F.grouping("l_linestatus").cast("long").alias("all_statuses"), F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("select year(o_orderdate) as year, month(o_orderdate) as month, count(*) as n from orders group by rollup (year(o_orderdate), month(o_orderdate))")
def rollup_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"))
    return rows.rollup("year", "month").agg(F.count("*").alias("n"))


@query("select o_orderpriority, count_if(o_orderstatus = 'F') as f, count_if(o_orderstatus = 'O') as o, count_if(o_orderstatus = 'P') as p from orders group by 1")
def pivot_status(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    return rows.withColumnsRenamed({"F": "f", "O": "o", "P": "p"})


@query("select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers from lineitem group by 1")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("select o_orderkey, rank() over w as rnk, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as before, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding), 2) as running from orders window w as (partition by o_custkey order by o_totalprice desc)")
def window_functions(spark: SparkSession, d: str) -> DataFrame:
    t = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"))).cast("long").alias("rnk"), F.lag("o_orderkey").over(t).alias("before"), F.round(F.sum("o_totalprice").over(t.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running"))


@query("(select o_custkey as k from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'O') except select c_custkey from customer where c_mktsegment = 'BUILDING'")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    status = lambda s: table(spark, d, "orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return status("F").intersect(status("O")).subtract(table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"))


_BARS = "select date_trunc('day', ts) as day, event_type, avg(value) as v from events group by 1, 2"
_AVG = "avg(v) over (partition by event_type order by day rows between {n} preceding and current row)"


@query(f"""select day, event_type, round(case when k >= 3 then s end, 6) as short_avg, round(case when k >= 7 then l end, 6) as long_avg, (case when k >= 7 and s > l and not ps > pl and k > 7 then 1 when k > 7 and not s > l and ps > pl then -1 else 0 end) as signal from
(select *, lag(s) over w as ps, lag(l) over w as pl from (select *, row_number() over w as k, {_AVG.format(n=2)} as s, {_AVG.format(n=6)} as l from ({_BARS}) window w as (partition by event_type order by day)) window w as (partition by event_type order by day))""")
def average_crossings(spark: SparkSession, d: str) -> DataFrame:
    bars = table(spark, d, "events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.avg("value").alias("v"))
    out = series.crossings(bars, "v", "day", 3, 7, "event_type")
    return out.select("day", "event_type", F.round("short_avg", 6).alias("short_avg"), F.round("long_avg", 6).alias("long_avg"), "signal")


@query()
def random_bars(spark: SparkSession, d: str) -> DataFrame:
    return series.random_bars(spark, 100)


@query("""select event_id, (select arg_max(value, ts) from events p where p.user_id = e.user_id and p.event_type = 'purchase' and p.ts <= e.ts) as as_of from events e where event_type = 'click'""")
def as_of_join(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    left = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    return series.as_of(left, e.where("event_type = 'purchase'").select("user_id", "ts", "value"), "user_id", "ts", "value").select("event_id", "as_of")


@query("select date_trunc('hour', ts) as starts, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def hourly_windows(spark: SparkSession, d: str) -> DataFrame:
    return streams.windowed_counts(table(spark, d, "events"), "ts", "event_type", "value")


@query("""select user_id, min(ts) as starts, max(ts) + interval 30 minutes as ends, count(*) as n from (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as s from
(select *, case when ts >= lag(ts) over (partition by user_id order by ts) + interval 30 minutes then 1 else 0 end as new from events)) group by user_id, s""")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    return streams.sessions(table(spark, d, "events"), "ts", "user_id")


@query("select event_type, count(*) as n from events group by 1")
def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The events read as a stream to a table, each file once, then counted."""
    import uuid

    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    streams.run_available(stream, f"{base}/out", f"{base}/progress")
    return spark.read.schema(schema).parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"))
