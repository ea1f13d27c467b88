"""Queries of the training-data operators over the project's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.bpe import count_tokens, encode
from corpusloom.llm.cap import cap_contributors
from corpusloom.llm.neardup import near_duplicate_groups, near_duplicate_pairs
from corpusloom.llm.overlap import cross_split_pairs, cross_split_report
from corpusloom.llm.packing import pack
from corpusloom.llm.pairs import DEFECTS, broken_pairs
from corpusloom.llm.people import name_node, person_keys, persons
from corpusloom.llm.splits import ComponentTable, assign_splits, code_node, together
from corpusloom.llm.toxicity import fitted, rates, score
from corpusloom.session import ship, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: TESTDATA.md's notion of nearly the same text.
NEARLY = {"k": 3, "threshold": 0.6, "min_words": 30}
TEXTS = ["source_code", "description"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_pairs(table(spark, sf_dir, "strategies"), "row_id", TEXTS, **NEARLY)


@query
def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "strategies"), "row_id", TEXTS, **NEARLY)


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cross_split_pairs(table(spark, sf_dir, "strategies"), "row_id", TEXTS, "split", **NEARLY)
    return pairs.select(F.least("train_record", "held_record").alias("row_a"), F.greatest("train_record", "held_record").alias("row_b"))


@query
def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_split_report(table(spark, sf_dir, "strategies"), "row_id", TEXTS, "split", "source_url", **NEARLY)


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "strategies").select("row_id", person_keys().alias("keys"), F.coalesce(F.nullif("likes_count", F.lit(0)), "preview_likes_count", F.lit(0)).alias("likes"))
    rows = stored(rows, "likes")
    first = persons(rows).withColumnRenamed("node", "key")
    named = rows.where(F.size("keys") > 0).select("row_id", "likes", F.col("keys")[0].alias("key")).join(first, "key").select("row_id", "likes", F.col("root").alias("who"))
    who = named.union(rows.where(F.size("keys") <= 0).select("row_id", "likes", F.lit(None).cast("string")))
    return cap_contributors(who, "who", "likes", "row_id", max_share=0.02).where("not kept").select(F.col("record").alias("row_id"))


def _related(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, node = table(spark, sf_dir, "strategies"), code_node("source_code")  # the package is sent before a function is made
    keys = F.concat(person_keys(), F.when(node.isNull(), F.array().cast("array<string>")).otherwise(F.array(node)))
    return rows.select("row_id", "author", "crawl_page", keys.alias("keys"))


PARTS = {"train": 0.8, "validation": 0.1, "test": 0.1}


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _related(spark, sf_dir)
    _, components = assign_splits(rows, "row_id", "keys", PARTS)
    names = rows.where("author <> ''").select("author").distinct().select(F.col("author").alias("value"), name_node("author").alias("node"))
    return together(names, components.resolved()).select(F.col("a").alias("author_a"), F.col("b").alias("author_b"))


@query
def p4_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, _ = assign_splits(_related(spark, sf_dir), "row_id", "keys", PARTS)
    return assigned.select(F.col("record").alias("row_id"), "split")


@query
def p4_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch, split, records): the crawl in two batches, of even and of odd pages, the second over the table that the first left."""
    rows, table_ = _related(spark, sf_dir).withColumn("odd", F.coalesce(F.expr("crawl_page % 2 = 1"), F.lit(False))), ComponentTable(spark)
    out = None
    for batch, some in enumerate((rows.where("not odd"), rows.where("odd")), 1):
        assigned, _ = assign_splits(some, "row_id", "keys", PARTS, table_)
        counts = assigned.groupBy("split").agg(F.count("*").alias("records")).select(F.lit(batch).alias("batch"), "split", "records")
        out = counts if out is None else out.union(counts)
    return out


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "script_pairs").select(F.lit("script_pairs").alias("table_name"), F.col("pair_id").alias("row_key"), F.col("input").alias("question"), F.col("output").alias("answer"))
    segments = table(spark, sf_dir, "segments").select(F.lit("segments"), "segment_id", "input", "output")
    tried = table(spark, sf_dir, "processing_states").where("conversion_attempts is null or conversion_attempts <> 0")
    return pairs.union(segments).union(tried.select(F.lit("processing_states"), "state_id", "raw_data.source_code", "converted_code"))


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _answers(spark, sf_dir).select(F.struct("table_name", "row_key").alias("key"), "question", "answer")
    return broken_pairs(keyed, "key", "question", "answer").select("key.table_name", "key.row_key", "defect")


@query
def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers, and those with each defect, by table."""
    every = _answers(spark, sf_dir).groupBy("table_name").agg(F.count("*").alias("answers"))
    broken = p1_found(spark, sf_dir).groupBy("table_name").pivot("defect", list(DEFECTS)).count().na.fill(0)
    return every.join(broken, "table_name", "left").na.fill(0)


@query
def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


#: Tokens of a training sequence.
CAPACITY = 2048


@query
def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", "n_tokens", CAPACITY)


@query
def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences, the tokens in them and the share of their room that is used."""
    used = p7_packed(spark, sf_dir).where("sequence is not null").groupBy("sequence").agg(F.sum("length").alias("used"))
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), (F.sum("used") / (F.count("*") * CAPACITY)).alias("fill"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, reviews = table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels")
    return score(documents, fitted(documents, reviews, "doc_id", "text", "abusive"), "doc_id", "text", "source")


@query
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where("abusive").select("doc_id")


@query
def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", "source", F.round("score", 6).alias("score"), "abusive")


@query
def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(_scored(spark, sf_dir), "source")


# Checks: what must hold of the results above, counted; SQL tells the counts.


@query
def p1_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, answers, without_row, several): answers, defects of rows that aren't answers, answers with more than one defect."""
    every, found = _answers(spark, sf_dir).select("table_name", "row_key"), stored(p1_found(spark, sf_dir), "found")
    answers = every.groupBy("table_name").agg(F.count("*").alias("answers"))
    lost = found.join(every, ["table_name", "row_key"], "left_anti").groupBy("table_name").agg(F.count("*").alias("without_row"))
    several = found.groupBy("table_name", "row_key").count().where("count > 1").groupBy("table_name").agg(F.count("*").alias("several"))
    return answers.join(lost, "table_name", "left").join(several, "table_name", "left").na.fill(0)


@query
def p4_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rows, without_split, authors_apart): rows, those without one of the splits, authors whose rows are in several."""
    rows = table(spark, sf_dir, "strategies").select("row_id", "author").join(p4_splits(spark, sf_dir), "row_id", "left")
    authors = rows.where("author <> ''").groupBy("author").agg(F.count_distinct("split").alias("splits")).agg(F.count_if(F.col("splits") > 1).alias("authors_apart"))
    counts = rows.agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(F.col("split").isin(*PARTS), F.lit(False))).alias("without_split"))
    return counts.withColumn("one", F.lit(1)).join(authors.withColumn("one", F.lit(1)), "one").drop("one")


@query
def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(texts, empty_texts, overfull, overlapping, split_short): texts, those without a place, sequences with more tokens than their
    capacity, pieces that begin before another ends, texts in several pieces that would have fitted into one."""
    packed = stored(p7_packed(spark, sf_dir), "packed")
    placed = packed.where("sequence is not null")
    before = F.lag(F.col("offset") + F.col("length")).over(Window.partitionBy("sequence").orderBy("offset"))  # over the pieces of a sequence
    spans = placed.withColumn("before", before).groupBy("sequence").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.count_if(F.col("before") > F.col("offset")).alias("over"))
    texts = packed.groupBy("doc_id").agg(F.sum("length").alias("length"), F.count("*").alias("pieces"))
    of_texts = texts.agg(F.count("*").alias("texts"), F.count_if(F.col("length") == 0).alias("empty_texts"), F.count_if((F.col("pieces") > 1) & (F.col("length") <= CAPACITY)).alias("split_short"))
    of_spans = spans.agg(F.count_if(F.col("end") > CAPACITY).alias("overfull"), F.coalesce(F.sum("over"), F.lit(0)).alias("overlapping"))
    return of_texts.withColumn("one", F.lit(1)).join(of_spans.withColumn("one", F.lit(1)), "one").drop("one")


_RUNS = r"""w as (select row_id, split, source_url, f, list_transform(regexp_extract_all(t, '[\p{L}\p{N}_]+'), lambda x: lower(x)) as ws from (select row_id, split, source_url, 0 as f, source_code as t from strategies union all select row_id, split, source_url, 1, description from strategies)),
u as (select row_id, f, list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) as runs from w where len(ws) >= 30),
e as (select row_id, f, len(runs) as n, unnest(runs) as run from u),
near as (select distinct row_a, row_b from (select a.row_id as row_a, b.row_id as row_b, a.f, a.n as x, b.n as y, count(*) as k from e a join e b on a.f = b.f and a.run = b.run and a.row_id < b.row_id group by all) where k::double / (x + y - k) >= 0.6)"""
_ACROSS = "(s.split = 'train' and t.split in ('val', 'test') or t.split = 'train' and s.split in ('val', 'test'))"

SQL["p5_found"] = f"with {_RUNS} select row_a, row_b from near"
SQL["p2_found"] = f"with {_RUNS} select row_a, row_b from near join strategies s on s.row_id = row_a join strategies t on t.row_id = row_b where {_ACROSS}"
SQL["p5_groups"] = f"""with recursive {_RUNS}, links as (select row_a as x, row_b as y from near union all select row_b, row_a from near),
reach(x, y) as (select row_id, row_id from strategies union select reach.x, links.y from reach join links on links.x = reach.y),
same as (select row_id, sum(n - 1)::bigint as copies from (select row_id, count(*) over (partition by f, ws) as n from w where len(ws) >= 30) group by 1)
select reach.x as record, min(y) as "group", coalesce(any_value(copies), 0) as copies from reach left join same on same.row_id = reach.x group by 1"""
SQL["p1_checks"] = """select table_name, count(*) as answers, 0 as without_row, 0 as several from (select 'script_pairs' as table_name from script_pairs union all select 'segments' from segments
union all select 'processing_states' from processing_states where conversion_attempts is null or conversion_attempts <> 0) group by 1"""
SQL["p4_checks"] = "select count(*) as rows, 0 as without_split, 0 as authors_apart from strategies"
SQL["p7_checks"] = "select count(*) as texts, count_if(coalesce(text, '') = '') as empty_texts, 0 as overfull, 0 as overlapping, 0 as split_short from documents"
