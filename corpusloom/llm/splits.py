"""Splits that keep related records together, on an incremental persisted table of components.

The table is a log of batches in the shared folder. Nodes keep the root that they got when they first came; when components merge
only their roots are written again, with the top that they now point at (so no pointer is ever longer than two steps). A batch's
folders count from the moment its commit is there, so a crash leaves the table of the batch before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.reduce import keep_ids
from corpusloom.session import cut, exists, partitions_for, shared_dir, stored

QUARANTINE = "quarantine"
#: Tables of a batch. Of parts the row in which ``root`` is ``top`` is a component's head and has its split and size.
SCHEMAS = {"nodes": "node string, root string", "parts": "root string, top string, split string, n long", "alone": "split string, n long", "conflicts": "top string, root string, split string, n long"}
#: Components with more than this share of the records are placed one by one (at most 1 / share of them).
LARGE = 1e-4
#: Units that one task puts in order.
UNITS_A_TASK = 500_000

_WORD, _OTHER = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


def code_node(code: str, min_words: int = 30) -> Column:
    """A node for source code, equal for codes that differ only in white space and letter case; null under ``min_words``."""
    plain = F.lower(F.regexp_replace(F.col(code), r"(?U)[\s\x1c-\x1f\x{200b}\x{feff}]+", ""))
    return F.when(F.col(code).rlike(rf"^(?:{_OTHER}*+{_WORD}++){{{min_words}}}"), F.concat(F.lit("#"), F.md5(plain)))


@dataclass(frozen=True)
class Batch:
    """What a batch adds: ``nodes`` (node, root), ``parts`` (root, top, split, n) in place of earlier rows of the same root, ``alone``
    (split, n) records without keys, ``conflicts`` (top, root, split, n): the parts of components that it puts into quarantine, with
    the splits that they had."""

    nodes: DataFrame
    parts: DataFrame
    alone: DataFrame
    conflicts: DataFrame


class ComponentTable:
    """The table of components in a folder, one of its own in the shared folder if none is given."""

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path, self._batches = spark, path or f"{shared_dir(spark)}/components-{uuid.uuid4().hex}", 0 if path is None else None

    def batches(self) -> int:
        """The number of batches, read once: a table has one writer."""
        if self._batches is None:
            there = exists(self.spark, f"{self.path}/commits")
            self._batches = (self.spark.read.schema("batch long").parquet(f"{self.path}/commits").agg(F.max("batch")).first()[0] or 0) if there else 0
        return self._batches

    def add(self, batch: Batch) -> None:
        """Each table of the batch in a folder of its own, then the commit. A try that failed before is overwritten."""
        number = self.batches() + 1
        for name in SCHEMAS:
            getattr(batch, name).write.mode("overwrite").parquet(f"{self.path}/{name}/batch={number}")
        self.spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        self._batches = number

    def _log(self, name: str) -> DataFrame:
        done = self.batches()
        if not done:
            return self.spark.createDataFrame([], f"{SCHEMAS[name]}, batch long")
        return self.spark.read.schema(f"{SCHEMAS[name]}, batch long").option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/batch={k}" for k in range(1, done + 1)])

    def nodes(self) -> DataFrame:
        return self._log("nodes").select("node", "root")

    def parts(self) -> DataFrame:
        """(root, top, split, n): the last row of each root."""
        log = self._log("parts")
        if self.batches() <= 1:
            return log.drop("batch")
        last = F.max_by(F.struct("top", "split", "n"), "batch")
        return log.groupBy("root").agg(last.alias("p")).select("root", "p.*")

    def alone(self) -> DataFrame:
        return self._log("alone").drop("batch")

    def conflicts(self) -> DataFrame:
        """(batch, top, root, split, n): what each batch put into quarantine, and the splits that its parts had before."""
        return self._log("conflicts")

    def resolved(self) -> DataFrame:
        """(node, root, split) of every node, as of the last batch."""
        parts = self.parts()
        tops = parts.where("root = top").select("top", "split")
        return self.nodes().join(parts.select("root", "top"), "root").join(tops, "top").select("node", F.col("top").alias("root"), "split")

    def splits_of(self, df: DataFrame, record: str, keys: str) -> DataFrame:
        """(record, split) of rows of any batch as of the last one; rows without keys are not in the table."""
        first = df.where(F.col(record).isNotNull()).select(F.col(record).alias("record"), F.get(F.expr(f"filter({keys}, k -> k is not null)"), F.lit(0)).alias("node")).where("node is not null")
        return first.join(self.resolved().select("node", "split"), "node").select("record", "split")


def _shares(missing: dict[str, float], proportions: dict[str, float]) -> dict[str, float]:
    """What the splits lack, the proportions if none lacks anything."""
    left = {s: max(0.0, m) for s, m in missing.items()}
    return left if sum(left.values()) else dict(proportions)


def _by_point(point: Column, shares: dict[str, float], whole: float) -> Column:
    upto, choice, total = 0.0, None, sum(shares.values())
    for s, share in shares.items():
        upto += share / total * whole
        choice = F.when(point < upto, s) if choice is None else choice.when(point < upto, s)
    return choice.otherwise(max(shares, key=lambda s: shares[s]))


def _filled(units: DataFrame, missing: dict[str, float], proportions: dict[str, float], total: int) -> tuple[DataFrame, dict[str, float]]:
    """Units (name, n), each name once -> (name, n, split) such that the splits get what they lack, and what they lack then. The few
    large units go one by one to where most is missing. The others are laid in a row in the order of a hash, which is cut where the
    splits' shares end: so each split gets its share up to a part of one unit, whatever the sizes are."""
    units = stored(units, "units")
    large = F.col("n") > max(1, LARGE * total)
    placed, missing = [], dict(missing)
    for unit in units.where(large).orderBy(F.desc("n"), "name").collect():  # at most 1 / LARGE rows
        s = max(missing, key=lambda x: (missing[x], x))
        placed.append((unit["name"], unit["n"], s))
        missing[s] -= unit["n"]
    small = units.where(~large)
    count, whole = small.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Ranges of the hash, whose sizes are added up first, so that no task orders more than a range.
    ranges = partitions_for(units.sparkSession, count, UNITS_A_TASK)
    drawn = small.withColumn("draw", F.xxhash64(F.lit("split"), F.col("name"))).withColumn("range", F.floor((F.col("draw") / 2.0**64 + 0.5) * ranges).cast("int"))
    sizes = drawn.groupBy("range").agg(F.sum("n").alias("size"))
    before = sizes.select("range", (F.sum("size").over(Window.orderBy("range")) - F.col("size")).alias("before"))  # over one row for each range
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("draw", "name")) - F.col("n")
    laid = drawn.withColumn("inside", inside).join(F.broadcast(before), "range")
    split = _by_point(F.col("before") + F.col("inside") + F.col("n") / 2, _shares(missing, proportions), float(whole))
    done = laid.select("name", "n", split.alias("split"))
    if placed:
        done = done.union(units.sparkSession.createDataFrame(placed, "name string, n long, split string"))
    done = stored(done, "placed")
    for r in done.groupBy("split").agg(F.sum("n").alias("n")).collect():  # a row for each split
        missing[r["split"]] = missing.get(r["split"], 0.0) - r["n"]
    for _, n, s in placed:
        missing[s] += n  # was taken off above already
    return done, missing


def assign_splits(df: DataFrame, record: str, keys: str, proportions: dict[str, float], table: ComponentTable | None = None) -> tuple[DataFrame, ComponentTable]:
    """``(assigned, table)``: assigned (record, split) for each row of ``df``, a batch, and the table with the batch added.

    ``keys`` is an array of strings; rows that share one, directly or through other rows of this or an earlier batch, get one split.
    Components that have a split keep it, new ones fill what the splits lack of their proportions of all records so far, and
    components whose parts had different splits get ``quarantine``; ``table.conflicts`` reports them, and ``table.splits_of`` tells
    what has become of rows of earlier batches. Rows without keys (null or empty array) are placed each for itself, after the
    others, to fill what is still lacking. Rows with a null record are ignored; repeated rows count each.

    Only nodes of the batch are looked up, and only components that it touches are worked on and written.
    """
    if abs(sum(proportions.values()) - 1) > 1e-9:
        raise ValueError("proportions must add up to 1")
    spark = df.sparkSession
    table = table or ComponentTable(spark)
    rows = stored(df.where(F.col(record).isNotNull()).select(F.col(record).alias("record"), F.coalesce(F.expr(f"filter({keys}, k -> k is not null)"), F.array().cast("array<string>")).alias("keys")), "rows")
    keyed = rows.where(F.size("keys") > 0)
    edges = keyed.select(F.explode(F.expr("transform(keys, k -> struct(keys[0] as u, k as v))")).alias("e")).select("e.*").distinct()
    first = table.batches() == 0
    if first:
        of = cut(components(edges).select("node", F.col("root").alias("comp"), F.lit(None).cast("string").alias("was")))
        heads = spark.createDataFrame([], "comp string, root string, split string, n long")
        moved = spark.createDataFrame([], SCHEMAS["parts"])
    else:
        edges, parts = stored(edges, "edges"), stored(table.parts(), "parts")
        touched = stored(edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("id", F.xxhash64("node")), "touched")
        old = keep_ids(table.nodes().withColumn("id", F.xxhash64("node")), "id", touched.select("id").distinct())
        at = stored(touched.select("node").join(old.select("node", "root"), "node", "left").join(parts.select("root", "top"), "root", "left").select("node", F.col("top").alias("was")), "at")
        now = at.select("node", F.coalesce("was", "node").alias("now"))
        lifted = edges.join(now.toDF("u", "x"), "u").join(now.toDF("v", "y"), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
        moves = cut(components(lifted))
        of = cut(at.withColumn("now", F.coalesce("was", "node")).join(moves.toDF("now", "comp"), "now").select("node", "comp", "was"))
        tops = of.where("was is not null").select(F.col("was").alias("top"), "comp").distinct()
        reached = stored(parts.join(tops, "top"), "reached")
        heads = reached.where("root = top").select("comp", "root", "split", "n")
        moved = reached.where("root <> comp").select("root", F.col("comp").alias("top"), F.lit(None).cast("string").alias("split"), F.lit(None).cast("long").alias("n"))
    here = keyed.groupBy(F.col("keys")[0].alias("node")).agg(F.count("*").alias("n")).join(of, "node").groupBy("comp").agg(F.sum("n").alias("n"))
    every = here.select("comp", F.lit(None).cast("string").alias("split"), "n").union(heads.select("comp", "split", "n"))
    split = F.when(F.count_distinct("split") > 1, QUARANTINE).otherwise(F.min("split"))
    comps = cut(every.groupBy("comp").agg(F.sum("n").alias("n"), split.alias("split"), F.count_distinct("split").alias("splits")))

    def by_split(d: DataFrame) -> dict[str, int]:
        return {r["split"]: r["n"] for r in d.where("split is not null").groupBy("split").agg(F.sum("n").alias("n")).collect()}

    held = dict.fromkeys(proportions, 0)
    for sign, d in () if first else ((1, comps), (1, table.alone()), (1, parts.where("root = top")), (-1, heads)):
        for s, n in by_split(d).items():
            held[s] = held.get(s, 0) + sign * n
    new, single = comps.where("split is null"), rows.where(F.size("keys") <= 0)
    total = sum(n for s, n in held.items() if s != QUARANTINE) + (new.agg(F.sum("n")).first()[0] or 0) + single.count()
    missing = {s: p * total - held[s] for s, p in proportions.items()}
    placed, missing = _filled(new.select(F.col("comp").alias("name"), "n"), missing, proportions, total)
    units = single.groupBy(F.col("record").cast("string").alias("name")).agg(F.count("*").alias("n"))
    alone, _ = _filled(units, missing, proportions, total)
    comps = cut(comps.join(placed.select(F.col("name").alias("comp"), F.col("split").alias("new")), "comp", "left").select("comp", "n", F.coalesce("split", "new").alias("split"), "splits"))
    conflicts = heads.join(comps.where("splits > 1").select("comp"), "comp").where("split is not null").select(F.col("comp").alias("top"), "root", "split", "n")
    table.add(Batch(
        of.where("was is null").select("node", F.col("comp").alias("root")),
        moved.union(comps.select("comp", "comp", "split", "n")),
        alone.groupBy("split").agg(F.sum("n").alias("n")),
        conflicts,
    ))
    by_key = keyed.select("record", F.col("keys")[0].alias("node")).join(of, "node").join(comps.select("comp", "split"), "comp").select("record", "split")
    return by_key.union(single.join(alone.select("name", "split"), F.col("record").cast("string") == F.col("name")).select("record", "split")), table


def together(names: DataFrame, state: DataFrame) -> DataFrame:
    """(a, b), a < b by code point: values of ``names`` (value, node) that are in one component of ``state`` (node, root, ...)."""
    at = names.join(state.select("node", "root"), "node").select("root", "value").distinct()
    return at.alias("x").join(at.alias("y"), F.expr("x.root = y.root and x.value < y.value")).select(F.col("x.value").alias("a"), F.col("y.value").alias("b"))
