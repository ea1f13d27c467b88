"""Near-duplicate records: deletion-variant signatures, an equality join on them, and an exact check.

A text's distinct runs of ``k`` words get a MinHash signature of 16-bit symbols; each symbol of two texts agrees with the
probability of their similarity. The signature is cut into segments of five symbols. Instead of asking for an equal
segment (which would need many short segments), a segment may differ in one symbol: each segment is indexed under its five
one-wildcard variants, and texts that share a variant meet in an equality join. The share of agreeing symbols of the whole
signature sorts out chance meetings, and the exact similarity of the sets of runs decides.

The method is described for bits. At a similarity of 0.6 a fifth of the bits of two sketches differ, so segments in which
at most one bit differs would have about five bits, which select nothing; symbols of 16 bits keep the scheme and select well.

A pair of similarity s is met with probability 1 - (1 - s^5 - 5 s^4 (1 - s))^segments; ``segments_for`` picks the number so
that at the threshold itself at most ``miss`` of the pairs are lost, and far fewer above it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import words as W
from corpusloom.llm.components import components
from corpusloom.llm.reduce import keep_ids
from corpusloom.session import cut, partitions_for, stored

SYMBOLS = 5
#: Keys shuffled to one task; classes of a key up to which its pairs are made where the key is; classes of one key in a block.
KEYS_A_TASK, FEW, BLOCK = 1_000_000, 32, 1_000
#: Classes that are looked at for keys that very many have, and the share of them that makes a key hot.
SEEN, HOT = 5_000, 0.005
_FEATURES = "tid long, field int, held boolean, c1 long, c2 long, n int, low binary, high binary"


def segments_for(threshold: float, miss: float = 0.0015) -> int:
    met = threshold**SYMBOLS + SYMBOLS * threshold ** (SYMBOLS - 1) * (1 - threshold)
    return 1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - met)))


def _agreement(threshold: float, symbols: int) -> int:
    """Agreeing symbols asked of a candidate: four and a half standard deviations below those expected at the threshold."""
    return max(1, math.floor(symbols * threshold - 4.5 * math.sqrt(symbols * threshold * (1 - threshold))))


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = W.mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(W.GOLDEN))
    return base[:n] | np.uint64(1), base[n:]


def _features(n_cols: int, k: int, symbols: int, min_words: int):
    """(id, held, t0, ...) -> a row for each text of enough words; the signature is empty if ``symbols`` is 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, (a, b) = W.WordHasher(), _multipliers(symbols)
        for batch in batches:
            rows = []
            for field in range(n_cols):
                for i, held, text in zip(batch["id"], batch["held"], batch[f"t{field}"]):
                    ws = W.words(text)
                    if len(ws) < max(min_words, k):
                        continue
                    sig = np.empty(0, dtype=np.uint16)
                    if symbols:
                        runs = np.unique(W.run_hashes(hasher(ws), k))
                        low = np.full(symbols, np.iinfo(np.uint64).max, dtype=np.uint64)
                        for at in range(0, len(runs), 4096):  # bounded memory for very long texts
                            low = np.minimum(low, (runs[at : at + 4096, None] * a[None, :] + b[None, :]).min(axis=0))
                        sig = (W.mixed(low) >> np.uint64(48)).astype(np.uint16)
                    rows.append((int(i) * n_cols + field, field, bool(held), *W.content_hash(ws), len(ws), (sig & 255).astype(np.uint8).tobytes(), (sig >> 8).astype(np.uint8).tobytes()))
            yield pd.DataFrame(rows, columns=["tid", "field", "held", "c1", "c2", "n", "low", "high"])

    return run


def _variant_keys(segments: int):
    """(cls, field, low, high) -> a row for each one-wildcard variant of each segment. ``packed`` has the symbol under the wildcard in
    its 16 low bits; above it are a bit that marks the first variant and the variant's hash, which together are its key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = W.mixed(np.arange(101, 101 + SYMBOLS, dtype=np.uint64)) | np.uint64(1)
        place = W.mixed(np.arange(1001, 1001 + segments * SYMBOLS, dtype=np.uint64)).reshape(1, segments, SYMBOLS)
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048]
                n = len(part)
                low = np.frombuffer(b"".join(part["low"]), dtype=np.uint8).astype(np.uint64)
                high = np.frombuffer(b"".join(part["high"]), dtype=np.uint8).astype(np.uint64)
                sym = ((high << np.uint64(8)) | low).reshape(n, segments, SYMBOLS)
                part_sum = (sym + np.uint64(1)) * weights
                keys = W.mixed(part_sum.sum(axis=2, dtype=np.uint64)[:, :, None] - part_sum + place + part["field"].to_numpy().astype(np.uint64)[:, None, None] * np.uint64(W.GOLDEN))
                first = (np.arange(SYMBOLS) == 0).astype(np.uint64) << np.uint64(16)
                packed = (keys & np.uint64(0xFFFFFFFFFFFE0000)) | first[None, None, :] | sym
                yield pd.DataFrame({"packed": packed.reshape(-1).view(np.int64), "cls": np.repeat(part["cls"].to_numpy(), segments * SYMBOLS)})

    return run


def _agree(least: int):
    @F.pandas_udf("boolean")
    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(len(b), -1)
        return pd.Series((x == y).sum(axis=1) >= least)

    return agree


def _run_sets(k: int):
    """(tid, text) -> (tid, runs): the text's distinct runs, by the upper six bytes of their hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = W.WordHasher()
        for batch in batches:
            yield pd.DataFrame({"tid": batch["tid"], "runs": [_packed(W.run_hashes(hasher(W.words(t)), k)) for t in batch["text"]]})

    return run


def _packed(runs: np.ndarray) -> bytes:
    return np.unique(runs >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(runs: bytes) -> np.ndarray:
    out = np.zeros((len(runs) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(runs, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([W.jaccard(_unpacked(x), _unpacked(y)) for x, y in zip(a, b)], dtype="float64")


def sources(df: DataFrame, id_col: str, text_cols: list[str], held: Column | None = None) -> DataFrame:
    """(id, held, t0, t1, ...): the columns that are read, under names that can't clash."""
    texts = [F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(text_cols)]
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), (F.lit(False) if held is None else held).alias("held"), *texts)


def texts_of(src: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(tid, text) of the wanted texts (tid, each once)."""
    each = [F.struct((F.col("id") * n + i).alias("tid"), F.col(f"t{i}").alias("text")) for i in range(n)]
    texts = src.select(F.explode(F.array(*each)).alias("t")).select("t.*").where("text is not null")
    return keep_ids(texts, "tid", wanted).join(wanted, "tid").dropDuplicates(["tid"])


def text_classes(src: DataFrame, n: int, *, k: int, min_words: int, symbols: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(members, reps)``: members (record, field, held, cls), reps (cls, field, held, n, low, high) with the words and the
    signature, if asked for, of each class of texts of the same words. ``held`` and other texts have classes of their own."""
    same = ["field", "held", "c1", "c2"]
    features = stored(src.mapInPandas(_features(n, k, symbols, min_words), _FEATURES), "features")
    classes = features.groupBy(*same).agg(F.min("tid").alias("cls"))
    members = features.join(classes, same).select(F.expr(f"(tid - field) div {n}").alias("record"), "field", "held", "cls").distinct()
    firsts = [F.first(c).alias(c) for c in ("n", "low", "high")[: 3 if symbols else 1]]  # equal in a class
    return members, stored(features.groupBy(*same).agg(F.min("tid").alias("cls"), *firsts).drop("c1", "c2"), "classes")


def variants(reps: DataFrame, segments: int) -> DataFrame:
    """(key, cls, under, size, before): the keys that at least two classes have, the number of classes that have each and, for
    keys of at most ``FEW`` classes, the smaller of them. ``under`` is the symbol under the wildcard, -1 for the first variant.
    One shuffle of all keys, in partitions of a bounded number, except for hot keys, whose classes stay where they are; what
    follows only sees the keys that are shared."""
    classes = reps.count()
    hot = _hot_keys(reps, classes, segments)
    key = F.shiftright("packed", 16)
    packed = reps.mapInPandas(_variant_keys(segments), "packed long, cls long")
    cold = packed if hot is None else packed.join(F.broadcast(hot), key == F.col("hot"), "left_anti")
    shape = (key.alias("key"), F.col("cls"), F.expr("if(packed & 65536 = 0, cast(packed & 65535 as int), -1)").alias("under"))
    keys = cold.repartition(partitions_for(reps.sparkSession, classes * segments * SYMBOLS, KEYS_A_TASK), key).select(*shape)
    shared = keys.withColumn("size", F.count("*").over(Window.partitionBy("key"))).where("size > 1")
    before = F.collect_list(F.struct("cls", "under")).over(Window.partitionBy("key").orderBy("cls").rowsBetween(-FEW, -1))
    shared = shared.withColumn("before", F.when(F.col("size") <= FEW, before))
    if hot is not None:
        rows = stored(packed.join(F.broadcast(hot), key == F.col("hot"), "left_semi").select(*shape), "hot-variants")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"))  # a row for each hot key
        shared = shared.unionByName(rows.join(F.broadcast(sizes), "key").select("key", "cls", "under", "size", F.lit(None).cast(shared.schema["before"].dataType).alias("before")))
    return stored(shared, "variants")


def _hot_keys(reps: DataFrame, classes: int, segments: int) -> DataFrame | None:
    """(hot): the keys of more than a ``HOT`` share of some ``SEEN`` classes, null without any. Their classes aren't brought to one
    task; there are at most keys a class / ``HOT`` of them. Whether a key is found here changes the way of its classes only."""
    every = max(1, classes // SEEN)
    some = reps.where(F.pmod(F.xxhash64("cls"), F.lit(every)) == 0)
    least = max(FEW + 1, math.ceil(HOT * classes / every))
    keys = some.mapInPandas(_variant_keys(segments), "packed long, cls long").groupBy(F.shiftright("packed", 16).alias("hot")).count().where(F.col("count") >= least)
    keys = stored(keys.select("hot"), "hot-keys")
    return None if keys.isEmpty() else keys


def _differ(x: str, y: str) -> str:
    """Of two classes with a key: that they differ under the wildcard. Equal segments meet under the first variant alone."""
    return f"({x}under = -1 or {x}under <> {y}under)"


def _met(some: DataFrame, every: DataFrame, condition: str) -> DataFrame:
    """(a, b): classes of ``some`` (x) with those of ``every`` (y) that have the same key and fulfil the condition. The classes of a
    large key are cut into blocks, each a part of its own."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    x = some.withColumn("block", F.when(F.col("size") > BLOCK, F.pmod(F.xxhash64("cls"), blocks)).otherwise(F.lit(0)).cast("int"))
    y = every.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    parts = partitions_for(some.sparkSession, some.count(), KEYS_A_TASK)
    spread = lambda d: d.drop("before").repartition(parts, "key", "block")
    same = F.expr(f"x.key = y.key and x.block = y.block and {_differ('x.', 'y.')} and {condition}")
    return spread(x).alias("x").join(spread(y).alias("y"), same).select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))


def pairs_of(shared: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of classes that share a key."""
    small = shared.where(F.col("size") <= FEW).select("under", F.col("cls").alias("b"), F.explode("before").alias("y"))
    large = shared.where(F.col("size") > FEW)
    return small.where(_differ("", "y.")).select(F.col("y.cls").alias("a"), "b").union(_met(large, large, "x.cls < y.cls")).distinct()


def likely(met: DataFrame, reps: DataFrame, threshold: float, segments: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in enough symbols."""
    sketch = reps.select("cls", "low")
    return (
        met.join(sketch.select(F.col("cls").alias("a"), F.col("low").alias("low_a")), "a")
        .join(sketch.select(F.col("cls").alias("b"), F.col("low").alias("low_b")), "b")
        .where(_agree(_agreement(threshold, segments * SYMBOLS))("low_a", "low_b"))
        .select("a", "b")
    )


def _verified(pairs: DataFrame, src: DataFrame, n: int, k: int, threshold: float) -> DataFrame:
    """(cls_a, cls_b, similarity) of the pairs (a, b) that reach the threshold. Every text that is in a pair is read and hashed
    once; its set of runs then goes to its pairs."""
    pairs = stored(pairs, "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
    sets = stored(texts_of(src, n, wanted).mapInPandas(_run_sets(k), "tid long, runs binary"), "run-sets")
    both = pairs.join(sets.toDF("a", "runs_a"), "a").join(sets.toDF("b", "runs_b"), "b")
    found = both.select(F.col("a").alias("cls_a"), F.col("b").alias("cls_b"), _similarity("runs_a", "runs_b").alias("similarity"))
    return found.where(F.col("similarity") >= threshold)


def near_duplicate_links(df: DataFrame, id_col: str, text_cols: list[str], *, k: int = 5, threshold: float = 0.8, min_words: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: members (record, field, held, cls) has each record's class of identical texts (by words) in each text
    column, links (field, cls_a, cls_b, similarity) the pairs of classes whose similarity is at least ``threshold``.
    A class is named by ``min(record) * len(text_cols) + field``.

    ``id_col`` must be an integer; rows whose id is null are ignored, repeated rows count once. Null, empty and short texts
    (under ``min_words`` or ``k`` words) have no class. Other columns are not read.
    """
    n, segments = len(text_cols), segments_for(threshold)
    src = sources(df, id_col, text_cols)
    members, reps = text_classes(src, n, k=k, min_words=min_words, symbols=segments * SYMBOLS)
    shared = variants(reps, segments)
    links = _verified(likely(pairs_of(shared), reps, threshold, segments), src, n, k, threshold)
    return members, links.select(F.expr(f"cast(cls_a % {n} as int)").alias("field"), "cls_a", "cls_b", "similarity")


def near_duplicate_groups(df: DataFrame, id_col: str, text_cols: list[str], *, k: int = 5, threshold: float = 0.8, min_words: int = 1) -> DataFrame:
    """(record, group, copies): the group of each record (its smallest member) over all text columns, and the number of other records
    with one of its texts. Records without any link are their own group with 0 copies. Arguments and special cases as in
    ``near_duplicate_links``; every link that it finds lies within a group.

    The groups need a spanning set of links only. First each key's classes are compared with the key's smallest class, so that a
    template of n variants costs n comparisons a key. Then, of the keys whose classes aren't all in one component yet, those outside
    the key's largest component are compared with all of the key in other components: what is left out would join what is joined.
    """
    n, segments = len(text_cols), segments_for(threshold)
    src = sources(df, id_col, text_cols)
    members, reps = text_classes(src, n, k=k, min_words=min_words, symbols=segments * SYMBOLS)
    members = stored(members, "members")
    shared = variants(reps, segments)
    star = shared.groupBy("key").agg(F.min("cls").alias("a")).join(shared.select("key", F.col("cls").alias("b")), "key").where("a < b").select("a", "b").distinct()
    # A record ties its classes of different columns together only at the end, so that a key's components are those of its texts.
    edges = cut(_verified(likely(star, reps, threshold, segments), src, n, k, threshold).select("cls_a", "cls_b"))
    at = components(edges.toDF("u", "v")).toDF("cls", "comp")
    placed = shared.join(at, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    outside = F.sum("n") - F.max("n")  # classes beside the largest component: their number decides on the blocks
    main = sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), outside.alias("size")).where("size > 0")
    open_keys = stored(placed.drop("size").join(main, "key"), "open-keys")
    rest = _met(open_keys.where("comp <> main"), open_keys, "x.comp <> y.comp and (y.comp = y.main or x.cls < y.cls)").distinct()
    more = _verified(likely(rest, reps, threshold, segments), src, n, k, threshold).select("cls_a", "cls_b")
    # A star from each class to its records keeps that linear.
    every = edges.union(more).toDF("u", "v").union(members.select(F.col("cls").alias("u"), (-F.col("record") - 1).alias("v")))
    roots = components(every)
    copies = members.join(members.groupBy("cls").agg(F.count("*").alias("size")), "cls").groupBy("record").agg(F.sum(F.col("size") - 1).alias("copies"))
    groups = members.select("record", "cls").join(roots.select(F.col("node").alias("cls"), "root"), "cls").groupBy("record").agg(F.min("root").alias("root"))
    names = groups.groupBy("root").agg(F.min("record").alias("group"))
    found = groups.join(names, "root").join(copies, "record").select("record", "group", "copies")
    all_records = df.select(F.col(id_col).cast("long").alias("record")).where("record is not null").distinct()
    return all_records.join(found, "record", "left").select("record", F.coalesce("group", "record").alias("group"), F.coalesce("copies", F.lit(0)).cast("long").alias("copies"))


def near_duplicate_pairs(df: DataFrame, id_col: str, text_cols: list[str], *, k: int = 5, threshold: float = 0.8, min_words: int = 1) -> DataFrame:
    """(row_a, row_b), row_a < row_b: every pair of records with nearly the same text in one of the columns, those with
    identical texts included. As many rows as there are pairs; ``near_duplicate_groups`` is the linear form."""
    members, links = near_duplicate_links(df, id_col, text_cols, k=k, threshold=threshold, min_words=min_words)
    members = stored(members.select("record", "cls"), "members")
    a, b = members.select(F.col("record").alias("x"), F.col("cls").alias("cls_a")), members.select(F.col("record").alias("y"), F.col("cls").alias("cls_b"))
    near = links.select("cls_a", "cls_b").join(a, "cls_a").join(b, "cls_b").where("x <> y").select(F.least("x", "y").alias("row_a"), F.greatest("x", "y").alias("row_b"))
    same = a.join(b, F.expr("cls_a = cls_b and x < y")).select(F.col("x").alias("row_a"), F.col("y").alias("row_b"))
    return near.union(same).distinct()
