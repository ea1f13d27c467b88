"""Same or nearly the same records across splits, by a compressed full-text index of the evaluation texts.

The texts of the evaluation splits lie in shards of a bounded number of words. Each shard's FM-index is built once, by one task,
and stored in the shared folder. Training texts stream past it in blocks of a bounded number of words; a task reads one index
after the other, so neither texts nor indexes are shuffled for the search. For a block and an index:

* The bitmap of the index tells most runs of ``k`` words that no indexed text has. A pair of similarity t shares at least t of
  the training text's distinct runs, so texts with fewer that may be there are done with.
* Backward search gives the number of occurrences of every other run. Of the n distinct runs of a text at most n - t n are
  missing in its partner, so of its n - t n + m rarest ones (those that don't occur at all come first) at least m must occur
  there. Only these are located, and texts hit by fewer than m of them are done with.
* The texts that are left are read back from the index, and the exact similarity decides. From each hit the match is extended to a
  maximal one, and spans are merged and counted.

Each step only leaves out what can't reach the threshold, so no pair is lost. The work is that of all training texts with every
shard: it grows with the training words times the number of shards, most of it being the look into the bitmap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import words as W
from corpusloom.llm.fmindex import FmIndex
from corpusloom.llm.neardup import sources, text_classes
from corpusloom.session import stored, stored_at

#: Words of evaluation text in one index, and of training texts in a block.
SHARD_WORDS, BLOCK_WORDS = 2_000_000, 1_000_000
#: Hits asked of a pair beyond the one that must be there, as a share of the text's distinct runs; located occurrences held at once.
MORE, AT_ONCE = 0.05, 1_000_000
_MATCHES = "train long, held long, similarity double, spans int, longest int, covered int"
_INDEX = "field int, shard int, tids binary, data binary"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _extended(a: np.ndarray, b: np.ndarray, at: int, to: int) -> tuple[int, int]:
    """The maximal match of ``a`` and ``b`` around a common run at ``a[at]`` and ``b[to]``, as a span of ``a``."""
    left = min(at, to)
    other = np.flatnonzero(a[at - left : at][::-1] != b[to - left : to][::-1])
    lo = at - (int(other[0]) if len(other) else left)
    right = min(len(a) - at, len(b) - to)
    other = np.flatnonzero(a[at : at + right] != b[to : to + right])
    return lo, at + (int(other[0]) if len(other) else right)


def _maximal(a: np.ndarray, b: np.ndarray, k: int, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal matches of two texts as spans of ``a``: from the located hits, and from the runs that were too common to be
    located, each with its first place in ``b``."""
    spans = [_extended(a, b, i, j) for i, j in hits]
    x, y = W.run_hashes(a, k), W.run_hashes(b, k)
    values, first = np.unique(y, return_index=True)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    done = -1
    for i in np.flatnonzero(values[at] == x):
        if i > done:
            spans.append(_extended(a, b, int(i), int(first[at[i]])))
            done = spans[-1][1] - k
    return spans


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.empty(0, dtype=np.int64)


def _portions(sizes: np.ndarray, most: int) -> list[slice]:
    """Slices of consecutive items whose sizes add up to ``most`` or less, single items that are larger apart."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total + n > most and i > begin:
            out.append(slice(begin, i))
            begin, total = i, 0
        total += n
    return [*out, slice(begin, len(sizes))] if len(sizes) else []


class _Block:
    """Training texts (arrays of word hashes) with their distinct runs, prepared once for all indexes."""

    def __init__(self, texts: list[np.ndarray], k: int) -> None:
        self.texts, self.k = texts, k
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.begins, self.flat = _offsets(sizes), np.concatenate(texts)
        owner = np.repeat(np.arange(len(texts)), sizes)
        n = max(0, len(self.flat) - k + 1)
        spots = np.flatnonzero(owner[:n] == owner[k - 1 :]) if n else np.empty(0, dtype=np.int64)
        hashes = W.run_hashes(self.flat, k)[spots]
        order = np.lexsort((hashes, owner[spots]))
        own, runs = owner[spots][order], hashes[order]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (runs[1:] != runs[:-1])]) if len(own) else np.empty(0, dtype=bool)
        self.own, self.runs, self.spots = own[fresh], runs[fresh], spots[order][fresh]  # by text and hash; a run's first place
        self.count = np.bincount(self.own, minlength=len(texts))
        self.first = _offsets(self.count)


def matches(index: FmIndex, block: _Block, threshold: float) -> list[tuple[int, int, float, int, int, int]]:
    """(text of the block, text of the index, similarity, spans, longest, covered) of the pairs of texts that reach the threshold:
    the number of merged spans of maximal matches in the block's text, the words of the longest and of all."""
    k, own, many = block.k, block.own, len(block.texts)
    need = np.ceil(threshold * block.count - 1e-9).astype(np.int64)
    sel = np.flatnonzero(index.may_hold(block.runs))
    sel = sel[(np.bincount(own[sel], minlength=many) >= need)[own[sel]]]
    if not len(sel):
        return []
    # Each different run is searched once.
    run, which = np.unique(block.runs[sel], return_inverse=True)
    example = np.empty(len(run), dtype=np.int64)
    example[which] = block.spots[sel]
    lo, hi = index.intervals(index.ids(block.flat[example[:, None] + np.arange(k)]))
    width = (hi - lo)[which]
    sel, which, width = sel[width > 0], which[width > 0], width[width > 0]
    present = np.bincount(own[sel], minlength=many)
    keep = (present >= need)[own[sel]]
    sel, which, width = sel[keep], which[keep], width[keep]
    rare = np.lexsort((width, own[sel]))
    sel, which, width = sel[rare], which[rare], width[rare]
    text = own[sel]
    here = np.bincount(text, minlength=many)
    asked = np.minimum(need, np.maximum(1, np.ceil(MORE * block.count).astype(np.int64)))
    place = np.arange(len(sel)) - _offsets(here)[text] + (block.count - present)[text]
    chosen = place < (block.count - need + asked)[text]
    sel, which, width, text = sel[chosen], which[chosen], width[chosen], text[chosen]
    if not len(sel):
        return []
    # Every chosen run is located once; of its places in an indexed text the first stands for all.
    run, which = np.unique(which, return_inverse=True)
    pos, spread = _located(index, lo[run], hi[run] - lo[run])
    there = index.text_of(pos)
    per = spread[which + 1] - spread[which]
    ends = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]])) + 1
    begins = np.concatenate([[0], ends[:-1]])
    keys: list[np.ndarray] = []
    hits: list[np.ndarray] = []
    held = len(index.runs)
    for portion in _portions(np.add.reduceat(per, begins), AT_ONCE):  # whole texts
        span = slice(int(begins[portion.start]), int(ends[portion.stop - 1]))
        key, count = _counted(text[span], which[span], per[span], spread, there, held)
        t, e = key // held, key % held
        key = key[(count >= asked[t]) & (index.runs[e] >= threshold * block.count[t] - 1e-9) & (block.count[t] >= threshold * index.runs[e] - 1e-9)]
        some = np.flatnonzero(np.isin(text[span], key // held)) + span.start
        for piece in _portions(per[some], AT_ONCE):
            entry, place = _expanded_places(some[piece], which, per, spread)
            pair = text[entry] * held + there[place]
            good = np.isin(pair, key)
            own_place = block.spots[sel[entry[good]]] - block.begins[text[entry[good]]]
            hits.append(np.stack([pair[good], own_place, pos[place[good]] - index.starts[there[place[good]]]]))
        keys.append(key)
    pairs = np.concatenate(keys)
    if not len(pairs):
        return []
    hit = np.concatenate(hits, axis=1)
    hit = hit[:, np.lexsort((hit[1], hit[2] - hit[1], hit[0]))]
    # Hits on one diagonal mostly lie in one match.
    hit = hit[:, np.concatenate([[True], (np.diff(hit[0]) != 0) | (np.diff(hit[2] - hit[1]) != 0)])]
    out = []
    for some in np.array_split(pairs, len(pairs) // 20_000 + 1):  # texts are read back in bounded portions
        different = np.unique(some % held)
        words = dict(zip(different.tolist(), index.extract(different)))
        sets = {e: np.unique(W.run_hashes(w, k)) for e, w in words.items()}
        for pair in some.tolist():
            t, e = divmod(pair, held)
            s = W.jaccard(block.runs[block.first[t] : block.first[t] + block.count[t]], sets[e])
            if s >= threshold:
                a, b = np.searchsorted(hit[0], [pair, pair + 1])
                spans = _merged(_maximal(block.texts[t], words[e], k, list(zip(hit[1, a:b].tolist(), hit[2, a:b].tolist()))))
                out.append((t, e, s, len(spans), max(y - x for x, y in spans), sum(y - x for x, y in spans)))
    return out


def _located(index: FmIndex, lo: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, spread)``: the positions of interval i, one for each text, are those from ``spread[i]`` to ``spread[i + 1]``.
    Intervals of different runs don't overlap, so they have as many rows as the index at most."""
    owner = np.repeat(np.arange(len(width)), width)
    rows = np.repeat(lo - _offsets(width), width) + np.arange(int(width.sum()))
    pos = np.concatenate([index.locate(rows[i : i + AT_ONCE]) for i in range(0, len(rows), AT_ONCE)])
    order = np.lexsort((pos, owner))
    owner, pos = owner[order], pos[order]
    text = index.text_of(pos)
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])])
    return pos[first], np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(width)))])


def _expanded_places(entries: np.ndarray, which: np.ndarray, per: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each entry as often as its run was located, and those places."""
    n = per[entries]
    return np.repeat(entries, n), np.repeat(spread[which[entries]] - _offsets(n), n) + np.arange(int(n.sum()))


def _counted(text: np.ndarray, which: np.ndarray, per: np.ndarray, spread: np.ndarray, there: np.ndarray, held: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (text * held + indexed text) that have a run in common, and the number of different ones."""
    keys, counts = [], []
    for piece in _portions(per, AT_ONCE):
        entry, place = _expanded_places(np.arange(piece.start, piece.stop), which, per, spread)
        key, count = np.unique(text[entry] * held + there[place], return_counts=True)
        keys.append(key)
        counts.append(count)
    if len(keys) == 1:
        return keys[0], counts[0]
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)


def _built(k: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        hasher = W.WordHasher()
        group = group.sort_values("tid")
        data = FmIndex([hasher(W.words(t)) for t in group["text"]], k).dumped()
        return pd.DataFrame([(*key, group["tid"].to_numpy(dtype=np.int64).tobytes(), data)], columns=["field", "shard", "tids", "data"])

    return run


def _indexes(path: str, field: int) -> Iterator[tuple[np.ndarray, FmIndex]]:
    """The stored indexes of a field, one after the other, from any file system that Arrow knows (file, hdfs, s3, gs)."""
    import pyarrow.dataset as ds
    from pyarrow.fs import FileSystem

    system, root = FileSystem.from_uri(path)
    for fragment in ds.dataset(root, filesystem=system, format="parquet", partitioning="hive").get_fragments(ds.field("field") == field):
        for batch in fragment.to_batches(columns=["tids", "data"], batch_size=1):
            for tids, data in zip(batch["tids"], batch["data"]):
                yield np.frombuffer(tids.as_py(), dtype=np.int64), FmIndex.loaded(data.as_py())


def _search(path: str, fields: list[int], k: int, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = W.WordHasher()
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {f: [] for f in fields}

        def searched(field: int) -> pd.DataFrame:
            tids, texts = zip(*waiting[field])
            waiting[field], found = [], []
            block = _Block(list(texts), k)
            for held, index in _indexes(path, field):
                found += [(tids[m[0]], int(held[m[1]]), *m[2:]) for m in matches(index, block, threshold)]
            return pd.DataFrame(found, columns=["train", "held", "similarity", "spans", "longest", "covered"])

        size = dict.fromkeys(fields, 0)
        for batch in batches:
            for tid, field, text in zip(batch["tid"], batch["field"], batch["text"]):
                if field in waiting:
                    ws = hasher(W.words(text))
                    waiting[field].append((int(tid), ws))
                    size[field] += len(ws)
                    if size[field] >= BLOCK_WORDS:
                        yield searched(field)
                        size[field] = 0
        for field in fields:
            if waiting[field]:
                yield searched(field)

    return run


def cross_split_matches(df: DataFrame, id_col: str, text_cols: list[str], split: str, *, train: str = "train", held_out: tuple[str, ...] = ("val", "test"), k: int = 5, threshold: float = 0.8, min_words: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(members, found)``: members (record, field, held, cls) gives each record's class of identical texts, apart for training
    and evaluation records; found (train, held, similarity, spans, longest, covered) the pairs of classes that are nearly the
    same, identical texts included. See ``cross_split_pairs`` for the arguments and special cases."""
    n, spark = len(text_cols), df.sparkSession
    src = sources(df.where(F.col(split).isin(train, *held_out)), id_col, text_cols, F.col(split) != train)
    members, classes = text_classes(src, n, k=k, min_words=min_words)
    # The first text of each class, shuffled once for both sides.
    each = [F.struct((F.col("id") * n + i).alias("tid"), F.col(f"t{i}").alias("text")) for i in range(n)]
    texts = src.select(F.explode(F.array(*each)).alias("t")).select("t.*").where("text is not null")
    kept = classes.select(F.col("cls").alias("tid"), "field", "held", "n")
    words = {r["field"]: r["n"] for r in kept.where("held").groupBy("field").agg(F.sum("n").alias("n")).collect()}  # a row for each column
    if not words:
        return members, spark.createDataFrame([], _MATCHES)
    shards = {f: math.ceil(x / SHARD_WORDS) for f, x in words.items()}
    of = F.element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), F.col("field"))
    firsts = stored(kept.join(texts, "tid").dropDuplicates(["tid"]).select("tid", "field", "held", "text"), "texts")
    held = firsts.where("held").select("tid", "field", F.pmod(F.xxhash64("tid"), of).cast("int").alias("shard"), "text")
    path = stored_at(held.groupBy("field", "shard").applyInPandas(_built(k), _INDEX), "overlap-index", "field", "shard")
    found = firsts.where("not held").select("tid", "field", "text").mapInPandas(_search(path, sorted(shards), k, threshold), _MATCHES)
    return members, found


def _expanded(members: DataFrame, found: DataFrame) -> DataFrame:
    m = stored(members.select("record", "held", "cls"), "overlap-members")
    t, e = m.where("not held").select(F.col("record").alias("train_record"), F.col("cls").alias("train")), m.where("held").select(F.col("record").alias("held_record"), F.col("cls").alias("held"))
    return found.select("train", "held").join(t, "train").join(e, "held").select("train_record", "held_record").distinct()


def cross_split_pairs(df: DataFrame, id_col: str, text_cols: list[str], split: str, **options) -> DataFrame:
    """(train_record, held_record): all pairs of a training and an evaluation record with the same or nearly the same text in one
    of the columns: their distinct runs of ``k`` words have a similarity of ``threshold`` or more, and both have ``min_words``.

    ``id_col`` must be an integer; rows with a null id or a split that is null or not named are ignored; repeated rows count
    once. Null, empty and short texts match nothing. Empty tables give no rows. Other columns are not read.
    """
    return _expanded(*cross_split_matches(df, id_col, text_cols, split, **options))


def cross_split_report(df: DataFrame, id_col: str, text_cols: list[str], split: str, source: str, **options) -> DataFrame:
    """(split, source, records, overlapping, partners): for each evaluation split and source its records, those that overlap the
    training split, and the links they have. Links are counted by class, copies are not expanded."""
    members, found = cross_split_matches(df, id_col, text_cols, split, **options)
    members, found = stored(members, "overlap-members"), stored(found, "overlap-found")
    copies = members.where("not held").groupBy(F.col("cls").alias("train")).agg(F.count("*").alias("copies"))
    per_class = found.join(copies, "train").groupBy(F.col("held").alias("cls")).agg(F.sum("copies").alias("links"))
    per_record = members.where("held").join(per_class, "cls").groupBy("record").agg(F.sum("links").alias("links"))
    held_out = options.get("held_out", ("val", "test"))
    rows = df.where(F.col(split).isin(*held_out)).select(F.col(id_col).cast("long").alias("record"), F.col(split).alias("split"), F.col(source).alias("source"))
    return rows.join(per_record, "record", "left").groupBy("split", "source").agg(F.count("*").alias("records"), F.count("links").alias("overlapping"), F.coalesce(F.sum("links"), F.lit(0)).alias("partners"))
