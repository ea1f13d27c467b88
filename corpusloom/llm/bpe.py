"""Encoding with public byte-level BPE tokenizers."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How byte-level BPE cuts text into words before merging: the published expression of this tokenizer family (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer words (in bytes) are merged with a heap instead of scans.
SHORT = 96
_NONE = 1 << 60
_CACHE_LIMIT = 1_000_000


def load_ranks(path: str = BYTE_BPE) -> dict[bytes, int]:
    """The vocabulary of a ``.tiktoken`` file: a token's bytes to its rank, which is its id."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """A contiguous array of part boundaries and one of the ranks of adjacent parts; the smallest rank is found by a scan, its
    boundary deleted and the two neighbouring ranks refreshed. Quick for short words."""
    get = ranks.get
    bounds = list(range(len(word) + 1))
    pair = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while pair:
        low = min(pair)
        if low == _NONE:
            break
        i = pair.index(low)
        del bounds[i + 1], pair[i]
        if i < len(pair):
            pair[i] = get(word[bounds[i] : bounds[i + 2]], _NONE)
        if i:
            pair[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], _NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges, leftmost of the smallest rank first, over linked parts with a heap: n log n for words of any length."""
    n, get = len(word), ranks.get
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is merged away
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:
            continue  # a part of this pair has changed since
        end[i], end[j] = stop, 0
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if (p := prev[i]) >= 0 and (r := get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return out


class Encoder:
    """Texts to ids, with a bounded cache of short words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks, self.pattern, self._known = ranks, regex.compile(pattern), {}

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        rank = self.ranks.get(raw)
        if rank is not None:
            return [rank]
        return merge_short(raw, self.ranks) if len(raw) <= SHORT else merge_long(raw, self.ranks)

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self._known, []
        if len(known) > _CACHE_LIMIT:
            known.clear()
        for match in self.pattern.finditer(text):
            w = match[0]
            ids = known.get(w)
            if ids is None:
                ids = self.word(w)
                if len(w) <= SHORT:
                    known[w] = ids
            out += ids
        return out


def _encoded(column: str, shared, pattern: str, counts_only: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(shared.value, pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):  # lists of ids are much larger than their texts
                part = batch.iloc[at : at + 256].reset_index(drop=True)
                ids = [encode(t) if isinstance(t, str) else [] for t in part[column]]
                rest = part.drop(columns=column)
                yield rest.assign(n_tokens=[len(x) for x in ids]) if counts_only else rest.assign(ids=[np.array(x, dtype=np.int32) for x in ids])

    return run


def _run(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str, counts_only: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(load_ranks(path))  # a vocabulary file: of fixed size
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    what = "n_tokens long" if counts_only else "ids array<int>"
    return rows.mapInPandas(_encoded("__text", shared, pattern, counts_only), f"__id {kind}, {what}").withColumnRenamed("__id", id_col)


def encode(df: DataFrame, id_col: str, text_col: str, path: str = BYTE_BPE, pattern: str = PATTERN) -> DataFrame:
    """(id, ids): the token ids of each row's text, without special tokens; their markers in a text are plain text. Null and
    empty texts have an empty list. One row per input row, ids null or repeated included; no shuffle. ``path`` is a
    ``.tiktoken`` vocabulary, ``pattern`` the expression that cuts its words. Other columns are not read."""
    return _run(df, id_col, text_col, path, pattern, False)


def count_tokens(df: DataFrame, id_col: str, text_col: str, path: str = BYTE_BPE, pattern: str = PATTERN) -> DataFrame:
    """(id, n_tokens): as ``encode``, but only the number of ids leaves the workers."""
    return _run(df, id_col, text_col, path, pattern, True)


def decode(ids: list[int], ranks: dict[bytes, int]) -> str:
    """The text of ids, for round trips."""
    token = {r: t for t, r in ranks.items()}
    return b"".join(token[i] for i in ids).decode("utf-8", "replace")
