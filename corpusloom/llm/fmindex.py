"""A compressed full-text index of word sequences: Burrows-Wheeler transform in a wavelet matrix, with a sampled suffix array."""

from __future__ import annotations

import io

import numpy as np

from corpusloom.llm.words import run_hashes

#: Every fourth text position keeps its suffix-array entry; the others are walked to one.
SAMPLE = 4


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By prefix doubling, in which only suffixes that aren't told apart yet are sorted again: as many rounds as the logarithm of
    the longest repeat, each over what still repeats. The rank of a suffix is the first place of its group."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank, live, new, h = np.empty(n, dtype=np.int64), np.arange(n), np.concatenate([[True], np.diff(seq[order]) != 0])[:n], 1
    at = order
    while len(live):
        order[live] = at
        rank[at] = np.maximum.accumulate(np.where(new, live, 0))
        single = new & np.concatenate([new[1:], [True]])
        live, at = live[~single], at[~single]
        key = rank[at] * (n + 1)
        inside = at + h < n
        key[inside] += rank[at[inside] + h] + 1
        by = np.argsort(key, kind="stable")
        at, key, h = at[by], key[by], h * 2
        new = np.concatenate([[True], key[1:] != key[:-1]])[: len(at)]
    return order


class Bits:
    """A bit vector with constant-time rank: packed words and the ones before each word."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        return cls(np.packbits(padded, bitorder="little").view(np.uint64))

    def unpacked(self, n: int) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=n, bitorder="little")

    def rank(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class FmIndex:
    """Over texts given as arrays of 64-bit word hashes. Symbol 1 ends each text and 0 the sequence; neither is searched for.

    Beside the transform it keeps two small tables made from it: the intervals of all pairs of words, from which backward search
    starts, and a bitmap of the hashes of all runs of ``k`` words, which tells most absent runs without a search. The texts
    themselves are not kept: ``extract`` reads them back from the transform.
    """

    def __init__(self, texts: list[np.ndarray], k: int) -> None:
        self.k = k
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)  # of each text in the sequence
        self.vocabulary = np.unique(np.concatenate(texts)) if len(texts) else np.empty(0, dtype=np.uint64)
        n, sigma = int(self.starts[-1]) + 1, len(self.vocabulary) + 2
        seq, runs = np.ones(n, dtype=np.int64), []
        seq[-1] = 0
        for s, t in zip(self.starts, texts):
            seq[s : s + len(t)] = np.searchsorted(self.vocabulary, t) + 2
            runs.append(np.unique(run_hashes(t, k)))
        self.runs = np.array([len(r) for r in runs], dtype=np.int32)  # distinct runs of each text
        every = np.concatenate(runs) if runs else np.empty(0, dtype=np.uint64)
        self.bits = max(10, int(len(every) * 16 - 1).bit_length())
        bitmap = np.zeros(1 << self.bits, dtype=bool)
        bitmap[(every >> np.uint64(64 - self.bits)).astype(np.int64)] = True
        self.bitmap = np.packbits(bitmap, bitorder="little")
        sa = suffix_array(seq)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])  # C: suffixes that start with a smaller symbol
        pair = seq[sa] * sigma + seq[(sa + 1) % n]
        begins = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        self.pairs, self.pair_at = pair[begins], np.concatenate([begins, [n]]).astype(np.int32)
        marked = sa % SAMPLE == 0
        self.marks, self.samples = Bits.of(marked), sa[marked].astype(np.int32)
        level = seq[sa - 1]
        self.levels, self.zeros, depth = [], [], self._depth(sigma)
        for d in range(depth - 1, -1, -1):
            bit = (level >> d) & 1
            self.levels.append(Bits.of(bit))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        self._prepare()

    @staticmethod
    def _depth(sigma: int) -> int:
        return max(1, int(sigma - 1).bit_length())

    def _prepare(self) -> None:
        sigma = len(self.vocabulary) + 2
        self.sigma, self.depth = sigma, self._depth(sigma)
        self.base = self._down(np.arange(sigma, dtype=np.int64), np.zeros(sigma, dtype=np.int64))

    def dumped(self) -> bytes:
        out = io.BytesIO()
        levels = np.stack([b.words for b in self.levels])
        np.savez(out, k=self.k, bits=self.bits, starts=self.starts, vocabulary=self.vocabulary, runs=self.runs, bitmap=self.bitmap, first=self.first, pairs=self.pairs, pair_at=self.pair_at, marks=self.marks.words, samples=self.samples, levels=levels, zeros=np.array(self.zeros))
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> FmIndex:
        self, z = cls.__new__(cls), np.load(io.BytesIO(data))
        self.k, self.bits = int(z["k"]), int(z["bits"])
        for name in ("starts", "vocabulary", "runs", "bitmap", "first", "pairs", "pair_at", "samples"):
            setattr(self, name, z[name])
        self.marks, self.levels, self.zeros = Bits(z["marks"]), [Bits(w) for w in z["levels"]], [int(x) for x in z["zeros"]]
        self._prepare()
        return self

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - level)) & 1 == 1, zeros + ones, i - ones)
        return i

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words, -1 for those no indexed text has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, -1)

    def may_hold(self, runs: np.ndarray) -> np.ndarray:
        """Whether an indexed text may have these runs (hashes); all that are there, and at most a sixteenth of the others."""
        spot = (runs >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1

    def back(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes c·w of those intervals [lo, hi) of suffixes w."""
        at = self.first[c] - self.base[c]
        return at + self._down(c, lo), at + self._down(c, hi)

    def intervals(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[lo, hi) of the suffixes that start with each run (a row of symbols, -1 anywhere matches nothing)."""
        lo, hi = np.zeros(len(runs), dtype=np.int64), np.zeros(len(runs), dtype=np.int64)
        live = np.flatnonzero((runs >= 0).all(axis=1))
        if not len(live):
            return lo, hi
        if runs.shape[1] == 1:
            c = runs[live, 0]
            lo[live], hi[live] = self.first[c], self.first[c + 1]
            return lo, hi
        pair = runs[live, -2] * self.sigma + runs[live, -1]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        there = self.pairs[at] == pair
        live, at = live[there], at[there]
        lo[live], hi[live] = self.pair_at[at], self.pair_at[at + 1]
        for j in range(runs.shape[1] - 3, -1, -1):
            a, b = self.back(runs[live, j], lo[live], hi[live])
            lo[live], hi[live] = a, b
            live = live[b > a]
        return lo, np.maximum(lo, hi)

    def _step(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of suffix-array rows the symbol before each suffix, and the row of the suffix that starts with it."""
        i, c = rows, np.zeros(len(rows), dtype=np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            b, ones = bits.get(i), bits.rank(i)
            c, i = (c << 1) | b, np.where(b == 1, zeros + ones, i - ones)
        return c, self.first[c] + i - self.base[c]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        rows, out, walked = rows.copy(), np.full(len(rows), -1, dtype=np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.marks.get(rows[todo]) == 1
            done = todo[hit]
            out[done] = self.samples[self.marks.rank(rows[done])] + walked
            todo = todo[~hit]
            rows[todo] = self._step(rows[todo])[1]
            walked += 1
        return out

    def extract(self, texts: np.ndarray) -> list[np.ndarray]:
        """The words (hashes) of texts by number, read back from the sampled positions, all at once."""
        n = int(self.starts[-1]) + 1
        row_of = np.empty(len(self.samples), dtype=np.int64)
        row_of[self.samples // SAMPLE] = np.flatnonzero(self.marks.unpacked(n))
        lo, hi = self.starts[texts], self.starts[texts + 1] - 1
        # Every sampled position from the first after a text's begin to the first at or after its end; a text's last words may
        # lie before the next sample, which stands in the following text, or before the sequence's end, that is before position 0.
        a, b = lo // SAMPLE + 1, (hi + SAMPLE - 1) // SAMPLE
        count = np.maximum(b - a + 1, 0)
        sample = np.repeat(a - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
        wrapped = sample >= len(row_of)
        steps = np.where(wrapped, (n - 1) % SAMPLE + 1, SAMPLE)
        rows, at = row_of[np.where(wrapped, 0, sample)], np.where(wrapped, n, sample * SAMPLE)
        place, word = [], []
        for _ in range(SAMPLE):
            go = steps > 0
            rows, at, steps = rows[go], at[go] - 1, steps[go] - 1
            c, rows = self._step(rows)
            place.append(at)
            word.append(c)
        place, first = np.unique(np.concatenate(place), return_index=True)
        word = np.concatenate(word)[first]
        begin, end = np.searchsorted(place, lo), np.searchsorted(place, hi)
        return [self.vocabulary[word[x:y] - 2] for x, y in zip(begin, end)]

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1
