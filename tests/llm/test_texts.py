"""Near-duplicates, cross-split overlaps and the index against brute force."""

import random

import numpy as np
import pytest

from corpusloom.llm import neardup, overlap
from corpusloom.llm import words as W
from corpusloom.llm.components import components
from corpusloom.llm.fmindex import FmIndex, suffix_array
from corpusloom.llm.neardup import near_duplicate_groups, near_duplicate_pairs, segments_for
from corpusloom.llm.overlap import cross_split_pairs, cross_split_report
from corpusloom.llm.reduce import keep_ids

SCHEMA = "row_id long, a string, b string, split string, cls string, tid int, held string"


def runs(text, k):
    ws = W.words(text)
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def similar(x, y, k, threshold, least):
    p, q = runs(x, k), runs(y, k)
    return min(len(W.words(x)), len(W.words(y))) >= least and bool(p) and bool(q) and len(p & q) >= threshold * len(p | q)


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "文字", "x_1"]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice((10, 40, 80)))] for _ in range(12)]
    out = []
    for i in range(n):
        ws = list(rnd.choice(base))
        for _ in range(rnd.choice((0, 0, 1, 2, 4, 9))):
            at = rnd.randrange(len(ws))
            rnd.choice((lambda: ws.pop(at), lambda: ws.insert(at, rnd.choice(vocabulary)), lambda: ws.__setitem__(at, "new")))()
        t = rnd.choice((" ", ", ", "\n")).join(ws)
        out.append((i, t.upper() if i % 7 == 0 else t, rnd.choice((None, "", " ", "short text", t)), rnd.choice(("train", "val", "test", None)), "x", 1, "y"))
    return out


def brute(rows, k, threshold, least):
    near = lambda x, y: bool(x and y) and similar(x, y, k, threshold, least)
    return {(r[0], s[0]) for i, r in enumerate(rows) for s in rows[i + 1 :] if near(r[1], s[1]) or near(r[2], s[2])}


@pytest.mark.parametrize("k, threshold, least", [(3, 0.6, 30), (5, 0.8, 1)])
def test_pairs_equal_brute_force(spark, k, threshold, least):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in near_duplicate_pairs(df, "row_id", ["a", "b"], k=k, threshold=threshold, min_words=least).collect()}
    want = brute(rows, k, threshold, least)
    assert got == want and len(want) >= 10


def test_groups_are_the_components_of_the_pairs(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows + rows[:5] + [(None, "x " * 50, None, None, "", 1, "")], SCHEMA)
    got = {r["record"]: (r["group"], r["copies"]) for r in near_duplicate_groups(df, "row_id", ["a", "b"], k=3, threshold=0.6, min_words=30).collect()}
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = brute(rows, 3, 0.6, 30)
    for x, y in pairs:
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    assert {r: g for r, (g, _) in got.items()} == {r: find(r) for r in parent}
    same = {r[0]: sum(bool(r[i]) and r[i] and len(W.words(r[i])) >= 30 and W.words(r[i]) == W.words(q[i] or "") for q in rows if q[0] != r[0] for i in (1, 2)) for r in rows}
    assert {r: n for r, (_, n) in got.items()} == same


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(1, None, None, None, None, None, None), (None, None, None, None, None, None, None)], SCHEMA)
    assert near_duplicate_pairs(empty, "row_id", ["a", "b"]).count() == 0
    assert near_duplicate_groups(empty, "row_id", ["a"]).count() == 0
    assert [tuple(r) for r in near_duplicate_groups(nulls, "row_id", ["a", "b"]).collect()] == [(1, 1, 0)]
    long = " ".join(f"w{i}" for i in range(60_000))
    both = spark.createDataFrame([(1, long, None), (2, long + " end", None)], "row_id long, a string, b string")
    assert [tuple(r) for r in near_duplicate_pairs(both, "row_id", ["a"]).collect()] == [(1, 2)]


def test_segments_follow_the_threshold():
    assert segments_for(0.6) == 16 and segments_for(0.8) < segments_for(0.7) < segments_for(0.6) and segments_for(1.0) == 1


@pytest.mark.parametrize("few, block, seen", [(2, 3, 20), (2, 1000, 1), (100, 1000, 5000)])
def test_large_keys_give_the_same_pairs_and_groups(spark, monkeypatch, few, block, seen):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if rnd.random() > 0.03 else f"x{rnd.randrange(99)}" for w in base), None, None, "", 1, "") for i in range(40)]
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SEEN", seen)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 3, 0.6, 30)
    assert {tuple(r) for r in near_duplicate_pairs(df, "row_id", ["a"], k=3, threshold=0.6, min_words=30).collect()} == want and len(want) > 300
    group = {i: i for i in range(40)}
    for _ in range(40):
        for x, y in want:
            group[x] = group[y] = min(group[x], group[y])
    assert {r["record"]: r["group"] for r in near_duplicate_groups(df, "row_id", ["a"], k=3, threshold=0.6, min_words=30).collect()} == group


def test_chains_are_joined_beyond_a_keys_smallest_class(spark):
    """Neighbours are alike and others aren't, so that stars around the smallest class don't reach the ends."""
    ws = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(ws[i * 12 : i * 12 + 60]), None, None, "", 1, "") for i in range(20)]
    want = brute(rows, 3, 0.6, 30)
    assert want == {(i, i + 1) for i in range(19)}
    groups = near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), "row_id", ["a"], k=3, threshold=0.6, min_words=30).collect()
    assert {r["group"] for r in groups} == {0}


def test_five_thousand_variants_of_a_template(spark):
    rnd = random.Random(10)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(5000):
        ws = list(base)
        ws[rnd.randrange(80)] = f"n{i}"
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "row_id long, a string")
    groups = near_duplicate_groups(df, "row_id", ["a"], k=3, threshold=0.6, min_words=30)
    assert groups.groupBy("group").count().collect() == [(0, 5000)]


def test_suffix_array_and_index():
    rng = np.random.default_rng(0)
    texts = [rng.integers(1, 6, size=n).astype(np.uint64) for n in (0, 1, 5, 40, 40, 200)]
    for n in (1, 2, 50, 300):
        seq = rng.integers(0, 3, size=n)
        assert suffix_array(seq).tolist() == sorted(range(n), key=lambda i: seq[i:].tolist())
    index = FmIndex.loaded(FmIndex(texts, 3).dumped())
    for i, words in enumerate(index.extract(np.arange(len(texts)))):
        assert words.tolist() == texts[i].tolist()
    for k in (1, 2, 3, 4):
        for run in rng.integers(1, 8, size=(60, k)).astype(np.uint64):
            lo, hi = index.intervals(index.ids(run)[None, :])
            pos = index.locate(np.arange(lo[0], hi[0]))
            text = index.text_of(pos)
            want = sorted((i, j) for i, t in enumerate(texts) for j in range(len(t) - k + 1) if (t[j : j + k] == run).all())
            assert sorted(zip(text.tolist(), (pos - index.starts[text]).tolist())) == want
            assert k != 3 or not want or index.may_hold(W.run_hashes(run, 3)).all()
    none = FmIndex([], 3)
    assert none.intervals(none.ids(np.array([[1, 2, 3]], dtype=np.uint64).ravel())[None, :])[1].tolist() == [0]


def matched(held, train, k, threshold):
    return overlap.matches(FmIndex(held, k), overlap._Block(train, k), threshold)


def test_matches_have_maximal_spans():
    h = W.WordHasher()
    a = h("one two three four five six seven eight nine ten".split())
    b = h("zero one two three four five X six seven eight nine ten".split())
    assert matched([b], [a], 3, 0.5) == [(0, 0, pytest.approx(6 / 12), 2, 5, 10)]
    assert matched([b], [h(["one"])], 3, 0.5) == [] and matched([b], [h([]), a], 3, 0.5)[0][:2] == (1, 0)
    rep = h(("x y " * 30).split())
    assert matched([rep, b], [rep], 3, 0.9) == [(0, 0, 1.0, 1, 60, 60)]


@pytest.mark.parametrize("at_once, more", [(1, 0.0), (7, 0.05), (10**6, 0.5)])
def test_matches_in_portions_equal_brute_force(monkeypatch, at_once, more):
    monkeypatch.setattr(overlap, "AT_ONCE", at_once)
    monkeypatch.setattr(overlap, "MORE", more)
    h = W.WordHasher()
    texts = [h(W.words(r[1])) for r in corpus(4, 90)]
    held, train = texts[:30], texts[30:]
    for k, t in ((3, 0.6), (2, 0.8), (5, 0.5)):
        sets = lambda x: set(W.run_hashes(x, k).tolist())
        want = {(i, j) for i, x in enumerate(train) for j, y in enumerate(held) if sets(x) & sets(y) and len(sets(x) & sets(y)) >= t * len(sets(x) | sets(y))}
        assert {m[:2] for m in matched(held, train, k, t)} == want and want


@pytest.mark.parametrize("words", [200, 4_000_000])
def test_overlaps_equal_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(overlap, "SHARD_WORDS", words)
    rows = corpus(3, 80)
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)
    got = {tuple(r) for r in cross_split_pairs(df, "row_id", ["a", "b"], "split", k=3, threshold=0.6, min_words=30).collect()}
    split = {r[0]: r[3] for r in rows}
    want = set()
    for x, y in brute(rows, 3, 0.6, 30):
        for t, e in ((x, y), (y, x)):
            if split[t] == "train" and split[e] in ("val", "test"):
                want.add((t, e))
    assert got == want and want
    report = cross_split_report(df, "row_id", ["a", "b"], "split", "cls", k=3, threshold=0.6, min_words=30).collect()
    assert sum(r["overlapping"] for r in report if r["split"] == "val") >= len({e for _, e in want if split[e] == "val"})


def test_overlaps_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cross_split_pairs(empty, "row_id", ["a", "b"], "split").count() == 0
    only = spark.createDataFrame([(1, "a b c d e f g", None, "train", "", 1, ""), (None, None, None, None, None, None, None)], SCHEMA)
    assert cross_split_pairs(only, "row_id", ["a"], "split").count() == 0


def test_components_against_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 230)] + [(None, 1), (7, 7)]
    parent = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None:
            u, v = find(u), find(v)
            parent[max(u, v)] = min(u, v)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_bitmap_keeps_all_that_is_wanted(spark):
    wanted = spark.range(0, 1000, 7)
    kept = {r[0] for r in keep_ids(spark.range(1000).toDF("k"), "k", wanted).collect()}
    assert set(range(0, 1000, 7)) <= kept and len(kept) < 1000
