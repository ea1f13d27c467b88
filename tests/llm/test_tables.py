"""Caps, splits, persons and packing against brute force and by their invariants."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.cap import cap_contributors
from corpusloom.llm.packing import pack, plan
from corpusloom.llm.people import account_key, name_key, person_keys, persons
from corpusloom.llm.splits import QUARANTINE, ComponentTable, assign_splits, code_node, together

PARTS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def capped(rows, cap):
    by = defaultdict(list)
    for i, w, s in rows:
        if w is not None and i is not None:
            by[w].append((-s if s is not None and s == s else math.inf, i))
    return {i for v in by.values() for _, i in sorted(v)[cap:]}


@pytest.mark.parametrize("kind", ["int", "double"])
def test_cap_equals_brute_force(spark, kind):
    rnd = random.Random(4)
    score = lambda: rnd.choice((None, 0, -5, 3, 3, 3, 10**6) if kind == "int" else (None, 0.0, -5.5, 3.25, 3.25, 1e300, float("inf")))
    rows = [(i, rnd.choice("aaaaaabbc") if i % 11 else None, score()) for i in range(300)]
    df = spark.createDataFrame(rows, f"id long, who string, score {kind}").withColumn("cut", F.lit("x")).withColumn("record", F.lit(1))
    for args, cap in (({"max_count": 7}, 7),) if kind == "double" else (({"max_share": 0.1}, 30), ({"max_share": 1e-9}, 1), ({"max_count": 1000}, 1000)):
        got = cap_contributors(df, "who", "score", "id", **args).collect()
        assert len(got) == 300 and {r["record"] for r in got if not r["kept"]} == capped(rows, cap)


def test_cap_with_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "a", 5), (None, "a", 9), (3, None, 1)], "id long, who string, score int")
    kept = Counter(r["record"] for r in cap_contributors(df, "who", "score", "id", max_count=2).collect() if r["kept"])
    assert kept == {None: 1, 3: 1}  # the null id has the best score, the two rows of id 1 don't both fit
    assert cap_contributors(df.limit(0), "who", "score", "id", max_share=0.5).count() == 0
    with pytest.raises(ValueError):
        cap_contributors(df, "who", "score", "id")


@pytest.mark.parametrize("name, want", [("By  Ann-Lee ✓", "annlee"), ("@ＡｎｎＬｅｅ", "annlee"), ("ann​lee ", "annlee"), ("Byron Lee", "byronlee"), ("by", "by"), ("✓", None), (None, None), ("Ann1", "ann1"), ("by: Ann", "ann")])
def test_name_keys(name, want):
    assert name_key(name) == want


def test_account_keys():
    assert account_key("https://x.example/u/ANN_Lee/?ref=feed") == account_key("/u/annlee/") == account_key("/u/annlee#published") == "annlee"
    assert account_key("https://x.example/script/1/") is None and account_key(None) is None


def test_persons_join_over_rows(spark):
    info = "struct<username:string,profile_url:string,pro_plan:boolean>"
    rows = [("Ann", ("ann2", None, True), None, None), ("Bob", None, None, "/u/ann2/"), (None, None, "Cy", None), (None, None, None, None), ("", (None, None, None), "", "")]
    df = spark.createDataFrame(rows, f"author string, user_info {info}, preview_author string, preview_author_url string").select(person_keys().alias("keys"))
    assert {r["node"]: r["root"] for r in persons(df).collect()} == {"ann": "ann", "ann2": "ann", "bob": "ann", "cy": "cy"}


def test_related_rows_share_a_split(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.choice("abcdefghij") + str(rnd.randrange(40)) for _ in range(rnd.choice((0, 1, 1, 2)))]) for i in range(600)] + [(601, None), (None, ["z"])]
    df = spark.createDataFrame(rows, "id long, keys array<string>")
    assigned, table = assign_splits(df, "id", "keys", PARTS)
    state = table.resolved()
    got = {r["record"]: r["split"] for r in assigned.collect()}
    assert set(got) == {r[0] for r in rows if r[0] is not None} and set(got.values()) <= set(PARTS)
    by_key = defaultdict(set)
    for i, keys in rows:
        for k in keys or ():
            if i is not None:
                by_key[k].add(got[i])
    assert all(len(s) == 1 for s in by_key.values())
    names = spark.createDataFrame([(k, k) for k in by_key], "value string, node string")
    roots = {r["node"]: r["root"] for r in state.collect()}
    assert {tuple(r) for r in together(names, state).collect()} == {(a, b) for a in by_key for b in by_key if a < b and roots[a] == roots[b]}


def test_proportions_are_met(spark):
    df = spark.range(20_000).select("id", F.array((F.col("id") % 4000).cast("string")).alias("keys"))
    assigned, _ = assign_splits(df, "id", "keys", PARTS)
    got = {r["split"]: r["count"] / 20_000 for r in assigned.groupBy("split").count().collect()}
    assert all(abs(got[s] - p) < 0.001 for s, p in PARTS.items())
    with pytest.raises(ValueError):
        assign_splits(df, "id", "keys", {"train": 0.5})


def test_splits_are_incremental(spark, tmp_path):
    halves = {"train": 0.5, "test": 0.5}
    first = spark.createDataFrame([(i, [f"k{i}"]) for i in range(40)], "id long, keys array<string>")
    assigned, table = assign_splits(first, "id", "keys", halves, ComponentTable(spark, str(tmp_path / "state")))
    old = {r["record"]: r["split"] for r in assigned.collect()}
    assert Counter(old.values()) == {"train": 20, "test": 20}
    a = next(i for i in old if old[i] == "train")
    b = next(i for i in old if old[i] == "test")
    same = [i for i in old if old[i] == "train" and i != a][:2]
    second = spark.createDataFrame([(100, [f"k{a}", f"k{b}"]), (101, [f"k{same[0]}", "n1"]), (102, ["n1", f"k{same[1]}"]), (103, ["n2"])], "id long, keys array<string>")
    table = ComponentTable(spark, str(tmp_path / "state"))
    assert table.batches() == 1
    assigned, table = assign_splits(second, "id", "keys", halves, table)
    got = {r["record"]: r["split"] for r in assigned.collect()}
    assert got[100] == QUARANTINE and got[101] == got[102] == "train" and got[103] == "test"  # the test split has less
    splits = {r["node"]: r["split"] for r in table.resolved().collect()}
    assert splits[f"k{a}"] == splits[f"k{b}"] == QUARANTINE and set(splits) == {f"k{i}" for i in range(40)} | {"n1", "n2"}
    assert all(splits[f"k{i}"] == old[i] for i in old if i not in (a, b))
    assert {r["record"]: r["split"] for r in table.splits_of(first, "id", "keys").collect()} == old | {a: QUARANTINE, b: QUARANTINE}
    assert sorted((r["batch"], r["root"], r["split"], r["n"]) for r in table.conflicts().collect()) == sorted([(2, f"k{a}", "train", 1), (2, f"k{b}", "test", 1)])
    # A third batch merges what the second merged; quarantine stays, and roots point at their tops.
    third = spark.createDataFrame([(200, ["n2", "n1"]), (201, [f"k{a}", "n3"])], "id long, keys array<string>")
    got = {r["record"]: r["split"] for r in assign_splits(third, "id", "keys", halves, table)[0].collect()}
    assert got == {200: QUARANTINE, 201: QUARANTINE}
    roots = {r["node"]: r["root"] for r in table.resolved().collect()}
    assert len({roots[x] for x in ("n1", "n2", f"k{same[0]}", f"k{same[1]}")}) == 1 and roots["n3"] == roots[f"k{a}"] == roots[f"k{b}"]
    # A batch that wasn't committed doesn't count.
    spark.createDataFrame([("zz", "zz")], "node string, root string").write.parquet(f"{table.path}/nodes/batch=4")
    assert "zz" not in {r["node"] for r in ComponentTable(spark, table.path).resolved().collect()}


def test_unequal_batches_meet_the_proportions_together(spark):
    rnd = random.Random(11)
    table, seen, n = None, Counter(), 0
    for size, alone in ((900, 100), (60, 40), (3000, 900)):
        rows = [(n + i, [f"u{n + i // rnd.choice((1, 2, 3))}"] if i >= alone else None) for i in range(size)]
        n += size
        assigned, table = assign_splits(spark.createDataFrame(rows, "id long, keys array<string>"), "id", "keys", PARTS, table)
        seen += Counter(r["split"] for r in assigned.collect())
        assert sum(seen.values()) == n and all(abs(seen[s] - p * n) <= 4 for s, p in PARTS.items())


def test_no_rows_to_split(spark):
    assigned, table = assign_splits(spark.createDataFrame([], "id long, keys array<string>"), "id", "keys", PARTS)
    assert assigned.count() == 0 and table.resolved().count() == 0 and table.batches() == 1
    assigned, table = assign_splits(spark.createDataFrame([(1, None)], "id long, keys array<string>"), "id", "keys", PARTS, table)
    assert [r["split"] for r in assigned.collect()] == ["train"]


def test_code_nodes(spark):
    long = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(long,), (long.upper().replace(" ", "\n\t"),), (long[:-4],), (None,), ("",)], "c string")
    a, b, c, d, e = (r[0] for r in df.select(code_node("c")).collect())
    assert a == b and a is not None and c is d is e is None


def test_plan_fills_bins():
    rnd = random.Random(7)
    for capacity, lengths in ((10, [10] * 3 + [7] * 5 + [3] * 4 + [1] * 2), (100, [rnd.randint(1, 100) for _ in range(3000)]), (50, [26] * 100)):
        slots, bins = plan(dict(Counter(lengths)), capacity)
        used, seen = Counter(), Counter()
        for length, lo, hi, first, each, offset in slots:
            for r in range(lo, hi):
                used[first + (r - lo) // each] += length
                seen[length] += 1
        assert seen == Counter(lengths) and max(used.values()) <= capacity and len(used) == bins
        if capacity == 100:
            assert bins <= math.ceil(sum(lengths) / capacity) * 1.05
    assert plan({}, 8) == ([], 0)


def test_packed_pieces_do_not_overlap(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.choice((0, 1, 5, 5, 5, 5, 17, 63, 64, 65, 200, None))) for i in range(500)] + [(None, 5), (3, 5), (3, 5)]
    df = spark.createDataFrame(rows, "id long, n int").withColumn("rank", F.lit(1)).withColumn("length", F.lit("x"))
    got = pack(df, "id", "n", 64).collect()
    at = defaultdict(list)
    for r in got:
        if r["sequence"] is not None:
            at[r["sequence"]].append((r["offset"], r["length"]))
    for spans in at.values():
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= 64
    assert sum(r["length"] for r in got) == sum(n or 0 for _, n in rows)
    assert sum(r["length"] == 0 for r in got) == sum(not n for _, n in rows)
    assert all(r["piece"] == 0 for r in got if r["length"] < 64 and dict(rows).get(r["id"], 99) not in (65, 200))
    assert pack(df.limit(0), "id", "n", 64).count() == 0
