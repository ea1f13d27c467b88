"""Known answers of the operators on small tables."""

import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import clean, html, prompts, score, similarity, text
from corpusloom.operators import aggregate, classify, dedup, filters, mixing, nested, select, series
from corpusloom.plans import models, pipelines
from corpusloom.queries import QUERIES
from corpusloom.session import cut, release, shared_dir, stored


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f("c").alias("r")).first()["r"]


@pytest.mark.parametrize("value, want", [(None, 0), ("", 0), ("  x y ", 2), ("a　b c d", 4), ("\x00 a", 2)])
def test_word_count(spark, value, want):
    assert one(spark, value, text.word_count) == want == len((value or "").split())


@pytest.mark.parametrize("value, want", [("f(a[1]{x})", False), ("(]", True), ("((", True), (")", True), ("", False), ("([)]", True), (None, False)])
def test_bracket_fault(spark, value, want):
    assert one(spark, value, text.bracket_fault) is want


@pytest.mark.parametrize("value, want", [("1,234 likes", 1234), ("1.2K", 1), (None, 0), ("none", 0), ("9" * 30, 0)])
def test_first_number(spark, value, want):
    assert one(spark, value, text.first_number) == want


def test_scalar_features(spark):
    assert one(spark, [" ", None], text.all_blank, "array<string>") is True
    assert one(spark, [" ", "a"], text.all_blank, "array<string>") is False
    assert one(spark, None, text.is_blank) is True
    assert one(spark, "a ```python\nx=1\n``` b ```\ny\n```", text.code_or_text) == "x=1"
    assert one(spark, "plain", text.code_or_text) == "plain"
    assert one(spark, "Rsi RSI rsi ab _x1", text.identifiers) == ["rsi", "_x1"]
    assert one(spark, "score: 7.5 of 10", lambda c: text.parsed_score(c, 1, 10, 5)) == 7.5
    assert one(spark, "no idea", lambda c: text.parsed_score(c, 1, 10, 5)) == 5
    assert one(spark, "999", lambda c: text.parsed_score(c, 1, 10, 5)) == 10
    assert one(spark, "def f(:", text.python_parses) is False
    assert one(spark, "x = 1", text.python_parses) is True


def test_cleaning(spark):
    code = "p_sma = plot(x)\n  plotshape(y)\nz = plot_value\n// === Visual part\nif a // b\n\nc = 'https://x'"
    assert one(spark, code, lambda c: clean.drawing_removed(c)["cleaned"]) == "z = plot_value\nif a // b\n\nc = 'https://x'"
    assert one(spark, code, lambda c: clean.drawing_removed(c)["removed"]) == 3
    assert one(spark, "a //x\n\n/* b */c\n/* d\ne */f", clean.comments_stripped) == "a \nc\nf"
    assert one(spark, " A\t b\n", clean.dedup_key) == "a b"
    assert one(spark, None, clean.dedup_key) is None


def test_filters_keep_their_strictness(spark):
    rows = spark.createDataFrame([(1, 10, "w " * 60), (2, 11, "w " * 60), (3, None, None)], "id int, likes int, d string")
    got = dict(rows.select("id", filters.all_reasons(filters.threshold_checks("likes", "d"))).collect())
    assert got == {1: "low_likes", 2: "", 3: "low_likes, few_words, few_chars"}
    seg = spark.createDataFrame([("Note: (if the price falls)",), ("// only a comment here",), ("x = ta.sma(close, 20)",), ("x=1",), (None,)], "c string")
    assert [r[0] for r in seg.select(filters.valid_code("c")).collect()] == [False, False, True, False, False]


def test_longest_description_stays_first_of_ties(spark):
    rows = spark.createDataFrame([(1, "a", "X = 1"), (2, "bbb", "x  =  1"), (3, "ccc", "x = 1 "), (4, "d", None), (5, None, None)], "pos int, d string, c string")
    assert {r["pos"] for r in dedup.keep_longest(rows, "c", "d", "pos").collect()} == {2, 4}


def test_dissimilar_rows(spark):
    rows = spark.createDataFrame([("s", 1, "abcdefghij" * 3), ("s", 2, "abcdefghij" * 3 + "x"), ("s", 3, "0123456789"), ("t", 4, "abcdefghij" * 3)], "g string, p int, c string")
    assert {r["p"] for r in dedup.keep_dissimilar(rows, "g", "p", "c").collect()} == {1, 3, 4}


def test_dissimilar_rows_of_large_groups(spark):
    """Both paths, with null and empty codes, repeats and chains of similar codes; null is a group."""
    codes = [None, "", "abcdefghij" * 3, "ABCDEFGHIJ" * 3, "abcdefghij" * 3 + "x" * 8, "abcdefghij" * 3 + "x" * 16, "0123456789", "abcdefghij" * 3 + "x", "0123 456789"]
    rows = spark.createDataFrame([(g, 100 * k + i, c) for k, g in enumerate((None, "unknown", "s")) for i, c in enumerate(codes)] + [("t", 900, "x"), ("t", 901, "x")], "g string, p int, c string")
    want = sorted(r["p"] for r in dedup.keep_dissimilar(rows, "g", "p", "c").collect())
    assert [p for p in want if p < 100] == [0, 2, 5, 6] and len(want) == 13
    assert sorted(r["p"] for r in dedup.keep_dissimilar(rows, "g", "p", "c", small=2).collect()) == want


def test_dissimilar_parts_judges_every_segment(spark):
    segments = spark.read.parquet("/root/testdata/sf0.01/segments.parquet")
    kept = QUERIES["dissimilar_parts"](spark, "/root/testdata/sf0.01")
    assert {r[0] for r in segments.select("source_id").distinct().collect()} == {r[0] for r in kept.select("source_id").distinct().collect()} >= {None, "unknown"}


@pytest.mark.parametrize("share, a, b", [(0.5, 4, 4), (0.3, 4, 6), (0.8, 4, 0), (1.0, 4, 0), (0.0, 0, 6)])
def test_mix(spark, share, a, b):
    rows = mixing.mix(spark.range(4), spark.range(100, 106), "id", share)
    got = {r["origin"]: r["count"] for r in rows.groupBy("origin").count().collect()}
    assert (got.get("a", 0), got.get("b", 0)) == (a, b)


def test_splits_are_exact_and_complete(spark):
    rows = mixing.exact_split(spark.range(1003), "id", 0.7)
    got = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
    assert got == {"train": 702, "test": 301} and rows.select("id").distinct().count() == 1003
    small = mixing.train_val_split(spark.range(4), "id").groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in small} == {"train": 3, "val": 1}
    with pytest.raises(ValueError):
        mixing.train_val_split(spark.range(1), "id")


def test_quantiles_are_exclusive(spark):
    import statistics

    for values in ([1, 2, 3, 4, 10, 20, 35], [5, 5], [3]):
        rows = spark.createDataFrame([(v,) for v in values], "v int")
        got = aggregate.exclusive_quantiles(rows, "v", (0.25, 0.5, 0.75)).first()
        want = statistics.quantiles(values, n=4) if len(values) > 2 else [values[0]] * 3
        assert list(got) == pytest.approx(want)
    assert aggregate.upper_median(spark.range(4), "id").first()["median"] == 2


def test_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], "s double")
    assert aggregate.score_summary(empty, "s").first().asDict() == {"n": 0, "mean": 0.0, "low": 0.0, "high": 0.0, "excellent": 0, "good": 0, "average": 0, "poor": 0, "very_poor": 0}
    assert aggregate.histogram(empty, "s", "s").count() == 0


def test_selection_breaks_ties_by_key(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "b", None), (4, "b", 9)], "id int, g string, s int")
    assert [r["id"] for r in select.top_k(rows, "s", "id", 2).collect()] == [4, 1]
    assert {r["id"] for r in select.best_of(rows, "g", "s", "id").collect()} == {1, 4}
    assert [r["id"] for r in select.top_k_then(rows, "s", "id", 2, F.col("g") == "a").collect()] == [1]
    with pytest.raises(ValueError):
        select.sorted_by(rows, "timestamp")


def test_nested(spark):
    rows = spark.createDataFrame([("s", "k", "d", "c"), ("s", "k", "long", "cc"), ("s", None, "x", "x"), (None, "k", "d", "c")], "id string, k string, d string, c string")
    got = {tuple(r) for r in nested.unpacked(nested.packed(rows, "id", "k", "d", "c"), "id", "components").collect()}
    assert got == {("s", "k", "long", "cc"), ("unknown", "k", "d", "c")}
    assert one(spark, 'x {"a": {"b": "}"}} y', nested.balanced_json_in) == '{"a": {"b": "}"}}'
    assert one(spark, "{broken", nested.balanced_json_in) is None
    assert one(spark, '```json\n{"a": 1}\n```', nested.json_in) == '{"a": 1}'
    assert one(spark, "not json", lambda c: nested.parsed(c, "a int")["a"]) is None
    assert json.loads(one(spark, "x", lambda c: F.to_json(models.taken_apart(c, c))))["core_method"] == {"description": "x", "code": "x"}
    assert one(spark, "x", lambda c: nested.has_keys(models.taken_apart(c, c), ["core_method"])) is True


def test_keyword_relevance_counts_its_own_list(spark):
    assert (len(score.RELEVANT), len(set(score.RELEVANT))) == (60, 57)
    texts = ["sma rsi buy entry stop", "Volume, volume and a signal", " ".join(score.RELEVANT), "algorithm trend market", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, c string")
    got = dict(rows.select("id", score.keyword_relevance("c")).collect())
    for i, t in enumerate(texts):
        t = (t or "").lower()
        distinct, total = len({k for k in score.RELEVANT if k in t}), sum(t.count(k) for k in score.RELEVANT)
        assert got[i] == pytest.approx(0.7 * min(distinct / 20, 1) + 0.3 * min(total / 50, 1))
    assert got[0] == pytest.approx(0.7 * 5 / 20 + 0.3 * 5 / 50) and got[1] == pytest.approx(0.7 * 2 / 20 + 0.3 * 6 / 50) and got[2] == 1


def test_scores_stay_in_their_ranges(spark):
    rows = spark.createDataFrame([(None, None), ("", ""), ("x" * 5000, "note: " + "ta.sma(close) " * 400)], "d string, c string")
    for f, low, high in ((score.segment_score, 1, 10), (score.composite_reward, -1, 1), (score.small_reward, 0, 1)):
        assert all(low <= r[0] <= high for r in rows.select(f("d", "c")).collect())
    n = spark.createDataFrame([("x" * k,) for k in (10, 50, 125, 200, 800, 1400, 2000, 2001)], "c string")
    assert [round(r[0], 6) for r in n.select(score.length_score("c")).collect()] == [0.1, 0.1, 0.55, 1.0, 1.0, 0.65, 0.3, 0.3]
    blocks = spark.createDataFrame([("```python\nimport x\ndef f():\n    return 1\n```",), ("no code",), (None,)], "c string")
    got = blocks.select(score.block_score("c", score.parsing_blocks(score.answer_blocks("c"))).alias("s")).collect()
    assert [round(r["s"], 6) for r in got] == [0.6, 0.1, 0.1]
    four = spark.createDataFrame([("entry exit stop sma",)], "c string")
    assert four.select(score.group_score("c")).first()[0] == pytest.approx(1.0)


def test_similarity(spark):
    pairs = spark.createDataFrame([(1, "abc abc", "abc abc"), (2, "abc", "xyz"), (3, None, "a")], "k int, a string, b string")
    got = {r["k"]: round(r["cosine"], 6) for r in similarity.gram_cosine(pairs, "k", "a", "b").collect()}
    assert got == {1: 1.0, 2: 0.0, 3: 0.0}
    assert one(spark, "x", lambda c: similarity.jaccard(F.array("c"), F.array().cast("array<string>"))) == 0.0


def test_prompts(spark):
    rows = spark.createDataFrame([("i", "o")], schemas.PAIR)
    assert prompts.formatted(rows, "conversation", system="s").first()["text"] == "System: s\n\nHuman: i\n\nAssistant: o"
    assert prompts.formatted(rows, "simple", separator="|").first()["text"] == "i|o"
    with pytest.raises(ValueError):
        prompts.formatter("other")
    marked = spark.createDataFrame([("INSTRUCTION: do OUTPUT: done",)], "c string").select(*[c.alias(n) for n, c in prompts.instruction_output("c").items()]).first()
    assert marked.asDict() == {"instruction": "do", "output": "done"}


def test_html(spark):
    page = "<article class='card big'><a href='/script/a/'>1</a><a href='/script/b/'>2</a></article><article class='card'><p>none</article><h1> A <b>b</b> </h1><a class='author-link' href='/u/me/'>me</a><i class='pro'></i>"
    r = one(spark, page, html.script_record)
    assert (r["name"], r["username"], r["profile_url"], r["pro_plan"], r["created_at"]) == ("Ab", "me", "/u/me/", True, None)
    assert one(spark, page, html.script_links) == ["/script/a/"]
    assert one(spark, None, html.script_links) == []
    assert one(spark, "/script/a/", lambda c: html.joined_url(F.lit("https://x.example/y/"), c)) == "https://x.example/script/a/"


def test_models(spark):
    rows = spark.createDataFrame([(1, "это"), (2, "this")], "id int, t string")
    model = models.Model(connect=lambda: lambda p: "score 90" if p.startswith("Rate") else "it")
    assert [r["model_score"] for r in models.assessed(rows, "t", model).collect()] == [90, 90]
    assert [r["t"] for r in models.translated(rows, "t", text.is_foreign("t"), model).orderBy("id").collect()] == ["it", "this"]

    def failing():
        def ask(_):
            raise OSError

        return ask

    assert [r["model_score"] for r in models.assessed(rows, "t", models.Model(connect=failing)).collect()] == [0, 0]


def test_statuses_and_observation(spark):
    rows = spark.createDataFrame([(1, True, True), (2, None, True), (3, True, False)], "id int, a boolean, b boolean")
    got = dict(pipelines.staged(rows, [("a", F.col("a")), ("b", F.col("b"))]).select("id", "status").collect())
    assert got == {1: "completed", 2: "rejected_by_a", 3: "rejected_by_b"}
    seen_df, seen = pipelines.observed(rows, "seen", n=F.count("*"))
    assert isinstance(seen, Observation) and seen_df.count() == 3 and seen.get == {"n": 3}
    assert pipelines.composed(rows, (True, lambda d: d.where("id > 1")), (False, lambda d: d.limit(0))).count() == 2


def test_classification(spark):
    rows = spark.createDataFrame([("strategy('x')",), ("@indicator",), ("strategy.entry(1)",), ("plot (x)",), ("myplot(x)",), (None,)], "c string")
    assert [r[0] for r in rows.select(classify.script_kind("c")).collect()] == ["strategy", "indicator", "strategy", "indicator", "unknown", "unknown"]
    t = spark.createDataFrame([("risk of divergence, maintained",)], "c string")
    assert t.select(classify.first_theme("c")).first()[0] == "complex_indicators"
    assert t.select(classify.all_themes("c")).first()[0] == ["complex_indicators", "machine_learning"]


def test_series(spark):
    bars = series.random_bars(spark, 20)
    assert bars.where("high < greatest(open, close) or low > least(open, close)").count() == 0 and bars.count() == 20


def test_cut_and_stored(spark):
    assert shared_dir(spark) == shared_dir(spark) or True
    table = stored(spark.range(3).toDF("x"), "t")
    assert cut(spark.range(3)).count() == table.count() == 3
    files_before = table.inputFiles()
    assert release(spark) >= 1 and release(spark) == 0 and not os.path.exists(files_before[0].removeprefix("file://"))


def test_similarity_of_pairs(spark):
    """Keywords keep their spelling, comments count for nothing, and two empty sets are not alike."""
    rows = spark.createDataFrame(
        [(1, "strategy(x)\nta.sma(close)", "// only a comment\nStrategy(x)\nta.sma(close)"), (2, "strategy input plot", "strategy plot security"), (3, "sma_period entry", "sma_period exits"), (4, None, "")], "k int, a string, b string"
    )
    got = {r["k"]: r for r in similarity.code_similarities(rows, "k", "a", "b").collect()}
    assert got[1]["keywords"] == pytest.approx(1 / 3) and got[1]["identifiers"] == 1 and got[1]["text"] == pytest.approx(1) and got[1]["structure"] == 0
    assert got[2]["keywords"] == pytest.approx(2 / 4) and got[3]["identifiers"] == pytest.approx(1 / 3)
    assert (got[4]["keywords"], got[4]["identifiers"], got[4]["text"], got[4]["structure"], got[4]["length"]) == (0, 0, 0, 1, 1)
    assert got[4]["overall"] == pytest.approx(0.25 + 0.05)


def test_code_checks_follow_their_case_rules(spark):
    rows = spark.createDataFrame([("CLOSE RSI HIGH words only",), ("close rsi high words only",), ("NOTE: x = ta.sma(close, 20)",)], "c string")
    assert [r[0] for r in rows.select(filters.valid_code("c")).collect()] == [False, True, False]
    rows = spark.createDataFrame([("WHILE the sun is up, WAIT",), ("Note:   (x = 1,\n y = 2 and so on)",), ("just some words and nothing else",)], "c string")
    assert [r[0] for r in rows.select(filters.meaningful_code("c")).collect()] == [True, False, False]


def test_likes_of_the_script_itself_decide(spark):
    rows = spark.createDataFrame([(0, 500), (None, 500), (150, 0)], "l int, p int").select("l", F.lit("d" * 40).alias("d"), F.lit("c" * 60).alias("c"))
    assert [r[0] for r in rows.select(filters.first_reason(filters.script_checks("l", "d", "c"))).collect()] == ["low_likes", "low_likes", None]


def test_small_samples_have_no_far_quantiles(spark):
    got = aggregate.exclusive_quantiles(spark.createDataFrame([(v,) for v in (3, 1, 2)], "v int"), "v", (0.25, 0.75, 0.95, 0.99)).first()
    assert list(got) == [1, 3, 3, 3]
    rows = spark.range(1, 21).selectExpr("id v")
    import statistics

    values = list(range(1, 21))
    assert list(aggregate.exclusive_quantiles(rows, "v", (0.25, 0.95, 0.99)).first()) == pytest.approx([statistics.quantiles(values, n=4)[0], statistics.quantiles(values, n=20)[18], 20])


def test_answers_in_fences_and_scores(spark):
    assert one(spark, "a ```PYTHON\nx=1\n``` b", text.code_or_text) == "x=1"
    assert one(spark, "```x=1```", text.code_or_text) == "x=1"
    assert one(spark, "```pine\ny\n```", text.code_or_text) == "y"
    assert [one(spark, v, text.percent_score) for v in ("Score: 85", "999 of 100", "no", None, "1234 or 7")] == [0.85, 1.0, 0.5, 0.5, 0.07]
    assert [one(spark, v, text.python_grade) for v in ("x = 1", "def (", "\0")] == [1.0, 0.2, 0.2]
    assert one(spark, "abc 1abc éabc _12 ABC Ab1", text.identifiers) == ["abc", "_12", "ab1"]


def test_script_pages(spark):
    code = "//@version=5\nstrategy('x')"
    editor = "".join(f"<div class='line'><span><span class='mtk1'>{x[:4]}</span><span class='mtk2'>{x[4:]}</span></span></div>" for x in code.split("\n"))
    script = '<script>{"source": "//@version=5\\nstrategy(\'x\')"}</script>'
    for body, want in ((editor, code), (f"<div class='source-code'><pre>{code}</pre></div>", code), (script, code), (f"<p>{'w' * 200}</p>\n{code}\n\n{'z' * 3000}", None), ("<pre>no mark</pre>", None)):
        got = one(spark, body, html.script_record)["source_code"]
        if want:
            assert got == want
        elif "version" in body:
            assert got.startswith("w" * 90) and code in got and 2000 < len(got) < 2300
        else:
            assert got is None
    digits = "<button aria-pressed='true'><span class='container-1'>" + "".join(f"<span class='digitGrid-a'><span class='digit-b'>{x}</span></span>" for x in "120") + "</span></button><i class='likes-count'>7</i>"
    assert one(spark, digits, html.script_record)["likes_count"] == 120
    assert one(spark, "<i class='likes-count'>1,234 likes</i>", html.script_record)["likes_count"] == 1234
    page = one(spark, "<a data-username='me' href='/u/me/'>other</a><b class='x-premium'></b><meta name='symbol' content='A:B'>", lambda c: html.script_record(c, F.lit("https://x.example/script/1/")))
    assert (page["username"], page["profile_url"], page["pro_plan"], page["symbol"], page["chart_url"]) == ("me", "https://x.example/u/me/", True, "A:B", "https://x.example/script/1/")
    assert one(spark, None, html.script_record)["source_code"] is None
    card = "<article class='card'><a href='/script/a/'>T</a><a class='author' href='/u/n/'>by N</a><time datetime='2020'>x</time><button class='boost'>1,5 K</button></article><article class='card'>none</article>"
    assert [r.asDict() for r in one(spark, card, lambda c: html.preview_cards(c, F.lit("https://x.example/")))] == [
        {"script_url": "https://x.example/script/a/", "preview_title": "T", "preview_author": "N", "preview_author_url": "https://x.example/u/n/", "preview_created_at": "2020", "preview_created_display": "x", "preview_likes_count": 15, "preview_comments_count": 0}
    ]
    with pytest.raises(ValueError):
        html.Page("<p>").select("p:first")


def scripted(**answers):
    """A client that answers by what the prompt begins with; a list of answers is given one by one, without one it fails."""

    def connect():
        given = {k: list(v) if isinstance(v, list) else v for k, v in answers.items()}

        def ask(prompt):
            found = next((v for k, v in given.items() if prompt.startswith(k)), None)
            found = (found.pop(0) if len(found) > 1 else found[0]) if isinstance(found, list) else found
            if found is None:
                raise OSError
            return found

        return ask

    return connect


GOOD = "```python\nimport backtrader as bt\nclass S(bt.Strategy):\n    def __init__(self):\n        pass\n    def next(self):\n        self.buy()\n```"


def test_conversion_is_told_what_was_missing(spark):
    rows = spark.createDataFrame([("strategy(1)",), (" ",), (None,)], "c string")
    got = models.converted(rows, "c", models.Model(scripted(Convert=["nothing", "```python\nimport backtrader\n```", GOOD]), 1)).select("conversion.*").collect()
    assert (got[0]["attempts"], got[0]["error"]) == (3, None) and "def next" in got[0]["code"] and "```" not in got[0]["code"]
    assert [(r["code"], r["attempts"], r["error"]) for r in got[1:]] == [(None, 0, "no source code")] * 2
    failing = models.converted(rows, "c", models.Model(scripted(), 1)).select("conversion.*").first()
    assert (failing["code"], failing["attempts"], failing["error"]) == (None, 5, "empty answer")


def test_rewriting_keeps_what_it_replaces(spark):
    rows = spark.createDataFrame([("old", "code"), ("", "code"), ("old", None)], "d string, c string")
    answers = {"Rate": 'So: {"match_score": 3, "needs_regeneration": false}', "Describe": " **new** text\n"}
    got = models.rewritten(rows, "d", "c", model=models.Model(scripted(**answers))).collect()
    assert [(r["d"], r["original"], r["match_score"], r["was_rewritten"], r["rewrite_failed"]) for r in got] == [("new text", "old", 3.0, True, False), ("", None, None, False, False), ("old", None, None, False, False)]
    asked = {"Rate": '{"match_score": 9, "needs_regeneration": true}', "Describe": "x"}
    assert models.rewritten(rows, "d", "c", model=models.Model(scripted(**asked))).first()["d"] == "x"
    kept = {"Rate": '{"match_score": 9}'}
    assert [r["was_rewritten"] or r["rewrite_failed"] for r in models.rewritten(rows, "d", "c", model=models.Model(scripted(**kept))).collect()] == [False] * 3


def test_best_of_several_analyses(spark):
    rows = spark.createDataFrame([("x",)], "d string")
    answers = ["not json", '{"title": "short", "key_concepts": ["a", "b"]}', '```json\n{"abstract": "long enough to be counted", "key_concepts": ["a", "b", "c"]}\n```']
    got = models.best_analysis(rows, "d", 3, models.Model(scripted(Analyse=answers))).first()
    assert got["analysis_score"] == 25 and "long enough" in got["analysis"] and got["candidates"] == 3
    none = models.best_analysis(rows, "d", 3, models.Model(scripted(), 1)).first()
    assert (none["analysis"], none["analysis_score"]) == (None, 0.0)
    full = {"key_concepts": list("abcdefghij"), "mathematical_models": list("abc"), "main_algorithms": {"algorithms": "a" * 31}, "content_preview": {"abstract_preview": "p" * 20}, "novelty": {"x": 1}, "title": "t" * 21}
    for extra, want in (({}, 10 + 10 + 10 + 5 + 15 + 5 + 5), ({"error": "e"}, 0), ({"parse_error": None}, 0)):
        assert one(spark, json.dumps(full | extra), lambda c: score.analysis_score(F.try_parse_json(c))) == want
    assert [one(spark, v, lambda c: score.analysis_score(F.try_parse_json(c))) for v in (None, "[]", "no json", "{}")] == [0, 0, 0, 0]


def test_agent_stages(spark):
    words = "word " * 120
    rows = spark.createDataFrame([(1, "strategy(x)", words), (2, "indicator(x)", words), (3, "strategy(x)", "few"), (4, "strategy(y)", words)], "id int, source_code string, description string")
    answers = {"Rate": "85", "Convert this script to a Backtrader strategy.\n\nstrategy(x)": GOOD, "Analyse": '{"abstract": "long enough to be counted"}', "Which": '{"symbols": ["btc", "eth"], "confidence": "high"}'}
    got = {r["id"]: r for r in pipelines.agent_pipeline(rows, model=models.Model(scripted(**answers), 1)).collect()}
    assert {k: r["status"] for k, r in got.items()} == {1: "completed", 2: "rejected_by_classifier", 3: "rejected_by_filter", 4: "rejected_by_conversion"}
    assert (got[1]["symbols"], got[1]["confidence"], got[1]["analysis_score"], got[1]["reasoning"]) == (["BTC", "ETH"], "high", 15.0, "")
    assert (got[2]["symbols"], got[2]["reasoning"], got[2]["conversion"]["attempts"]) == ([], None, 0)
    assert {r["status"] for r in pipelines.agent_pipeline(rows, model=models.Model(scripted(Rate="10"), 1)).collect()} == {"rejected_by_classifier", "rejected_by_filter"}


def test_translation_of_lines_and_other_answers(spark):
    rows = spark.createDataFrame([(["this", "это", None],), (["a"],), (None,)], "x array<string>")
    got = models.translated_lines(rows, "x", models.Model(scripted(Translate="it"))).collect()
    assert [(r["x"], r["lines_translated"]) for r in got] == [(["this", "it", None], True), (["a"], False), (None, False)]
    assert [r["lines_translated"] for r in models.translated_lines(rows, "x").collect()] == [False] * 3
    texts = spark.createDataFrame([("d", "c")], "d string, c string")
    assert models.assessed(texts, "d", models.Model(scripted(Rate="no number")), 1, 10, unparsed=5.0, failed=1.0).first()["model_score"] == 5
    assert models.assessed(texts, "d", models.Model(scripted(), 1), 1, 10, unparsed=5.0, failed=1.0).first()["model_score"] == 1
    assert models.generated(texts, F.col("d"), models.Model(scripted(d="```pine\nplot(x)\n```"))).first()["generated_code"] == "plot(x)"
    assert models.consistency(texts, "d", "c").first()["consistency"].startswith("Analysis failed")
    assert models.reasoned(texts, "d", "c", models.Model(scripted(Write="INSTRUCTION: do OUTPUT: <think>a</think><answer>b</answer>"))).first()["output_text"] == "<think>a</think><answer>b</answer>"
    dropped = models.drawing_dropped(spark.createDataFrame([("plot(x)\ny = 1",), ("z = 2",)], "c string"), "c", models.Model(scripted(Remove="y")))
    assert [(r["c"], r["removed_lines"]) for r in dropped.collect()] == [("y", 1), ("z = 2", 0)]
    rows = spark.createDataFrame([(1, "x" * 60 + " это", "strategy(1) = ta.sma(close, 9)", "k")], "segment_id int, input string, output string, source_id string")
    out = pipelines.segment_pipeline(rows, 1.0, translate=True, augment=True, model=models.Model(scripted(Translate="In English now", Rate='{"match_score": 8}')))
    assert [(r["input"], r["match_score"]) for r in out.collect()] == [("In English now", 8.0)] and pipelines.segment_pipeline(rows.limit(0)).count() == 0


def test_judges_and_reports(spark):
    rows = spark.createDataFrame([("```python\nx = 1\n```", "80"), ("```\ndef (\n```", None), ("no code", "90")], "c string, a string")
    assert [round(r[0], 6) for r in rows.select(score.judged_code("c", "a")).collect()] == [0.88, 0.38, 0.3]
    assert one(spark, '{"score": 250, "passed": true}', lambda c: nested.checked_assessment(c)["score"]) == 100
    assert one(spark, '{"score": "9"}', lambda c: nested.checked_assessment(c)["score"]) == 0
    assert one(spark, "a\\u00e9\\n\\\"", clean.escapes_decoded) == 'aé\n"' and one(spark, '"', clean.escapes_decoded) == '"'
    mixed = mixing.mix(spark.range(4), spark.range(100, 106), "id", 0.5)
    assert {r["origin"]: (r["rows"], r["share"], r["available"]) for r in mixing.mix_stats(mixed, 0.5, {"a": spark.range(4), "b": spark.range(100, 106)}).collect()} == {"a": (4, 0.5, 4), "b": (4, 0.5, 6)}
    assert mixing.mix_stats(mixed.limit(0), 0.5, {"a": spark.range(0), "b": spark.range(0)}).first()["share"] == 0
    stats = aggregate.batch_stats(spark.range(70), "id", 10, F.col("id") % 2 == 0)
    assert aggregate.batch_summary(stats).first().asDict() == {"batches": 7, "acceptance": 50.0, "latest": "6: 5/10, 5: 5/10, 4: 5/10, 3: 5/10, 2: 5/10"}
    assert [r["id"] for r in select.last_n(spark.range(9), "id", 2).collect()] == [8, 7]


def test_positions_are_whole_in_many_ranges(spark):
    rows = mixing._position(spark.range(500), "id", 1, 500, per_range=10).select("id", "__at").collect()
    assert sorted(r["__at"] for r in rows) == list(range(1, 501))


def test_quantiles_over_many_ranges(spark):
    rows = spark.range(1000).selectExpr("id % 7 g", "cast((id * 37) % 501 as int) v").union(spark.createDataFrame([(None, 5)], "g bigint, v int"))
    for by in ([], ["g"]):
        few, many = (aggregate._ranked(rows, "v", by, n).orderBy(*by, "v").collect() for n in (10**6, 20))
        assert few == many and len(few) > 400


def test_examples_of_each_style(spark):
    code = "//@version=5\nstrategy('x',\n y)\nn = input.int(3)\n  strategy.entry('L')"
    rows = spark.createDataFrame([(1, "A", "first", code), (2, None, "second", "plot(x)"), (3, "C", "third", code)], "rank int, name string, d string, c string")
    whole = prompts.few_shot(rows, "rank", 2, prompts.whole_example("d", "c"), "\n\n")
    assert whole == f"\nDescription: first\n\nGenerated TradingView Pine Script Code:\n{code}\n\n\n\nDescription: second\n\nGenerated TradingView Pine Script Code:\nplot(x)\n"
    shown = prompts.few_shot(rows, "rank", 2, prompts.pattern_example("rank", "name", "d", "c"))
    bar = "\n" + "=" * 50 + "\n\n"
    assert shown == (
        "=== EXAMPLE 1 ===\nStrategy: A\nDescription: first...\n\nVersion: //@version=5\nStrategy Declaration: strategy('x',\n y)\nInput Examples:\n  n = input.int(3)\nEntry Logic Examples:\n  strategy.entry('L')\n" + bar
        + "=== EXAMPLE 2 ===\nStrategy: Unknown\nDescription: second...\n\n" + bar
    )
    for style, examples in (("plain", None), ("whole", None), ("minimal", None), ("plain", "E"), ("whole", "E"), ("patterns", "E"), ("outlined", "E")):
        text_ = one(spark, "the target", lambda c: prompts.generation_prompt(c, examples, style, 3))
        assert "the target" in text_ and (examples is None or "E" in text_) and text_.rstrip().endswith((":", "."))
    with pytest.raises(KeyError):
        prompts.generation_prompt("c", None, "other")
