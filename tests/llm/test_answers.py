"""Defects of answers, encoding and abusive content."""

import math
import random

import pyarrow.parquet as pq
import pytest
from compare import spark_rows, sql_rows, views
from pyspark.sql import functions as F

from corpusloom.llm import pairs, toxicity
from corpusloom.llm.bpe import BYTE_BPE, PATTERN, Encoder, count_tokens, decode, encode, load_ranks, merge_long, merge_short
from corpusloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
Q = "Enter long when the fast average crosses above the slow one and exit when it falls back below."
CODE = "//@version=5\nstrategy(\"x\")\nfast = ta.sma(close, 9)\nif fast > close\n    strategy.entry(\"L\", strategy.long)"
PY = 'import backtrader as bt\n\nclass S(bt.Strategy):\n    def next(self):\n        # it\'s (fine\n        self.buy()\n'


@pytest.mark.parametrize(
    "question, answer, want",
    [
        (Q, None, "empty"), (Q, "", "empty"), (Q, " ​\n", "empty"), (Q, "```python\n\n```", "empty"), (Q, "N/A.", "empty"), (Q, "(no answer)", "empty"), (Q, "// ...", "empty"),
        (Q, CODE, None), (Q, f"Here is the script.\n```pine\n{CODE}\n```", None), (Q, "plot(na)", None), (Q, "strategy.close_all()", None), (None, CODE, None), (Q, PY, None), (Q, CODE + "\n// done :) (see [1", None),
        (Q, CODE[:-20], "truncated"), (Q, CODE + "\nif close", "truncated"), (Q, CODE + "\nx =", "truncated"), (Q, CODE + "\n// (cut off at the token limit)", "truncated"), (Q, PY + "    def stop", "truncated"), (Q, f"```\n{CODE}", "truncated"), (Q, CODE + "\nplot(fast", "truncated"),
        (Q, "The averages are compared on every bar. The position is then", "truncated"),
        (Q, "I'm sorry, but I can't help with that.", "refusal"), (Q, "// Sorry, no code is provided for this", "refusal"), (Q, "I CANNOT PROVIDE an implementation.", "refusal"), (Q, "// we refuse trades below the average\n" + CODE, None),
        (Q, Q, "copy"), (Q, Q.upper(), "copy"), (Q, "Answer: " + Q.replace("fast", "fastt"), "copy"), (Q, f"```\n{Q}\n```", "copy"), (Q, "// " + Q, "copy"), (CODE * 3, CODE * 3, "copy"), (Q, "ok = true // " + Q, None),
        (Q, "Die Strategie kauft, wenn der schnelle Durchschnitt über dem langsamen steht und nicht fällt.", "language"), (Q, CODE.replace("fast =", "// Стратегия покупает когда средняя растёт и цена выше\nfast ="), "language"),
        ("Die Strategie kauft, wenn der Durchschnitt über dem Kurs steht und nicht fällt.", CODE + "\n// Die Strategie kauft, wenn der Kurs nicht unter dem Mittel ist", None), (Q, CODE + "\n// Über-Trend 信号", None),
    ],
)
def test_defects(question, answer, want):
    assert pairs.judge(question, answer, pairs._refusing()) == want


@pytest.mark.parametrize(
    "comment, want",
    [
        ("16.75% zarardan sonra Fenor sinyali PELTEUQ üzerinde 7 çubuk susar", "language"), ("Compra cuando cierra sobre la media", "language"), ("nicht vor der Eröffnung", "language"),
        ("Über-Trend", None), ("do as the Gödel Müller paper says", None), ("x, y and o, h, l, c", None), ("the façade of Çetin holds", None), ("el Niño", None),
    ],
)
def test_short_comments(comment, want):
    assert pairs.judge(Q, f"// {comment}\nfast = ta.ema(ohlc4, 9)\n", pairs._refusing()) == want


def test_suffix_automaton_covers_common_stretches():
    rnd = random.Random(1)
    for _ in range(50):
        q, a = ([rnd.choice("abc") for _ in range(rnd.randrange(1, 15))] for _ in range(2))
        count, which = pairs.SuffixAutomaton(q).covered(a, 2)
        mine = {j for i in range(len(a)) for n in range(2, len(a) - i + 1) if any(q[k : k + n] == a[i : i + n] for k in range(len(q))) for j in range(i, i + n)}
        assert count == len(mine)
        assert all(any(q[i : i + 2] == a[k : k + 2] for k in range(len(a)) for i in (j - 1, j) if i >= 0) for j, hit in enumerate(which) if hit)


def test_pairs_of_a_table(spark):
    df = spark.createDataFrame([(1, None, None, 0), (2, None, None, 1), (2, None, None, 1), (None, Q, CODE, 1), (3, Q, "x " * 200_000 + "x.", 1)], "k long, q string, a string, tries int").withColumn("defect", F.lit("x"))
    got = [tuple(r) for r in pairs.broken_pairs(df, "k", "q", "a", "tries <> 0").collect()]
    assert got.count((2, "empty")) == 2 and (1, "empty") not in got
    assert pairs.broken_pairs(df.limit(0), "k", "q", "a").count() == 0


# Encoding.


@pytest.fixture(scope="module")
def ranks():
    return load_ranks()


@pytest.fixture(scope="module")
def oracle(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_the_library(ranks, oracle):
    enc = Encoder(ranks)
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    texts += ["<|endoftext|> <|im_end|>", "   \n\n  x \t", "don't DON'T", "é é ​﻿", "𝔘𝔫𝔦 🚀🚀", "\x00\x01", "a" * 3000, "=" * 1001, " " * 500 + "x"]
    for t in texts:
        assert enc(t) == oracle.encode_ordinary(t)
        assert decode(enc(t), ranks) == t
    assert enc(None) == enc("") == []


def test_both_merges_agree(ranks):
    rnd = random.Random(2)
    for _ in range(300):
        w = bytes(rnd.choice(b"abcdeABC -=_0123\xc3\xa9\xe6") for _ in range(rnd.randrange(1, 120)))
        assert merge_short(w, ranks) == merge_long(w, ranks)


def test_ids_of_a_table(spark, oracle):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (2, ""), (None, "x")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted(((r["doc_id"] or 0), r["ids"]) for r in encode(df, "doc_id", "text", BYTE_BPE).collect())
    assert got == [(0, oracle.encode_ordinary("x")), (1, oracle.encode_ordinary("Hello world")), (2, []), (2, [])]
    assert sorted(r["n_tokens"] for r in count_tokens(df, "doc_id", "text").collect()) == sorted(len(x) for _, x in got)
    assert encode(df.limit(0), "doc_id", "text").count() == 0


# Abusive content.


def test_disguised_words_are_read():
    reader = toxicity.Reader({"idiot", "people", "tits", "sex", "you"}, toxicity.Counter({"idiot": 3, "people": 2, "tits": 2, "sex": 1}))
    read = lambda t: [w for u in toxicity.units(t) for w in reader(u)]
    assert read("You IDIOT") == ["you", "idiot"] and read("y​ou ｉｄｉｏｔ") == ["you", "idiot"]
    assert read("i d i o t") == ["idiot"] and read("i.d.i.o.t") == ["idiot"] and read("idiooooot") == ["idiot"] and read("1d10t") == ["idiot"]
    assert read("i***t") == ["idiot"] and read("іdіоt") == ["idiot"] and read("peoppppple") == ["people"] and read("53x") == ["sex"]
    assert read("x**** 12 v3") == ["<masked>", "<num>", "<rare>"] or read("12")[0] == "<num>"


def test_model_probabilities_add_up():
    shared = toxicity.Counter({"a": 5, "b": 3, "c": 1})
    m = toxicity.KneserNey(toxicity.Counter({("a", "b"): 2, ("a", "c", "a"): 1}), shared)
    for u, v in (("<s>", "<s>"), ("<s>", "a"), ("a", "b"), ("x", "y")):
        assert sum(math.exp(m.log(u, v, w)) for w in ("a", "b", "c", "other")) == pytest.approx(1, abs=0.02)


def test_held_out_accuracy(spark):
    """Fitted on half of the reviews, judged by the other half; a share of the verdicts is wrong."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    reviews = spark.read.parquet("/root/testdata/sf0.1/review_labels.parquet")
    scorer = toxicity.fitted(docs, reviews.where("doc_id % 2 = 0"), "doc_id", "text", "abusive")
    rest = reviews.where("doc_id % 2 = 1 and abusive is not null").groupBy("doc_id").agg(F.avg("abusive").alias("bad")).where("bad <> 0.5")
    got = toxicity.score(docs, scorer, "doc_id", "text").join(rest, "doc_id").select("abusive", (F.col("bad") > 0.5).alias("bad")).collect()
    hits = sum(r["abusive"] and r["bad"] for r in got)
    assert sum(r["abusive"] == r["bad"] for r in got) / len(got) > 0.8
    assert hits / sum(r["bad"] for r in got) > 0.7


def test_scores_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None), (3, "You stupid idiot, go fuck yourself!", "a"), (4, "A quiet day on the market. " * 3000, None)], "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, abusive int")
    scorer = toxicity.fitted(docs, none, "doc_id", "text", "abusive")
    scored = toxicity.score(docs, scorer, "doc_id", "text", "source")
    assert {r["doc_id"]: r["abusive"] for r in scored.collect()} == {1: False, 2: False, 3: True, 4: False}
    assert {r["source"]: (r["documents"], r["abusive"]) for r in toxicity.rates(scored, "source").collect()} == {"a": (2, 1), None: (2, 0)}
    assert toxicity.score(docs.limit(0), scorer, "doc_id", "text").count() == 0


@pytest.mark.parametrize("name, columns", [("p1_found", ["table_name", "row_key", "defect"]), ("p2_found", ["row_a", "row_b"]), ("p3_found", ["row_id"]), ("p4_found", ["author_a", "author_b"]), ("p5_found", ["row_a", "row_b"]), ("p6_ids", ["doc_id", "ids"]), ("p8_found", ["doc_id"])])
def test_result_columns(spark, name, columns):
    df = QUERIES[name](spark, SF)
    assert df.columns == columns and df.count() >= 0


@pytest.mark.parametrize("name", ["p1_rates", "p2_report", "p4_splits", "p4_batches", "p7_packed", "p7_fill", "p8_scores", "p8_rates"])
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_languages():
    of = pairs.language
    assert of("Het systeem wacht niet voor een signaal maar ook van het gemiddelde") == "nl"
    assert of("Strategia nie otwiera pozycji, gdy rynek jest przed sesją oraz bez trendu") == "pl"
    assert of("Strategi ini tidak akan masuk jika sinyal dari rata rata belum ada untuk hari itu") == "id"
    for text, want in (("الاستراتيجية تشتري عند الاختراق", "ar"), ("रणनीति तब खरीदती है जब औसत बढ़ता है", "hi"), ("กลยุทธ์นี้ซื้อเมื่อราคาขึ้น", "th"), ("η στρατηγική αγοράζει όταν ανεβαίνει", "el"), ("האסטרטגיה קונה כאשר המחיר עולה", "he")):
        assert of(text) == want
    automaton = pairs._refusing()
    arabic = "الاستراتيجية تشتري عند الاختراق فوق المتوسط ثم تبيع عند الهبوط"
    assert pairs.judge("Describe how the position is opened and when it is closed.", arabic, automaton) == "language"
    unknown = " ".join(f"zor{chr(97 + i % 26)}un" for i in range(40))  # a long question in no known language
    assert pairs.judge(unknown, "The strategy buys when the average rises and it sells when it falls.", automaton) is None
    fenced = "Esta estrategia compra cuando el precio está sobre la media, y vende después.\n```pine\nplot(close)\n```"
    assert pairs.judge("Write a script that plots the close and nothing else of the bars.", fenced, automaton) == "language"


def test_reviews_are_bounded_by_their_length(spark):
    docs = spark.createDataFrame([(i, ("you stupid idiot " if i % 2 else "a quiet trade ") + "x" * 100) for i in range(40)], "doc_id long, text string")
    reviews = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("abusive"))
    small, whole = (len(toxicity.fitted(docs, reviews, "doc_id", "text", "abusive", sample_chars=n)) for n in (300, 10**6))
    assert small <= whole


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    """The pairs of all rows by SQL, and counts of what must not be."""
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(views(SF), SQL[name])
