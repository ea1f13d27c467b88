"""Readers, writers and incremental runs on files."""

import json
import os
import time

import pytest

from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.sources import files, web
from corpusloom.streaming import streams


def test_json_shapes(spark, tmp_path):
    rows = [{"input": "a", "output": "b"}, {"input": "c"}]
    (tmp_path / "array.json").write_text(json.dumps(rows))
    (tmp_path / "object.json").write_text(json.dumps(rows[0]))
    (tmp_path / "envelope.json").write_text(json.dumps({"metadata": {}, "results": rows}))
    assert files.read_json(spark, str(tmp_path / "array.json"), schemas.PAIR).count() == 2
    assert files.read_json(spark, str(tmp_path / "object.json"), schemas.PAIR).count() == 1
    assert files.read_envelope(spark, str(tmp_path / "envelope.json"), schemas.PAIR).count() == 2
    assert files.read_envelope(spark, str(tmp_path / "array.json"), schemas.PAIR).count() == 2


def test_parquet_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c")], "id string, name string")
    files.write_rows(rows, str(tmp_path / "out"), ["name", "id"], ["id", "name"])
    back = files.read_parquet(spark, str(tmp_path / "out"), "*.parquet")
    assert back.columns == ["name", "id"] and back.count() == 1
    assert files.inventory_totals(files.file_inventory(back)).first()["rows"] == 1
    assert files.latest_file(back).first()["file"].endswith(".parquet")
    (tmp_path / "out" / "bad.parquet").write_bytes(b"no parquet")
    good = spark.read.schema(back.schema).option("ignoreCorruptFiles", True).parquet(str(tmp_path / "out"))
    assert good.count() == 1
    files.write_run(rows, str(tmp_path / "run"), batch=3, final=True)
    assert spark.read.json(str(tmp_path / "run" / "metadata")).first()["batch"] == 3 and spark.read.json(str(tmp_path / "run" / "results")).count() == 3
    assert files.write_pairs(rows, str(tmp_path / "two"), ["name"], ["id"]).first()["rows"] == 3


def test_pages(spark, tmp_path):
    urls = web.page_urls(spark, "https://x.example/scripts/?q=1", 1, 3, "dash").orderBy("page").collect()
    assert [u["url"] for u in urls] == ["https://x.example/scripts/?q=1", "https://x.example/scripts/page-2/?q=1", "https://x.example/scripts/page-3/?q=1"]
    pages = spark.createDataFrame([(1, ["a"]), (2, []), (3, ["b"])], "page int, found array<string>")
    assert [r["page"] for r in web.until_empty(pages, "page", "found").collect()] == [1]
    assert web.argument_errors(1, 2) == [] and len(web.argument_errors(0, -1, 0)) == 3
    with pytest.raises(ValueError):
        web.listing_plan(spark, [("https://x.example/", 1)], 1, 0)
    with pytest.raises(ValueError):
        web.capped_per_page(pages, "page", "page", 0)
    tries = []

    def fetch(url):
        tries.append(url)
        raise OSError

    assert web.with_retries(fetch, tries=2, pause=0.0)("u") is None and len(tries) == 2
    began = time.monotonic()
    assert web.with_retries(lambda u: time.sleep(30), limit=0.3)("u") is None and time.monotonic() - began < 5
    got = web.fetched(spark.createDataFrame([("u",), (None,)], "url string"), "url", lambda u: f"<p>{u}</p>")
    assert {r["html"] for r in got.collect()} == {"<p>u</p>", None}
    (tmp_path / "one.html").write_text("<h1>x</h1>")
    spark.dataSource.register(web.SavedPages)
    assert spark.read.format("savedpages").option("path", str(tmp_path)).load().collect()[0].asDict() == {"url": "one", "html": "<h1>x</h1>"}


def test_merge_prefers_a_side(spark):
    p = spark.createDataFrame([("u", "preview", 1), ("v", "only", 2)], "url string, name string, n int")
    d = spark.createDataFrame([("u", "detail", None)], "url string, name string, code string")
    assert {r["name"] for r in web.merged_records(p, d, "url").collect()} == {"detail", "only"}
    assert {r["name"] for r in web.merged_records(p, d, "url", "preview").collect()} == {"preview", "only"}


def test_each_file_is_processed_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    spark.range(5).write.parquet(src)
    for more, want in ((0, 5), (3, 8), (0, 8)):
        if more:
            spark.range(more).write.mode("append").parquet(src)
        streams.run_available(streams.increments(spark, src, "id long"), out, mark)
        assert spark.read.parquet(out).count() == want


def test_stream_windows_drop_late_rows(spark, tmp_path):
    src = str(tmp_path / "events")
    one = lambda t: spark.createDataFrame([(t, "k", 1.0)], "ts string, k string, v double").select(F.to_timestamp("ts").alias("ts"), "k", "v")
    schema = one("2024-01-01 00:00:00").schema
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for t in ("2024-01-01 00:10:00", "2024-01-01 09:00:00", "2024-01-01 00:20:00", "2024-01-01 18:00:00"):
        one(t).coalesce(1).write.mode("append").parquet(src)
        stream = streams.windowed_counts(streams.increments(spark, src, schema, 1), "ts", "k", "v")
        streams.run_available(stream, out, mark)
    got = {str(r["starts"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01 00:00:00"] == 1


def test_saved_progress_and_resume(spark, tmp_path):
    p = streams.SavedProgress(spark, str(tmp_path / "p"))
    assert p.show() == {} and p.set(last=3) == {"last": 3} and p.set(n=1) == {"last": 3, "n": 1} and p.reset() and p.show() == {} and not p.reset() and p.backup() == {"last": 3, "n": 1}
    assert streams.SavedProgress(spark, str(tmp_path / "p")).set(last=5) == {"last": 5}
    rows, done = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 1), ("z", 9)], "k string, n int")
    got = streams.resumed(rows, "k", done, lambda d: d.withColumn("n", F.lit(0)))
    assert {(r["k"], r["n"]) for r in got.collect()} == {("a", 1), ("b", 0)}


def test_files_by_age_batches_and_bad_files(spark, tmp_path):
    rows = spark.range(25).selectExpr("id", "cast(id as string) name")
    files.write_rows(rows, str(tmp_path / "b"), ["id", "name"], ["name"], position="id")
    assert {r["batch"]: r["count"] for r in spark.read.parquet(str(tmp_path / "b")).groupBy("batch").count().collect()} == {0: 10, 1: 10, 2: 5}
    files.write_run(rows, str(tmp_path / "r"), every=10, position="id", run="x")
    assert spark.read.json(str(tmp_path / "r" / "intermediate" / "batch-2")).count() == 5 and spark.read.json(str(tmp_path / "r" / "results")).count() == 25
    for i, name in enumerate(("old", "new")):
        path = tmp_path / "bad" / f"{name}.parquet"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"not parquet")
        os.utime(path, (1000 + i, 1000 + i))
    assert [r["file"].rsplit("/", 1)[1] for r in files.newest_first(spark, str(tmp_path / "bad")).collect()] == ["new.parquet", "old.parquet"]
    with pytest.raises(Exception):
        files.read_parquet(spark, str(tmp_path / "bad"), "*.parquet", tolerant=True).count()
    assert files.write_pairs(rows, str(tmp_path / "p"), ["name"], ["id"], top=F.max("id")).first().asDict() == {"rows": 25, "top": 24}
    seen = files.inspected(rows, "id", 3)
    assert [r["id"] for r in seen["head"].collect()] == [0, 1, 2] and seen["sample"].count() == 3 and seen["profile"].count() == 2
    read = spark.read.parquet(str(tmp_path / "b"))
    assert {r["columns"] for r in files.file_inventory(read).collect()} == {3}
