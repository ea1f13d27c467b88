"""Listing pages as tables, and pages from a fetch function as a data source."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def page_urls(spark: SparkSession, base: str, first: int, last: int, style: str = "path") -> DataFrame:
    """(page, url): the addresses of listing pages. ``path``: ``<base>/page/n/``; ``dash``: ``<base>/page-n/``; both put the page
    before a query string, and the first page has none."""
    pages = spark.range(first, last + 1).select(F.col("id").cast("int").alias("page"))
    path, _, query = base.partition("?")
    part = F.concat(F.lit(path.rstrip("/") + ("/page/" if style == "path" else "/page-")), F.col("page").cast("string"), F.lit("/" + (f"?{query}" if query else "")))
    return pages.select("page", F.when(F.col("page") == 1, F.lit(base)).otherwise(part).alias("url"))


def argument_errors(first: int, pages: int, per_page: int | None = None) -> list[str]:
    """What is wrong with the arguments of a crawl; nothing if they can be used."""
    checks = (("first", first), ("pages", pages), ("per_page", 1 if per_page is None else per_page))
    return [f"{name} must be greater than 0, is {value}" for name, value in checks if value <= 0]


def listing_plan(spark: SparkSession, listings: list[tuple[str, int]], first: int, pages: int, style: str = "dash") -> DataFrame:
    """(listing, page, url): the pages of several listings, each with a limit of its own (editor's picks have one page)."""
    if errors := argument_errors(first, pages):
        raise ValueError("; ".join(errors))
    out = None
    for base, most in listings:
        one = page_urls(spark, base, first, first + min(pages, most) - 1, style).select(F.lit(base).alias("listing"), "page", "url")
        out = one if out is None else out.union(one)
    return out


def capped_per_page(df: DataFrame, page: str, position: str, most: int) -> DataFrame:
    """The first rows of each page; a cap below 1 is an error."""
    if errors := argument_errors(1, 1, most):
        raise ValueError("; ".join(errors))
    w = Window.partitionBy(page).orderBy(position)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def merged_records(previews: DataFrame, details: DataFrame, url: str, prefer: str = "detail") -> DataFrame:
    """Previews joined with the details of the same address (unique there); of columns both have the preferred side's value stands
    if it isn't null."""
    shared = [c for c in details.columns if c in previews.columns and c != url]
    d = details.select(url, *[F.col(c).alias(f"__d_{c}") for c in details.columns if c != url])
    joined = previews.join(d, url, "left")

    def pick(c: str) -> Column:
        sides = (F.col(f"__d_{c}"), F.col(c)) if prefer == "detail" else (F.col(c), F.col(f"__d_{c}"))
        return F.coalesce(*sides).alias(c)

    new = [F.col(f"__d_{c}").alias(c) for c in details.columns if c != url and c not in shared]
    return joined.select(*[pick(c) if c in shared else F.col(c) for c in previews.columns], *new)


def until_empty(pages: DataFrame, page: str, records: str) -> DataFrame:
    """Pages before the first one whose array of records is empty or null."""
    end = pages.where(F.coalesce(F.size(records), F.lit(0)) <= 0).agg(F.min(page).alias("end")).first()["end"]
    return pages if end is None else pages.where(F.col(page) < end)


def with_retries(fetch: Callable[[str], str | None], tries: int = 3, pause: float = 1.0, limit: float = 120.0) -> Callable[[str], str | None]:
    """A fetch that waits longer after each failure, with jitter, and gives up with null after so many tries or seconds; one that hangs
    is left behind when its time is over (its thread ends with the task)."""

    def attempt(url: str, seconds: float) -> tuple[bool, str | None]:
        done: list[tuple[bool, str | None]] = []

        def work() -> None:
            try:
                done.append((True, fetch(url)))
            except Exception:
                done.append((False, None))

        thread = threading.Thread(target=work, daemon=True)
        thread.start()
        thread.join(seconds)
        return done[0] if done else (True, None)

    def run(url: str) -> str | None:
        began = time.monotonic()
        for k in range(tries):
            ok, page = attempt(url, max(0.0, limit - (time.monotonic() - began)))
            wait = pause * 2**k + random.random() * pause
            if ok or k + 1 == tries or time.monotonic() - began + wait > limit:
                return page
            time.sleep(wait)
        return None

    return run


def fetched(urls: DataFrame, url: str, fetch: Callable[[str], str | None], **retries: float) -> DataFrame:
    """``urls`` with ``html``; a task fetches its own rows, so the number of partitions bounds the load on the site."""
    schema = T.StructType([*urls.schema.fields, T.StructField("html", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = with_retries(fetch, **retries)
        for batch in batches:
            yield batch.assign(html=[get(u) if isinstance(u, str) else None for u in batch[url]])

    return urls.mapInPandas(run, schema)


class SavedPages(DataSource):
    """``spark.read.format("savedpages").option("path", folder)``: (url, html) of pages saved as ``*.html`` in a shared folder, a
    partition for each ``filesPerPartition`` files. The interface that a live page source would have."""

    @classmethod
    def name(cls) -> str:
        return "savedpages"

    def schema(self) -> str:
        return "url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _SavedPagesReader(self.options)


class _Files(InputPartition):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class _SavedPagesReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.size = options["path"], int(options.get("filespartition", options.get("filesPerPartition", 64)))

    def partitions(self) -> list[InputPartition]:
        from pathlib import Path

        files = sorted(str(p) for p in Path(self.path).glob("*.html"))
        return [_Files(files[i : i + self.size]) for i in range(0, len(files), self.size)] or [_Files([])]

    def read(self, partition: _Files):
        from pathlib import Path

        for f in partition.files:
            yield (Path(f).stem, Path(f).read_text(encoding="utf-8", errors="replace"))
