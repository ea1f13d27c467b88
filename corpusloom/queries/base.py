"""Registry of checked queries, and pieces of SQL they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions.text import FILLED, SPACE
from corpusloom.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it can be told in SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(t: str) -> str:
    return f"coalesce(len(regexp_extract_all({t}, '{FILLED}+')), 0)"


def chars(t: str) -> str:
    return f"coalesce(length({t}), 0)"


def trim(t: str) -> str:
    return f"regexp_replace({t}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def blank(t: str) -> str:
    return f"coalesce(not regexp_matches({t}, '{FILLED}'), true)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(terms: Sequence[str]) -> str:
    return "[" + ", ".join(map(quoted, terms)) + "]"


def hits(t: str, terms: Sequence[str]) -> str:
    return f"len(list_filter({listed(terms)}, lambda v: contains(coalesce({t}, ''), v)))"


def any_hit(t: str, terms: Sequence[str]) -> str:
    return "(" + " or ".join(f"contains({t}, {quoted(x)})" for x in terms) + ")"


def lines(t: str) -> str:
    return rf"string_split({t}, chr(10))"


def points(condition: str, n: float) -> str:
    return f"(case when {condition} then {n}::double else 0::double end)"


def capped(count: str, each: float, cap: float) -> str:
    return f"least({count} * {each}::double, {cap}::double)"
