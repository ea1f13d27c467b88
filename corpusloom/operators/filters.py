"""Filters that say why a row fails: a reason column first, then a plain predicate, so that Catalyst pushes what it can."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import SPACE, _c, char_count, is_blank, trimmed, trimmed_length, word_count

# Fixed values.
NOTES = ("note:", "note that", "if the price of", "deleverage", "protect yourself")
CODE_SIGNS = ("=", "(", ")", ".", "ta.", "close", "open", "high", "low", "sma", "ema", "rsi")
CODE_SHAPES = (r"(?i)=\s*[^=]", r"(?i)\w+\s*\(", r"(?i)\b(?:if|while|for|function|def|var|let|const|input\.)\b", r"(?i)\w+\.\w+", r"(?i)\[.*\]")
NOTE_ONLY = r"(?is)^\s*note:\s*\(.*\)\s*$"


def first_reason(checks: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first check that holds, in order; null if none does. A null condition doesn't hold."""
    out = None
    for name, failed in checks:
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def all_reasons(checks: Sequence[tuple[str, Column]], by: str = ", ") -> Column:
    """The names of all checks that hold, joined; empty if none does."""
    return F.concat_ws(by, *[F.when(failed, name) for name, failed in checks])


def threshold_checks(likes: Column | str, text: Column | str, min_likes: int = 10, min_words: int = 20, min_chars: int = 100) -> list[tuple[str, Column]]:
    """All strictly above their thresholds; null likes are 0."""
    return [("low_likes", F.coalesce(_c(likes), F.lit(0)) <= min_likes), ("few_words", word_count(text) <= min_words), ("few_chars", char_count(text) <= min_chars)]


def script_checks(likes: Column | str, description: Column | str, code: Column | str, min_likes: int = 100, min_description: int = 30, min_code: int = 50) -> list[tuple[str, Column]]:
    return [
        ("low_likes", F.coalesce(_c(likes), F.lit(0)) < min_likes),
        ("empty", is_blank(description) | is_blank(code)),
        ("short_description", trimmed_length(description) < min_description),
        ("short_code", trimmed_length(code) < min_code),
    ]


def comment_free(code: Column | str) -> Column:
    """Lines without ``//`` and ``#`` comments, empty ones dropped."""
    cut = F.transform(F.split(_c(code), "\n", -1), lambda x: trimmed(F.regexp_replace(x, r"(?://|#)[^\n]*", "")))
    return F.array_join(F.filter(cut, lambda x: x != ""), "\n")


def valid_code(code: Column | str, min_chars: int = 10) -> Column:
    """Long enough with and without comments, no note in any case, and at least one sign of code, as it is written."""
    bare, low, sign = comment_free(code), F.lower(_c(code)), F.lit(False)
    for s in CODE_SIGNS:
        sign = sign | F.contains(bare, F.lit(s))
    note = F.lit(False)
    for n in NOTES:
        note = note | low.contains(n)
    return F.coalesce((trimmed_length(code) >= min_chars) & ~note & (char_count(bare) >= min_chars) & sign, F.lit(False))


def meaningful_code(code: Column | str, min_chars: int = 20) -> Column:
    """Any of the shapes of code is left without comments and spacing, and it isn't a lone note."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(_c(code), r"//[^\n]*", ""), r"(?s)/\*.*?\*/", ""), r"#[^\n]*", "")
    bare = trimmed(F.regexp_replace(bare, f"{SPACE}+", " "))
    shape = F.lit(False)
    for s in CODE_SHAPES:
        shape = shape | bare.rlike(s)
    return F.coalesce((trimmed_length(code) >= min_chars) & shape & ~trimmed(code).rlike(NOTE_ONLY), F.lit(False))


def segment_checks(description: Column | str, code: Column | str, min_description: int = 20) -> list[tuple[str, Column]]:
    return [("empty", is_blank(description) | is_blank(code)), ("invalid_code", ~valid_code(code)), ("short_description", trimmed_length(description) < min_description)]


def is_strategy(code: Column | str) -> Column:
    c = F.coalesce(_c(code), F.lit(""))
    return c.contains("strategy(") & (c.contains("strategy.entry") | c.contains("strategy.order"))


def few_shot_eligible(description: Column | str, code: Column | str, likes: Column | str | None, min_description: int = 50, min_code: int = 200, min_likes: int = 5) -> Column:
    out = (char_count(description) > min_description) & (char_count(code) > min_code)
    return out if likes is None else out & (F.coalesce(_c(likes), F.lit(0)) > min_likes)


def above(score: Column | str, least: float) -> Column:
    return F.coalesce(_c(score) >= least, F.lit(False))


def with_reason(df: DataFrame, checks: Sequence[tuple[str, Column]], name: str = "reason") -> DataFrame:
    return df.withColumn(name, first_reason(checks))


def kept(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.where(first_reason(checks).isNull())


def not_done(df: DataFrame, key: str, done: DataFrame, position: str | None = None, from_position: int | None = None) -> DataFrame:
    """Rows still to do: those whose key isn't among the done ones, or whose position is at or beyond a saved one. Rows with a
    null key are never done."""
    left = df.join(done.select(F.col(key)).distinct(), key, "left_anti")
    if position is None or from_position is None:
        return left
    ahead = df.where(F.col(position) >= from_position)
    return ahead.unionByName(left.where(F.col(position) < from_position))


def first_pass_checks(description: Column | str, code: Column | str, min_description: int = 15) -> list[tuple[str, Column]]:
    """The first pass over segments with its reasons, in order."""
    return [("empty", is_blank(description) | is_blank(code)), ("short_description", trimmed_length(description) < min_description), ("meaningless_code", ~meaningful_code(code))]
