"""Scalar features of texts and code as column expressions. Null texts count as empty unless said otherwise.

White space is spelled out as the characters that Unicode calls so, and words as runs of other characters, because the
shorthand classes of regular expressions differ between engines.
"""

from __future__ import annotations

import ast
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE, FILLED = f"[{SPACES}]", f"[^{SPACES}]"
EDGES = f"^{SPACE}+|{SPACE}+$"
#: Scripts that count as not English: Han, kana, Hangul, Cyrillic, Arabic, Thai (fixed values).
FOREIGN = r"[\x{4e00}-\x{9fff}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{ac00}-\x{d7af}\x{0400}-\x{04ff}\x{0600}-\x{06ff}\x{0e00}-\x{0e7f}]"
#: A whole word of letters, digits and underscores of any script; an identifier is one of ASCII that begins with no digit.
WORD, IDENTIFIER = r"[\p{L}\p{N}_]+", r"^[A-Za-z_][A-Za-z0-9_]*$"
SYMBOL = r"[A-Z0-9_]+:[A-Z0-9]+(?::[A-Z0-9]+)?"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(c: Column | str) -> Column:
    return F.coalesce(F.regexp_count(_c(c), F.lit(f"{FILLED}+")), F.lit(0)).cast("long")


def char_count(c: Column | str) -> Column:
    return F.coalesce(F.length(_c(c)), F.lit(0)).cast("long")


def trimmed(c: Column | str) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(_c(c), EDGES, "")


def trimmed_length(c: Column | str) -> Column:
    return char_count(trimmed(c))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(~_c(c).rlike(FILLED), F.lit(True))


def all_blank(values: Column | str) -> Column:
    """Of an array: null, empty, or with blank elements only."""
    return F.coalesce(F.forall(_c(values), is_blank), F.lit(True))


def lines(c: Column | str) -> Column:
    return F.split(_c(c), "\n", -1)


def line_stats(c: Column | str, mark: str = "//") -> dict[str, Column]:
    """Lines in all, filled ones, comments (that begin with ``mark``) and code lines."""
    each = lines(F.coalesce(_c(c), F.lit("")))
    count = lambda f: F.size(F.filter(each, f)).cast("long")
    comment = lambda x: trimmed(x).startswith(mark)
    return {
        "lines": F.size(each).cast("long"),
        "filled_lines": count(lambda x: ~is_blank(x)),
        "comment_lines": count(comment),
        "code_lines": count(lambda x: ~is_blank(x) & ~comment(x)),
    }


def contains_flags(c: Column | str, terms: dict[str, str]) -> dict[str, Column]:
    return {name: F.coalesce(_c(c).contains(term), F.lit(False)) for name, term in terms.items()}


def term_hits(c: Column | str, vocabulary: Sequence[str]) -> Column:
    """The terms that occur in the text, as substrings, in the vocabulary's order."""
    text = F.coalesce(_c(c), F.lit(""))
    return F.array_compact(F.array(*[F.when(text.contains(v), v) for v in vocabulary]))


def hit_count(c: Column | str, vocabulary: Sequence[str]) -> Column:
    """The number of terms that occur: a plain sum, so that generated code computes the text once."""
    text, out = F.coalesce(_c(c), F.lit("")), F.lit(0).cast("long")
    for v in vocabulary:
        out = out + text.contains(v).cast("long")
    return out


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, for bodies that use it many times inside other lambdas."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def any_of(c: Column | str, terms: Sequence[str]) -> Column:
    text, out = F.coalesce(_c(c), F.lit("")), F.lit(False)
    for t in terms:
        out = out | text.contains(t)
    return out


def occurrences(c: Column | str, term: str) -> Column:
    """Non-overlapping occurrences."""
    text = F.coalesce(_c(c), F.lit(""))
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("long")


def balanced(c: Column | str) -> Column:
    """As many opening as closing brackets of each kind that matters, and no comma at the end."""
    text = F.coalesce(_c(c), F.lit(""))
    return (occurrences(text, "(") == occurrences(text, ")")) & (occurrences(text, "[") == occurrences(text, "]")) & ~trimmed(text).endswith(",")


def bracket_fault(c: Column | str) -> Column:
    """Whether brackets don't nest or stay open: a fold over them with the stack as a string; a fault puts an ``x`` on it for good."""
    closes = [(")", "("), ("]", "["), ("}", "{")]

    def step(stack: Column, b: Column) -> Column:
        out = F.when(F.startswith(stack, F.lit("x")), stack).when(b.isin("(", "[", "{"), F.concat(stack, b))
        for close, opening in closes:
            out = out.when((b == close) & F.endswith(stack, F.lit(opening)), F.substring(stack, F.lit(1), F.length(stack) - 1))
        return out.otherwise(F.lit("x"))

    found = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(r"[()\[\]{}]"), F.lit(0))
    return F.aggregate(found, F.lit(""), step) != ""


#: What may stand between an opening fence and the code: a language at the line's end, or nothing.
ANY_FENCE = rf"(?:[A-Za-z]+[ \t\r]*\n|{SPACE}*)"


def code_blocks(c: Column | str, language: str | None = None) -> Column:
    """The contents of all fenced blocks, or of those fenced in the language (in any case); code may follow the fence on its line."""
    head = ANY_FENCE if language is None else rf"(?:{language}){SPACE}+"
    return F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(rf"(?si)```{head}(.*?)```"), F.lit(1))


def code_or_text(c: Column | str, language: str = "python") -> Column:
    """The first block fenced in the language, else the first fenced one, else the text; trimmed."""
    return trimmed(F.coalesce(F.get(code_blocks(c, language), F.lit(0)), F.get(code_blocks(c), F.lit(0)), _c(c)))


def is_foreign(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(FOREIGN), F.lit(False))


def first_symbol(c: Column | str) -> Column:
    """The first ``EXCHANGE:PAIR`` or ``EXCHANGE:PAIR:QUOTE``, else empty."""
    return F.coalesce(F.regexp_extract(_c(c), SYMBOL, 0), F.lit(""))


def joined_upper(values: Column | str, by: str = ",") -> Column:
    return F.array_join(F.transform(_c(values), F.upper), by)


def file_safe(c: Column | str) -> Column:
    return F.translate(_c(c), "/:", "__")


def identifiers(c: Column | str) -> Column:
    """Distinct identifiers of three or more characters whose letters aren't all capitals, in lower case."""
    found = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(WORD), F.lit(0))
    return F.array_distinct(F.transform(F.filter(found, lambda w: w.rlike(IDENTIFIER) & (F.length(w) > 2) & ~w.rlike("^[A-Z0-9_]*[A-Z][A-Z0-9_]*$")), F.lower))


def picked_lines(c: Column | str, term: str, k: int, width: int) -> Column:
    """The first ``k`` lines with ``term``, trimmed and cut to ``width``."""
    found = F.filter(lines(F.coalesce(_c(c), F.lit(""))), lambda x: F.contains(x, F.lit(term)))
    return F.transform(F.slice(found, 1, k), lambda x: F.left(trimmed(x), F.lit(width)))


def first_filled(*cs: Column | str) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cs])


def first_nonzero(*cs: Column | str) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit(0)) for c in cs], F.lit(0))


def first_number(c: Column | str) -> Column:
    """The first run of digits without thousands separators, else 0."""
    digits = F.regexp_extract(F.replace(_c(c), F.lit(","), F.lit("")), "([0-9]+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def parsed_score(c: Column | str, low: float, high: float, default: float) -> Column:
    """The first number in a judge's answer, clamped."""
    number = F.regexp_extract(_c(c), r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    return F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(float(low))), F.lit(float(high)))).otherwise(F.lit(float(default)))


def percent_score(c: Column | str, default: float = 0.5) -> Column:
    """The first whole number of one to three digits in a judge's answer as a share of 100, at most 1."""
    number = F.regexp_extract(_c(c), r"(?:^|[^\p{L}\p{N}_])([0-9]{1,3})(?:[^\p{L}\p{N}_]|$)", 1).try_cast("double")
    return F.when(number.isNotNull(), F.least(number / 100.0, F.lit(1.0))).otherwise(F.lit(float(default)))


def syntax_grade(text: str | None) -> float:
    """1.0 for Python code (nothing at all is also), 0.2 with a syntax error, 0.4 where the parser gives up otherwise."""
    try:
        ast.parse(text or "")
        return 1.0
    except SyntaxError:
        return 0.2
    except (ValueError, RecursionError, MemoryError):
        return 0.4


@F.pandas_udf(T.DoubleType())
def python_grade(code: pd.Series) -> pd.Series:
    return code.map(lambda t: syntax_grade(t if isinstance(t, str) else None))


def is_python(text: str | None) -> bool:
    try:
        return bool(text) and ast.parse(text) is not None
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False


@F.pandas_udf(T.BooleanType())
def python_parses(code: pd.Series) -> pd.Series:
    """Whether a text is Python code; it is parsed and never run. Null and empty are not."""
    return code.map(lambda t: is_python(t if isinstance(t, str) else None))
