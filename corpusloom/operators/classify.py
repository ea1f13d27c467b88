"""Classification by ordered rules, one label or several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import _c, any_of, word_count

# Fixed values. ``_B`` stands for a word's beginning and ``_S`` for white space: the shorthands for them mean other characters in
# other engines.
_B, _S = r"(?:^|[^A-Za-z0-9_])", r"[ \t\r\n]*"
STRATEGY, INDICATOR = rf"(?i){_B}strategy{_S}\(|@strategy", rf"(?i){_B}indicator{_S}\(|@indicator"
ORDER_CALL = r"(?i)strategy\.(?:entry|order|exit|close)"
PLOTS = rf"(?i){_B}(?:plot|plotshape|plotchar|plotarrow|hline|bgcolor|barcolor|fill|line\.new|box\.new|label\.new){_S}\("
ORDERS = rf"(?i){_B}(?:strategy\.entry|strategy\.order|strategy\.exit|strategy\.close|strategy{_S}\()"
THEMES = (
    ("complex_indicators", ("divergence", "multiple indicators")),
    ("multi_timeframe", ("timeframe", "multi-frame")),
    ("risk_management", ("risk", "money management")),
    ("machine_learning", ("machine learning", "ai")),
    ("unusual_patterns", ("moon", "unusual", "experimental")),
)
BUCKETS = (
    ("complex_indicators", ("divergence", "multiple indicators", "combine", "blend")),
    ("multi_timeframe", ("timeframe", "multi-frame", "htf", "higher timeframe")),
    ("risk_management", ("risk management", "position sizing", "money management")),
    ("machine_learning", ("machine learning", "neural", "ai", "algorithm")),
    ("unusual_patterns", ("moon phase", "unusual", "experimental", "novel")),
)


def script_kind(code: Column | str) -> Column:
    c = F.coalesce(_c(code), F.lit(""))
    return F.when(c.rlike(STRATEGY), "strategy").when(c.rlike(INDICATOR), "indicator").when(c.rlike(ORDER_CALL), "strategy").when(c.rlike(PLOTS), "indicator").otherwise("unknown")


def script_traits(code: Column | str, description: Column | str) -> dict[str, Column]:
    c = F.coalesce(_c(code), F.lit(""))
    return {"kind": script_kind(code), "has_plots": c.rlike(PLOTS), "has_orders": c.rlike(ORDERS), "description_words": word_count(description)}


def first_theme(text: Column | str, themes: Sequence[tuple[str, Sequence[str]]] = THEMES, other: str = "standard") -> Column:
    low, out = F.lower(F.coalesce(_c(text), F.lit(""))), None
    for name, terms in themes:
        hit = any_of(low, terms)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def all_themes(text: Column | str, buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS) -> Column:
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    return F.array_compact(F.array(*[F.when(any_of(low, terms), name) for name, terms in buckets]))


def by_theme(df: DataFrame, text: str, buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS, name: str = "theme") -> DataFrame:
    """A row for each bucket a row falls into."""
    return df.withColumn(name, F.explode(all_themes(text, buckets)))


def banded(value: Column | str, bands: Sequence[tuple[float, str]], other: str) -> Column:
    """The name of the first band whose lower bound the value reaches."""
    out = None
    for least, name in bands:
        hit = _c(value) >= least
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def acceptance_band(rate: Column | str) -> Column:
    return banded(rate, ((80, "excellent"), (60, "good"), (40, "fair")), "low")


#: Instructions by the first rule whose terms the description has (fixed values): all of a rule's sets must have one.
INSTRUCTIONS = (
    ((("sma", "moving average"), ("threshold",)), "Implement a Pine Script code for SMA-based strategy with dynamic thresholds."),
    ((("sma", "moving average"),), "Implement a Pine Script code for moving average crossover strategy."),
    ((("rsi",),), "Implement a Pine Script code for RSI-based trading signals."),
    ((("input",), ("parameter",)), "Implement a Pine Script code for configurable strategy parameters."),
    ((("threshold",), ("entry",)), "Implement a Pine Script code for threshold-based entry and exit signals."),
    ((("signal", "buy", "sell"),), "Implement a Pine Script code for trading signal generation."),
    ((("period",), ("sma",)), "Implement a Pine Script code for period-based SMA calculation and thresholds."),
)
INSTRUCTION = "Implement a Pine Script code for the described trading strategy."


def instruction_for(text: Column | str, rules: Sequence[tuple[Sequence[Sequence[str]], str]] = INSTRUCTIONS, other: str = INSTRUCTION) -> Column:
    """The instruction of the first rule that the text meets, ``other`` without one."""
    low, out = F.lower(F.coalesce(_c(text), F.lit(""))), None
    for sets, wanted in rules:
        hit = any_of(low, sets[0])
        for terms in sets[1:]:
            hit = hit & any_of(low, terms)
        out = F.when(hit, wanted) if out is None else out.when(hit, wanted)
    return out.otherwise(other)
