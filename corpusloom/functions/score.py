"""Rule-based scores as sums of column expressions over vocabularies.

The vocabularies are parameters; their defaults are fixed values. Terms are matched as substrings of the lower-cased text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import WORD, _c, any_of, balanced, bound, bracket_fault, char_count, hit_count, is_python, occurrences, percent_score, python_grade, trimmed

# Fixed values.
SEGMENT_TERMS = ("sma", "ema", "rsi", "macd", "ta.", "close", "open", "high", "low", "volume", "strategy", "input", "threshold")
SEGMENT_CODE = ("=", "ta.", "input.", "strategy.", "(", ")", "*", "+", "-")
SEGMENT_NAMES = ("threshold", "signal", "entry", "exit", "period", "length")
GENERIC = ("this strategy uses", "the strategy", "it uses", "based on")
SPECIFIC = ("200-day", "sma", "moving average", "crossover", "threshold", "signal", "entry", "exit")
CODE_FUNCTIONS = ("ta.sma", "ta.ema", "ta.rsi", "ta.macd", "ta.stoch", "strategy.entry", "strategy.close", "strategy.exit", "plot", "plotshape", "label.new", "line.new")
STRATEGY_FUNCTIONS = ("ta.sma", "ta.ema", "ta.rsi", "ta.macd", "ta.stoch", "ta.atr", "strategy.entry", "strategy.exit", "strategy.close", "plot", "plotshape", "plotchar", "label.new", "line.new")
TRADING = ("bt.", "backtrader", "strategy", "indicator", "signal")
RISKS = ("risk", "stop loss", "position size", "drawdown")
LOGIC = ("because", "therefore", "since", "as a result", "consequently")
EXPLAIN = ("strategy", "approach", "method", "technique", "algorithm")
GROUPS = (
    ("entry", "buy", "long", "signal"),
    ("exit", "sell", "short", "close"),
    ("stop", "loss", "risk", "drawdown", "position_size"),
    ("sma", "ema", "rsi", "macd", "bollinger", "vix", "atr"),
    ("backtest", "performance", "sharpe", "returns"),
)
TECHNICAL = ("algorithm", "strategy", "indicator", "signal", "portfolio", "volatility", "momentum", "trend", "support", "resistance", "timeframe", "market", "price", "volume")
#: Terms of ``keyword_relevance``, which says what repeats mean.
RELEVANT = (
    "sma", "ema", "rsi", "macd", "bollinger", "stochastic", "atr", "adx", "momentum", "williams", "cci", "roc", "trix", "aroon", "vortex",
    "buy", "sell", "signal", "entry", "exit", "stop", "profit", "loss", "position", "trade", "strategy", "backtest", "portfolio", "risk", "return", "equity", "drawdown", "sharpe", "volume", "price",
    "dataframe", "close", "open", "high", "low", "volume", "date", "pandas", "numpy", "bt", "backtrader", "zipline", "pyfolio",
    "def", "class", "import", "return", "if", "for", "while", "calculate", "compute", "analyze", "indicator", "signal",
)
FINANCE = ("profit", "loss", "return", "volatility", "sharpe", "drawdown")
NEW = ("novel", "innovative", "unique", "creative", "advanced", "hybrid")
DOCSTRING = r'(?s)""".*?"""|' + r"(?s)'''.*?'''"
NAME = r"(?:^|[^A-Za-z0-9_])[a-z_][a-z0-9_]*(?:[^A-Za-z0-9_]|$)"
FORMULA = r"[0-9]+[ \t]*[+\-*/][ \t]*[0-9]+|[A-Za-z][ \t]*[+\-*/=][ \t]*[A-Za-z0-9]"


def _low(c: Column | str) -> Column:
    return F.lower(F.coalesce(_c(c), F.lit("")))


def _if(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(float(points))).otherwise(F.lit(0.0))


def _capped(hits: Column, each: float, cap: float) -> Column:
    return F.least(hits * F.lit(float(each)), F.lit(float(cap)))


def _sum(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def segment_score(description: Column | str, code: Column | str) -> Column:
    """1 to 10: base 3, bonuses for length, terms, code characters, names and specific wording, deductions for notes and generic wording."""
    d, c, raw = _low(description), _low(code), F.coalesce(_c(code), F.lit(""))
    both = F.concat(d, F.lit(" "), c)
    parts = [
        F.lit(3.0),
        _if(char_count(description) > 50, 1), _if(char_count(description) > 100, 0.5), _if(char_count(code) > 20, 1), _if(char_count(code) > 50, 0.5),
        _capped(hit_count(both, SEGMENT_TERMS), 0.4, 2.5), _capped(hit_count(raw, SEGMENT_CODE), 0.2, 1.5), _capped(hit_count(c, SEGMENT_NAMES), 0.3, 1.0),
        _if(c.contains("note:") | trimmed(raw).startswith("note"), -2), hit_count(d, GENERIC) * F.lit(-0.3), _capped(hit_count(d, SPECIFIC), 0.2, 1.0),
    ]
    return F.greatest(F.lit(1.0), F.least(F.lit(10.0), _sum(parts)))


def code_quality(code: Column | str) -> Column:
    """0 to 10 from eight features of a script."""
    c = F.coalesce(_c(code), F.lit(""))
    parts = [
        _if(c.contains("//@version="), 1), _if(any_of(c, ("strategy(", "indicator(")), 2), _if(c.contains("input."), 1), _if(c.contains("ta."), 1.5),
        _if(any_of(c, ("strategy.entry", "strategy.close")), 2), _if(c.contains("plot("), 1), _if(hit_count(c, CODE_FUNCTIONS) >= 3, 1), _if(balanced(c), 0.5),
    ]
    return F.least(F.lit(10.0), _sum(parts))


def strategy_quality(code: Column | str) -> Column:
    """0 to 10, for strategies: entries and exits count apart, and five functions are asked for."""
    c = F.coalesce(_c(code), F.lit(""))
    parts = [
        _if(c.contains("//@version="), 1), _if(c.contains("strategy("), 2), _if(c.contains("input."), 1), _if(any_of(c, ("ta.", "math.", "array.")), 1.5),
        _if(c.contains("strategy.entry"), 2), _if(any_of(c, ("strategy.exit", "strategy.close")), 1.5), _if(any_of(c, ("plot(", "plotshape(")), 1), _if(hit_count(c, STRATEGY_FUNCTIONS) >= 5, 1),
    ]
    return F.least(F.lit(10.0), _sum(parts))


def length_score(c: Column | str, low: int = 50, good: int = 200, enough: int = 800, high: int = 2000) -> Column:
    """Piecewise linear over characters: 0.1 below ``low``, up to 1 at ``good``, down from ``enough`` to 0.3 at ``high``."""
    n = char_count(c).cast("double")
    return (
        F.when(n < low, F.lit(0.1)).when(n > high, F.lit(0.3)).when((n >= good) & (n <= enough), F.lit(1.0))
        .when(n < good, 0.1 + 0.9 * (n - low) / (good - low)).otherwise(0.3 + 0.7 * (high - n) / (high - enough))
    )


def keyword_relevance(c: Column | str, vocabulary: Sequence[str] = RELEVANT) -> Column:
    """0 to 1: 0.7 for up to 20 distinct keywords, 0.3 for up to 50 occurrences; those of a keyword listed twice count twice."""
    t, times = _low(c), Counter(vocabulary)
    total = _sum([occurrences(t, k) * F.lit(n) for k, n in times.items()])
    return F.lit(0.7) * F.least(hit_count(t, tuple(times)) / 20.0, F.lit(1.0)) + F.lit(0.3) * F.least(total / 50.0, F.lit(1.0))


def group_score(c: Column | str, groups: Sequence[Sequence[str]] = GROUPS) -> Column:
    """0.2 for each group with a term in the text, 0.2 more if at least four have; counted, so that no rounding decides."""
    met = _sum([any_of(_low(c), g).cast("int") for g in groups])
    return met * F.lit(0.2) + _if(met >= 4, 0.2)


def technical_score(c: Column | str) -> Column:
    t = _low(c)
    return _capped(hit_count(t, TECHNICAL), 0.05, 0.4) + _if(F.coalesce(_c(c), F.lit("")).rlike(FORMULA), 0.2) + _capped(hit_count(t, FINANCE), 0.05, 0.2)


def novelty_score(c: Column | str) -> Column:
    t = _low(c)
    return _capped(hit_count(t, NEW), 0.1, 0.3) + _if(any_of(t, ("combine", "hybrid")), 0.2) + _if(any_of(t, ("custom", "modified")), 0.2)


def reasoning_score(prompt: Column | str, response: Column | str) -> Column:
    """Logical and explaining words of the response, and the share of the prompt's words (repeats count) that it contains."""
    r = _low(response)
    asked = F.regexp_extract_all(_low(prompt), F.lit(WORD), F.lit(0))
    kept = lambda ws: bound(r, lambda t: F.size(F.filter(ws, lambda w: F.contains(t, w))))
    share = bound(asked, lambda ws: F.when(F.size(ws) > 0, kept(ws) / F.size(ws)).otherwise(F.lit(0.0)))
    return _capped(hit_count(r, LOGIC), 0.1, 0.3) + _capped(hit_count(r, EXPLAIN), 0.05, 0.2) + share * 0.3


def answer_code_score(response: Column | str) -> Column:
    """Fenced code, definitions, comments or docstrings, names in lower case; a deduction where brackets don't nest."""
    t = F.coalesce(_c(response), F.lit(""))
    return (
        _if(t.rlike(r"(?s)```.*?```"), 0.3) + _if(t.rlike(r"def [A-Za-z0-9_]+\(|class [A-Za-z0-9_]+"), 0.2)
        + _if(t.contains("#") | t.rlike(DOCSTRING), 0.2) + _if(t.rlike(NAME), 0.1) + _if(bracket_fault(t), -0.5)
    )


def composite_reward(prompt: Column | str, response: Column | str, weights: Sequence[float] = (0.3, 0.25, 0.2, 0.15, 0.1)) -> Column:
    """-1 to 1: weighted code, reasoning, completeness, technical and novelty scores, with bonuses for risk and docstrings and a
    deduction for short or unfinished answers."""
    t, raw = _low(response), F.coalesce(_c(response), F.lit(""))
    parts = [answer_code_score(response), reasoning_score(prompt, response), group_score(response), technical_score(response), novelty_score(response)]
    total = _sum([p * F.lit(float(w)) for p, w in zip(parts, weights)])
    total = total + _if(any_of(t, RISKS), 0.15) + _if(raw.rlike(r'(?s)""".*?"""'), 0.2)
    total = total + _if((char_count(response) < 50) | t.contains("incomplete"), -0.3)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total))


def completeness_reward(name: Column | str, description: Column | str, code: Column | str, reasoning: Column | str) -> Column:
    """0 to 1: presence of the fields (an empty string is present), lists in a description that is JSON, and terms of the code."""
    c, kinds = _low(code), ("key_concepts", "mathematical_models", "evaluation_metrics")
    data = F.from_json(_c(description), ", ".join(f"{k} string" for k in kinds))
    given = lambda k: F.coalesce(~data[k].isin("", "[]", "{}", "0", "false"), F.lit(False))
    parts = [_if(_c(x).isNotNull(), w) for x, w in ((name, 0.1), (description, 0.2), (code, 0.3), (reasoning, 0.2))]
    parts += [_if(given(k), 0.1) for k in kinds]
    parts += [
        _if(c.contains("stop") & c.contains("loss"), 0.05), _if(any_of(c, ("entry", "buy")), 0.05), _if(any_of(c, ("exit", "sell")), 0.05), _if(c.contains("risk"), 0.05),
        _if(any_of(c, ("def ", "class ")), 0.1), _if(c.contains("import"), 0.05),
    ]
    return F.least(F.lit(1.0), _sum(parts))


def answer_blocks(response: Column | str, least: int = 10) -> Column:
    """The fenced blocks over ``least`` characters; without any fence the whole text if it looks like code."""
    t = F.coalesce(_c(response), F.lit(""))
    fenced = F.transform(F.regexp_extract_all(t, F.lit(r"(?is)```(?:python)?(.*?)```"), F.lit(1)), trimmed)
    whole = F.when(any_of(t, ("def ", "class ", "import ", "from ", "bt.")), F.array(trimmed(t))).otherwise(F.array().cast("array<string>"))
    return F.filter(F.when(F.size(fenced) > 0, fenced).otherwise(whole), lambda b: F.length(b) > least)


def block_score(response: Column | str, valid: Column | None = None) -> Column:
    """0 to 1 over all blocks: imports, functions, classes, docstrings, comments, indentation and trading terms, and 2 points for
    each of the ``valid`` blocks (their number, see ``parsing_blocks``); 10 points are 1."""

    def points(b: Column) -> Column:
        has = lambda x: F.contains(b, F.lit(x))
        return (
            _if(b.rlike(r"(?m)^[ \t]*(?:import|from) "), 1) + _if(has("def "), 2) + _if(has("class "), 1.5) + _if(has('"""') | has("'''"), 1) + _if(has("#"), 0.5)
            + _if(b.rlike(r"(?m)^(?:    |\t)[ \t]*[^ \t\r\n]"), 1) + _if(any_of(F.lower(b), TRADING), 1)
        )

    blocks = answer_blocks(response)
    total = F.aggregate(F.transform(blocks, points), F.lit(0.0), lambda a, x: a + x)
    total = total if valid is None else total + valid * F.lit(2.0)
    return F.when(F.size(blocks) == 0, F.lit(0.1)).otherwise(F.least(total / 10.0, F.lit(1.0)))


@F.pandas_udf(T.IntegerType())
def parsing_blocks(blocks: pd.Series) -> pd.Series:
    """How many of an array's texts parse as Python; nothing is run."""
    return blocks.map(lambda bs: sum(map(is_python, bs if bs is not None else ())))


def small_reward(prompt: Column | str, response: Column | str, valid: Column | None = None) -> Column:
    """0 to 1: 0.4 of the blocks' score, 0.3 of the length's, 0.3 of the keywords'."""
    both = F.concat(F.coalesce(_c(prompt), F.lit("")), F.lit(" "), F.coalesce(_c(response), F.lit("")))
    return F.lit(0.4) * block_score(response, valid) + F.lit(0.3) * length_score(response) + F.lit(0.3) * keyword_relevance(both)


def judged_reward(similarity: Column | str, code: Column | str, weights: tuple[float, float] = (0.6, 0.4), default: float = 0.1) -> Column:
    """Two judges' scores combined and clamped to 0 to 1; the default where one is missing."""
    total = _c(similarity) * F.lit(weights[0]) + _c(code) * F.lit(weights[1])
    return F.when(total.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))).otherwise(F.lit(default))


def judged_code(response: Column | str, answer: Column | str) -> Column:
    """0.4 of the syntax of the response's first fenced block and 0.6 of what a judge answers about it; 0.3 without a block."""
    blocks = F.regexp_extract_all(F.coalesce(_c(response), F.lit("")), F.lit(r"(?s)```(?:python)?\s*(.*?)```"), F.lit(1))
    graded = python_grade(trimmed(F.coalesce(F.get(blocks, F.lit(0)), F.lit("")))) * F.lit(0.4) + percent_score(answer) * F.lit(0.6)
    return F.when(F.size(blocks) == 0, F.lit(0.3)).otherwise(graded)


#: Fields of an analysis and their points (fixed values).
ANALYSIS_WEIGHTS = {
    "title": 5.0, "abstract": 15.0, "main_algorithms": 15.0, "key_concepts": 10.0, "mathematical_models": 10.0, "implementation_requirements": 10.0,
    "evaluation_metrics": 5.0, "datasets_mentioned": 5.0, "high_level_logic": 15.0, "complexity_analysis": 5.0, "novelty": 10.0, "content_preview": 5.0,
}
#: Objects that count by one of their texts, and the characters it must exceed.
ANALYSIS_PARTS = {"main_algorithms": ("algorithms", 30), "content_preview": ("abstract_preview", 20)}


def analysis_score(value: Column) -> Column:
    """The completeness of an analysis (a variant, see ``parse_json``): the weights of texts over 20 characters, of lists of three or
    more, half for shorter ones, of objects half unless one of their texts decides; more for many concepts and models. 0 for a null,
    for what isn't an object, and for an analysis that tells an error."""
    at = lambda f, kind="variant": F.try_variant_get(value, f"$.{f}", kind)
    kind = lambda f: F.coalesce(F.schema_of_variant(at(f)), F.lit(""))
    size = lambda f: F.coalesce(F.size(at(f, "array<variant>")), F.lit(0))
    parts = []
    for field, weight in ANALYSIS_WEIGHTS.items():
        part, least = ANALYSIS_PARTS.get(field, (None, 0))
        # An object is empty if nothing stands between its brackets.
        as_object = _if(F.coalesce(F.length(at(f"{field}.{part}", "string")), F.lit(0)) > least, weight) if part else _if(~kind(field).isin("OBJECT<>"), weight / 2)
        as_list = F.when(size(field) >= 3, F.lit(weight)).when(size(field) >= 1, F.lit(weight / 2)).otherwise(F.lit(0.0))
        parts.append(
            F.when(kind(field) == "STRING", _if(F.length(at(field, "string")) > 20, weight))
            .when(kind(field).startswith("OBJECT"), as_object)
            .when(kind(field).startswith("ARRAY"), as_list)
            .otherwise(F.lit(0.0))
        )
    parts += [_if(size("key_concepts") >= 5, 5), _if(size("key_concepts") >= 10, 5), _if(size("mathematical_models") >= 3, 5)]
    sound = F.schema_of_variant(value).startswith("OBJECT") & (kind("parse_error") == "") & (kind("error") == "")
    return F.when(F.coalesce(sound, F.lit(False)), _sum(parts)).otherwise(F.lit(0.0))
