"""Operators that a language model can back. A client is a picklable factory of a function from prompt to answer; without one each
operator gives its defined fallback, so that every plan is deterministic."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.clean import drawing_removed, emphasis_removed
from corpusloom.functions.prompts import reasoned_answer, reasoned_pair
from corpusloom.functions.score import analysis_score
from corpusloom.functions.text import _c, code_or_text, is_blank, is_foreign, joined_upper, parsed_score, python_parses, trimmed
from corpusloom.operators.classify import instruction_for
from corpusloom.operators.nested import flat_json_in, json_in

#: The parts a script is taken apart into (fixed values).
PARTS = ("strategy_setup", "input_params", "filtering_sys", "smart_money", "signal_gen", "risk_management", "core_method")
#: What converted code must contain (fixed values).
REQUIRED = ("import backtrader", "bt.Strategy", "def __init__", "def next")


@dataclass(frozen=True)
class Model:
    """``connect`` is called once a task and returns the function that answers a prompt; ``tries`` bounds retries."""

    connect: Callable[[], Callable[[str], str]]
    tries: int = 3

    def asker(self) -> Callable[[object], str | None]:
        """Of a prompt its answer; null for a null prompt and after failing tries."""
        ask = self.connect()

        def one(prompt: object) -> str | None:
            for _ in range(self.tries if isinstance(prompt, str) else 0):
                try:
                    return ask(prompt)
                except Exception:
                    continue
            return None

        return one


def _asked(df: DataFrame, prompt: Column, model: Model, name: str, kind: T.DataType, f: Callable[[Callable, object], object]) -> DataFrame:
    """``df`` with what ``f`` makes of the model and each row's prompt."""
    asked = df.withColumn("__prompt", prompt)
    schema = T.StructType([*df.drop(name).schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = model.asker()
        for batch in batches:
            yield batch.drop(columns=["__prompt", name], errors="ignore").assign(**{name: pd.Series([f(ask, p) for p in batch["__prompt"]], dtype="object", index=batch.index)})

    return asked.mapInPandas(run, schema)


def answered(df: DataFrame, prompt: Column, model: Model | None, name: str = "answer") -> DataFrame:
    """``df`` with the model's answer; null offline, for null prompts and after failing tries. Cheap filters belong before it."""
    if model is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    return _asked(df, prompt, model, name, T.StringType(), lambda ask, p: ask(p))


def answered_each(df: DataFrame, prompts: Column, model: Model | None, name: str = "answers") -> DataFrame:
    """``df`` with an array of the answers to each row's array of prompts."""
    if model is None:
        return df.withColumn(name, F.transform(prompts, lambda _: F.lit(None).cast("string")))
    return _asked(df, prompts, model, name, T.ArrayType(T.StringType()), lambda ask, ps: None if ps is None else [ask(p) for p in ps])


def _texts(*parts: Column | str) -> Column:
    """Plain strings as they are, columns with null as empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def assessed(df: DataFrame, text: str, model: Model | None = None, low: float = 0, high: float = 100, unparsed: float = 0.0, failed: float | None = None, name: str = "model_score", when: Column | None = None) -> DataFrame:
    """A score from the answer's first number, clamped: ``unparsed`` where there is none, ``failed`` (the same if not given) without an
    answer, so also offline. Rows that ``when`` doesn't hold for aren't asked about."""
    prompt = _texts("Rate the following.\n\n", F.col(text))
    out = answered(df, prompt if when is None else F.when(when, prompt), model, "__answer")
    score = F.when(F.col("__answer").isNull(), F.lit(float(unparsed if failed is None else failed))).otherwise(parsed_score("__answer", low, high, unparsed))
    return out.withColumn(name, score).drop("__answer")


def consistency(df: DataFrame, a: str, b: str, model: Model | None = None, name: str = "consistency") -> DataFrame:
    """A model's account of whether two codes do the same (of each the first 2,000 characters); a note of the failure without one."""
    prompt = _texts("Do these two scripts implement the same logic? Analyse and rate them from 0 to 100.\n\n1:\n", F.left(F.col(a), F.lit(2000)), "\n\n2:\n", F.left(F.col(b), F.lit(2000)))
    return answered(df, prompt, model, name).withColumn(name, F.coalesce(name, F.lit("Analysis failed: no answer")))


def generated(df: DataFrame, prompt: Column, model: Model | None = None, name: str = "generated_code") -> DataFrame:
    """Code written for a prompt: the answer's fenced block, else all of it; a note of the failure without an answer."""
    out = answered(df, prompt, model, "__answer")
    return out.withColumn(name, F.coalesce(code_or_text("__answer", "pine(?:script)?"), F.lit("Error: no answer"))).drop("__answer")


def translated(df: DataFrame, text: str, foreign: Column, model: Model | None = None) -> DataFrame:
    """The text in English and whether it was translated; texts that aren't foreign are never sent."""
    out = answered(df, F.when(foreign, _texts("Translate into English.\n\n", F.col(text))), model, "__answer")
    done = foreign & F.col("__answer").isNotNull()
    return out.withColumn("was_translated", F.coalesce(done, F.lit(False))).withColumn(text, F.when(done, F.col("__answer")).otherwise(F.col(text))).drop("__answer")


def translated_lines(df: DataFrame, lines: str, model: Model | None = None) -> DataFrame:
    """An array of texts with its foreign elements in English, and ``lines_translated``: whether any was. An element without an
    answer stays."""
    prompts = F.transform(F.col(lines), lambda x: F.when(is_foreign(x), F.concat(F.lit("Translate into English.\n\n"), x)))
    out = answered_each(df, prompts, model, "__answers")
    merged = F.zip_with(F.col(lines), F.col("__answers"), lambda old, new: F.coalesce(new, old))
    return out.withColumn("lines_translated", F.coalesce(F.exists("__answers", lambda x: x.isNotNull()), F.lit(False))).withColumn(lines, merged).drop("__answers")


def drawing_dropped(df: DataFrame, code: str, model: Model | None = None) -> DataFrame:
    """Drawing lines removed by rule; only codes in which the rule found some are shown to a model."""
    rule = drawing_removed(code)
    out = df.withColumn("__clean", rule["cleaned"]).withColumn("removed_lines", rule["removed"])
    out = answered(out, F.when(F.col("removed_lines") > 0, F.concat(F.lit("Remove what only draws.\n\n"), F.col("__clean"))), model, "__answer")
    return out.withColumn(code, F.coalesce("__answer", "__clean")).drop("__answer", "__clean")


def taken_apart(description: Column | str, code: Column | str) -> Column:
    """The offline form of taking a script apart: empty parts, all code in the last."""
    empty = F.struct(F.lit("").alias("description"), F.lit("").alias("code"))
    whole = F.struct(F.coalesce(_c(description), F.lit("")).alias("description"), F.coalesce(_c(code), F.lit("")).alias("code"))
    pairs: list[Column] = []
    for p in PARTS:
        pairs += [F.lit(p), whole if p == PARTS[-1] else empty]
    return F.create_map(*pairs)


def rewritten(df: DataFrame, text: str, code: str, least: float = 6.0, model: Model | None = None) -> DataFrame:
    """Descriptions that a model finds to match their code by less than ``least`` of 10, or says so, are written anew.

    Adds ``match_score`` (5 without a readable answer), ``original`` (the text that was replaced), ``was_rewritten`` and
    ``rewrite_failed`` (a new text was wanted but none came; the old one stays). Rows without a text or code are left alone.
    """
    both = ~is_blank(text) & ~is_blank(code)
    asked = answered(df, F.when(both, _texts("Rate from 0 to 10 how well the description matches the code, as JSON with match_score and needs_regeneration.\n\n", F.col(text), "\n\n", F.col(code))), model, "__match")
    found = F.from_json(flat_json_in("__match"), "match_score double, needs_regeneration boolean")
    out = asked.withColumn("match_score", F.when(both, F.coalesce(found["match_score"], F.lit(5.0)))).withColumn("__wanted", both & ((F.col("match_score") < least) | F.coalesce(found["needs_regeneration"], F.lit(False))))
    out = answered(out, F.when(F.col("__wanted"), _texts("Describe what this code does.\n\n", F.col(code), "\n\nFor reference only:\n", F.col(text))), model, "__answer")
    new = F.when(F.col("__wanted"), F.nullif(trimmed(emphasis_removed("__answer")), F.lit("")))
    out = out.withColumn("__new", new).withColumn("was_rewritten", F.col("__new").isNotNull()).withColumn("rewrite_failed", F.col("__wanted") & F.col("__new").isNull())
    return out.withColumn("original", F.when(F.col("was_rewritten"), F.col(text))).withColumn(text, F.coalesce("__new", text)).drop("__match", "__wanted", "__answer", "__new")


def best_analysis(df: DataFrame, text: str, n: int = 3, model: Model | None = None, when: Column | None = None) -> DataFrame:
    """The best of ``n`` JSON analyses by ``analysis_score``, the first of equal ones: ``analysis`` (its text, null without any),
    ``analysis_score`` and ``candidates``. An answer that isn't JSON scores 0."""
    prompt = _texts("Analyse this as JSON.\n\n", F.col(text))
    prompts = F.when(F.lit(True) if when is None else when, F.transform(F.sequence(F.lit(1), F.lit(n)), lambda _: prompt))
    out = answered_each(df, prompts, model, "__answers")
    scored = F.transform("__answers", lambda a, i: F.struct(analysis_score(F.try_parse_json(json_in(a))).alias("score"), (-i).alias("at"), json_in(a).alias("analysis")))
    out = out.withColumn("__best", F.array_max(F.filter(scored, lambda x: x["analysis"].isNotNull())))
    return out.withColumn("analysis", F.col("__best.analysis")).withColumn("analysis_score", F.coalesce("__best.score", F.lit(0.0))).withColumn("candidates", F.lit(n)).drop("__answers", "__best")


def symbols_or_none(values: Column | str, most: int = 5) -> dict[str, Column]:
    """At most five symbols, upper case, joined; without any the confidence is low."""
    kept = F.slice(F.coalesce(_c(values), F.array().cast("array<string>")), 1, most)
    return {"symbols": joined_upper(kept), "confidence": F.when(F.size(kept) > 0, "high").otherwise("low")}


def inferred_symbols(df: DataFrame, text: str, model: Model | None = None, most: int = 5, when: Column | None = None) -> DataFrame:
    """``symbols`` (an array of at most five, upper case) and ``confidence`` (high, medium or low) that a model reads out of a text;
    none and low without a readable answer."""
    prompt = _texts("Which symbols does this trade? Answer as JSON with symbols and confidence.\n\n", F.col(text))
    out = answered(df, prompt if when is None else F.when(when, prompt), model, "__answer")
    found = F.from_json(json_in("__answer"), "symbols array<string>, confidence string")
    symbols = F.transform(F.slice(F.coalesce(found["symbols"], F.array().cast("array<string>")), 1, most), F.upper)
    return out.withColumn("symbols", symbols).withColumn("confidence", F.when(found["confidence"].isin("high", "medium", "low"), found["confidence"]).otherwise("low")).drop("__answer")


def converted(df: DataFrame, code: str, model: Model | None = None, attempts: int = 5, required: Sequence[str] = REQUIRED, when: Column | None = None) -> DataFrame:
    """``conversion``: a struct of ``code`` (null if no attempt gave code with all required parts), ``attempts`` and ``error``. Each
    attempt after the first is told what the one before lacked. Offline and for rows that ``when`` doesn't hold for there is no attempt."""
    kind = "struct<code:string,attempts:int,error:string>"
    if model is None:
        return df.withColumn("conversion", F.struct(F.lit(None).cast("string").alias("code"), F.lit(0).alias("attempts"), F.lit("no model").alias("error")))

    def convert(ask: Callable, source: object) -> dict:
        if not isinstance(source, str) or not source.strip():
            return {"code": None, "attempts": 0, "error": "no source code"}
        error = ""
        for k in range(attempts):
            answer = ask("Convert this script to a Backtrader strategy.\n\n" + source + (f"\n\nFix: {error}" if error else "")) or ""
            fence = next((m for p in (r"(?is)```python\s+(.*?)```", r"(?s)```\s*(.*?)```") if (m := re.search(p, answer))), None)
            found = (fence[1] if fence else answer).strip()
            missing = [r for r in required if r not in found]
            error = "empty answer" if not found else f"missing: {', '.join(missing)}" if missing else ""
            if not error:
                return {"code": found, "attempts": k + 1, "error": None}
        return {"code": None, "attempts": attempts, "error": error}

    source = F.left(F.col(code), F.lit(4000))
    return _asked(df, source if when is None else F.when(when, source), model, "conversion", T._parse_datatype_string(kind), convert)


def validated(code: Column | str) -> Column:
    """Whether converted code is Python. It is parsed and never run."""
    return F.coalesce(python_parses(_c(code)), F.lit(False))


def reasoned(df: DataFrame, description: str, code: str, model: Model | None = None) -> DataFrame:
    """``instruction`` and ``output`` for training on reasoned answers: from a model's response, else by template."""
    out = answered(df, _texts("Write an INSTRUCTION: and an OUTPUT: with thought and answer for this.\n\n", F.col(description), "\n\n", F.col(code)), model, "__answer")
    pair, none = reasoned_pair("__answer", description, code), F.col("__answer").isNull()
    asked = F.when(none, instruction_for(description)).otherwise(pair["instruction"])
    return out.withColumn("instruction", asked).withColumn("output_text", F.when(none, reasoned_answer(description, code)).otherwise(pair["output"])).drop("__answer")
