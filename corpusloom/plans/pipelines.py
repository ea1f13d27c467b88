"""Pipelines composed of operators: lazy plans in which every row carries its status, with statistics from the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.clean import drawing_removed
from corpusloom.functions.score import code_quality, segment_score
from corpusloom.functions.text import first_filled, first_nonzero, is_foreign, word_count
from corpusloom.operators.classify import script_kind
from corpusloom.operators.dedup import keep_longest
from corpusloom.operators.filters import all_reasons, first_reason, script_checks, segment_checks, threshold_checks
from corpusloom.plans.models import Model, assessed, best_analysis, converted, inferred_symbols, rewritten, taken_apart, translated, validated


def script_pipeline(scripts: DataFrame, min_likes: int = 100, least: float = 5.0, model: Model | None = None) -> DataFrame:
    """Scripts to training pairs: filter, translate, drop drawing lines, score, filter by score. One stage, no shuffle."""
    likes = first_nonzero("likes_count", "preview_likes_count")
    kept = scripts.where(first_reason(script_checks("likes_count", "description", "source_code", min_likes)).isNull())
    spoken = translated(kept, "description", is_foreign("description"), model) if model else kept.withColumn("was_translated", F.lit(False))
    clean = drawing_removed("source_code")
    out = spoken.select("row_id", F.col("description").alias("input"), clean["cleaned"].alias("output"), clean["removed"].alias("removed_lines"), "was_translated", first_filled("name", "preview_title").alias("name"), likes.alias("likes"))
    return out.withColumn("score", code_quality("output")).where(F.col("score") >= least)


def restructure_pipeline(scripts: DataFrame) -> DataFrame:
    """Every script with its status: ``rejected`` and the reasons, or ``completed`` and the parts of its code."""
    likes = F.coalesce("likes_count", F.lit(0))
    reasons = all_reasons(threshold_checks(likes, "description"))
    ok = reasons == ""
    parts = F.when(ok, taken_apart("description", drawing_removed("source_code")["cleaned"]))
    return scripts.select("row_id", "id", reasons.alias("reasons"), F.when(ok, "completed").otherwise("rejected").alias("status"), parts.alias("components"))


def segment_pipeline(segments: DataFrame, least: float = 6.0, *, translate: bool = False, augment: bool = False, dedup: bool = True, model: Model | None = None) -> DataFrame:
    """Segments to pairs: filter, keep the longest description of equal codes, translate and rewrite descriptions where asked for,
    score, filter by score. Without segments there is nothing to do at any stage."""
    kept = segments.where(first_reason(segment_checks("input", "output")).isNull())
    return composed(
        kept,
        (dedup, lambda d: keep_longest(d, "output", "input", "segment_id")),
        (translate, lambda d: translated(d, "input", is_foreign("input"), model)),
        (augment, lambda d: rewritten(d, "input", "output", model=model)),
        (True, lambda d: d.withColumn("score", segment_score("input", "output")).where(F.col("score") >= least)),
    )


def staged(df: DataFrame, stages: list[tuple[str, Column]], done: str = "completed") -> DataFrame:
    """``status``: the first stage whose condition a row fails, as ``rejected_by_<stage>``, else ``done``; a null condition fails."""
    out = None
    for name, passes in stages:
        fails = ~F.coalesce(passes, F.lit(False))
        out = F.when(fails, f"rejected_by_{name}") if out is None else out.when(fails, f"rejected_by_{name}")
    return df.withColumn("status", out.otherwise(done))


def agent_pipeline(scripts: DataFrame, min_words: int = 100, model: Model | None = None, min_score: float = 40.0, candidates: int = 3) -> DataFrame:
    """Every script with the stage it came to: classification, filter by length and score, conversion, validation, then (for those
    that are left) analysis, symbols and reasoning. Without a model there are the first two stages only, the score passing."""
    gates = [("classifier", script_kind("source_code") == "strategy"), ("filter", word_count("description") >= min_words)]
    if model is None:
        return staged(scripts, gates)
    early = gates[0][1] & gates[1][1]
    out = assessed(scripts, "description", model, 0, 100, unparsed=0.0, name="filter_score", when=early)
    live = early & (F.col("filter_score") >= min_score)
    out = converted(out, "source_code", model, when=live)
    out = out.withColumn("validation_result", validated("conversion.code"))
    out = best_analysis(out, "description", candidates, model, when=F.col("validation_result"))
    out = inferred_symbols(out, "description", model, when=F.col("validation_result")).withColumn("reasoning", F.when(F.col("validation_result"), F.lit("")))
    return staged(out, [gates[0], ("filter", live), ("conversion", F.col("conversion.code").isNotNull()), ("validation", F.col("validation_result"))])


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))


def composed(df: DataFrame, *steps: tuple[bool, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The enabled steps one after the other."""
    for enabled, step in steps:
        df = df.transform(step) if enabled else df
    return df


def observed(df: DataFrame, name: str, **metrics: Column):
    """The DataFrame and an observation of its metrics, taken while it is written."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen
