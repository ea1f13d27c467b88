"""Maps, arrays and JSON: packing, unpacking and repair."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import _c, code_blocks, trimmed

COMPONENT = "map<string,struct<description:string,code:string>>"


def packed(df: DataFrame, id_col: str, key: str, description: str, code: str) -> DataFrame:
    """(id, components): a map from key to (description, code) for each id; of repeated keys the longest code stays. Groups are
    the parts of one record. Rows with a null key are ignored."""
    part = F.struct(F.col(description).alias("description"), F.col(code).alias("code"))
    one = df.where(F.col(key).isNotNull()).groupBy(id_col, key).agg(F.max_by(part, F.struct(F.coalesce(F.length(code), F.lit(-1)), F.coalesce(F.col(code), F.lit("")), F.coalesce(F.col(description), F.lit("")))).alias("part"))
    return one.groupBy(id_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col("part"))))).alias("components"))


def unpacked(df: DataFrame, id_col: str, *components: str) -> DataFrame:
    """(id, key, input, output): a row for each component of the first of the given maps that is there; parts without a
    description or code are skipped, a null id is ``unknown``."""
    found = F.coalesce(*[F.col(c) for c in components])
    rows = df.select(F.coalesce(F.col(id_col), F.lit("unknown")).alias(id_col), F.explode(found).alias("key", "part"))
    return rows.where("part.description is not null and part.code is not null").select(id_col, "key", F.col("part.description").alias("input"), F.col("part.code").alias("output"))


def unpacked_nested(df: DataFrame, id_col: str, paths: Sequence[str], lineage: Sequence[str] = ()) -> DataFrame:
    """As ``unpacked``, from the first of the given paths (also of nested fields) that is there; ``lineage`` columns go with each
    row, ``unknown`` where they are null."""
    found = F.coalesce(*[F.col(p) for p in paths])
    kept = [F.coalesce(F.col(c), F.lit("unknown")).alias(c.split(".")[-1]) for c in (id_col, *lineage)]
    rows = df.select(*kept, F.explode(found).alias("key", "part"))
    return rows.where("part.description is not null and part.code is not null").select(*[c.split(".")[-1] for c in (id_col, *lineage)], "key", F.col("part.description").alias("input"), F.col("part.code").alias("output"))


def has_keys(components: Column | str, keys: list[str]) -> Column:
    """Whether a map has all keys, each with both of its fields."""
    out = F.lit(True)
    for k in keys:
        part = F.try_element_at(_c(components), F.lit(k))
        out = out & F.coalesce(part["description"].isNotNull() & part["code"].isNotNull(), F.lit(False))
    return out


def json_in(c: Column | str) -> Column:
    """JSON text in an answer: the block fenced as json, else the first fenced one, else all of it."""
    return trimmed(F.coalesce(F.get(code_blocks(c, "json"), F.lit(0)), F.get(code_blocks(c), F.lit(0)), _c(c)))


def flat_json_in(c: Column | str) -> Column:
    """The first braces without braces inside; empty without any."""
    return F.regexp_extract(_c(c), r"\{[^{}]+\}", 0)


@F.pandas_udf(T.StringType())
def balanced_json_in(c: pd.Series) -> pd.Series:
    """The first ``{...}`` whose braces balance outside strings and that is JSON; null without one."""

    def find(text: str | None) -> str | None:
        decoder, at = json.JSONDecoder(), (text or "").find("{")
        while at >= 0:
            try:
                _, end = decoder.raw_decode(text, at)
                return text[at:end]
            except (ValueError, RecursionError):
                at = text.find("{", at + 1)
        return None

    return pd.Series([find(t if isinstance(t, str) else None) for t in c], dtype="object")


def parsed(c: Column | str, schema: str) -> Column:
    """A struct of the schema; malformed JSON and fields of another type become null."""
    return F.from_json(_c(c), schema)


def checked_assessment(c: Column | str) -> dict[str, Column]:
    """The fields of a judge's JSON answer, each with its default where it is missing or of another type: a whole score within 0 and
    100, whether it passes, and the reason."""
    v = F.try_parse_json(json_in(c))
    at = lambda field, kind: F.try_variant_get(v, f"$.{field}", kind)
    kind = F.schema_of_variant(F.try_variant_get(v, "$.score", "variant"))
    number = F.when(kind.rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)"), at("score", "double"))
    flag = F.when(F.schema_of_variant(F.try_variant_get(v, "$.passed", "variant")) == "BOOLEAN", at("passed", "boolean"))
    return {"score": clamped(F.floor(number), 0, 100, 0).cast("long"), "passed": F.coalesce(flag, F.lit(False)), "reason": F.coalesce(at("reason", "string"), F.lit(""))}


def clamped(c: Column | str, low: float, high: float, default: float) -> Column:
    return F.when(_c(c).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), _c(c)))).otherwise(F.lit(default))


def overlaid(df: DataFrame, over: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` with the values of ``over`` (unique by key) where it has them."""
    o = over.select(F.col(key), *[F.col(c).alias(f"__o_{c}") for c in columns])
    joined = df.join(o, key, "left")
    return joined.select(*[F.coalesce(F.col(f"__o_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def rl_rows(df: DataFrame, id_col: str, name: str, prompt: Column, answer: Column, created_at: str, score: Column, source: str = "scripts", ability: str = "code") -> DataFrame:
    """Rows for reward training: prompt messages, ground truth and extra information as nested columns. Rows without a prompt
    or answer are skipped."""
    out = df.select(
        F.lit(source).alias("data_source"),
        F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))).alias("prompt"),
        F.lit(ability).alias("ability"),
        F.struct(F.lit("rule").alias("style"), answer.alias("ground_truth")).alias("reward_model"),
        F.struct(F.col(id_col).alias("strategy_id"), F.col(name).alias("strategy_name"), F.col(created_at).alias("created_at"), score.alias("reward_score")).alias("extra_info"),
    )
    return out.where("prompt[0].content is not null and reward_model.ground_truth is not null")
