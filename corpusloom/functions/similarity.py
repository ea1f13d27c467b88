"""Similarity of pairs of codes, as column expressions where built-ins allow."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.clean import comparable_code
from corpusloom.functions.text import _c, char_count, identifiers

#: Patterns of keywords that two scripts may share (fixed values).
KEYWORDS = ("strategy", "indicator", "input", "plot", r"ta\.", r"math\.", r"request\.", "security")
#: Weights of text, structure, keywords, identifiers and length.
WEIGHTS = (0.3, 0.25, 0.25, 0.15, 0.05)


def jaccard(a: Column, b: Column) -> Column:
    """Of arrays as sets; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def keywords_in(code: Column | str, keywords: Sequence[str] = KEYWORDS) -> Column:
    """The keywords as they are spelled in the code: found in any case, but told apart by it."""
    c = F.coalesce(_c(code), F.lit(""))
    return F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(c, F.lit(f"(?i){k}"), F.lit(0)) for k in keywords])))


def keyword_similarity(a: Column | str, b: Column | str, keywords: Sequence[str] = KEYWORDS) -> Column:
    return jaccard(keywords_in(comparable_code(a), keywords), keywords_in(comparable_code(b), keywords))


def identifier_similarity(a: Column | str, b: Column | str) -> Column:
    return jaccard(identifiers(comparable_code(a)), identifiers(comparable_code(b)))


def length_similarity(a: Column | str, b: Column | str) -> Column:
    x, y = char_count(comparable_code(a)), char_count(comparable_code(b))
    return 1 - F.abs(x - y) / F.greatest(x, y, F.lit(1))


def structural_similarity(a: Column | str, b: Column | str) -> Column:
    """1 if the codes are equal without comments and spacing, else 0; null is empty."""
    plain = lambda c: F.coalesce(comparable_code(c), F.lit(""))
    return (plain(a) == plain(b)).cast("double")


def overall_similarity(parts: Sequence[Column], weights: Sequence[float] = WEIGHTS) -> Column:
    total = F.lit(0.0)
    for p, w in zip(parts, weights):
        total = total + p * F.lit(w)
    return total


def similarity_level(c: Column | str) -> Column:
    return F.when(_c(c) > 0.7, "High").when(_c(c) > 0.4, "Medium").otherwise("Low")


def similarity_confidence(text: Column | str, structure: Column | str) -> Column:
    top = F.greatest(_c(text), _c(structure))
    return F.when(top > 0.6, "High").when(top > 0.3, "Medium").otherwise("Low")


def set_differences(a: Column, b: Column, k: int = 10) -> tuple[Column, Column]:
    """What only one side has, sorted, the first ``k`` of each."""
    return F.slice(F.array_sort(F.array_except(a, b)), 1, k), F.slice(F.array_sort(F.array_except(b, a)), 1, k)


def gram_cosine(pairs: DataFrame, key: str, a: str, b: str, sizes: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """(key, cosine): cosine of the TF-IDF vectors of character n-grams; the two texts of a pair are the whole collection, so a
    gram has the weight 1 if both have it, else 1 + ln(3 / 2). The grams are counted by an aggregation over the pair's key."""
    none = F.array().cast("array<string>")
    of_size = lambda c, n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))).otherwise(none)
    grams = lambda c: F.flatten(F.array(*[of_size(c, n) for n in sizes]))
    text = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    one = lambda c, side: pairs.select(key, F.explode(grams(text(c))).alias("gram"), F.lit(side).alias("side"))
    counts = one(a, 0).union(one(b, 1)).groupBy(key, "gram").agg(F.sum(1 - F.col("side")).alias("x"), F.sum("side").alias("y"))
    weight = F.when((F.col("x") > 0) & (F.col("y") > 0), F.lit(1.0)).otherwise(F.log(F.lit(1.5)) + 1)
    w = counts.select(key, (F.col("x") * weight).alias("x"), (F.col("y") * weight).alias("y"))
    sums = w.groupBy(key).agg(F.sum(F.col("x") * F.col("y")).alias("xy"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    found = sums.select(key, F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).otherwise(F.lit(0.0)).alias("cosine"))
    return pairs.select(key).join(found, key, "left").select(key, F.coalesce("cosine", F.lit(0.0)).alias("cosine"))


def code_similarities(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, text, structure, keywords, identifiers, length, overall): the five similarities of each pair's codes and their weighted
    sum. ``key`` is unique; null codes are empty."""
    plain = pairs.select(key, F.coalesce(comparable_code(a), F.lit("")).alias("a"), F.coalesce(comparable_code(b), F.lit("")).alias("b"))
    parts = plain.select(key, structural_similarity("a", "b").alias("structure"), jaccard(keywords_in("a"), keywords_in("b")).alias("keywords"), jaccard(identifiers("a"), identifiers("b")).alias("identifiers"), length_similarity("a", "b").alias("length"))
    both = gram_cosine(plain, key, "a", "b").withColumnRenamed("cosine", "text").join(parts, key)
    names = ("text", "structure", "keywords", "identifiers", "length")
    return both.select(key, *names, overall_similarity([F.col(n) for n in names]).alias("overall"))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts, characters that are frequent in long ones left out of account; null counts as empty."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def unified_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(["\n".join(difflib.unified_diff((x or "").split("\n"), (y or "").split("\n"), lineterm="")) for x, y in zip(a, b)], dtype="object")
