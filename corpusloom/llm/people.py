"""Persons behind differently written names and accounts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.components import components

#: Words that may stand before a name without being part of it.
LEAD_INS = ("by",)
_LEAD = re.compile(rf"^[\W_]*(?:{'|'.join(LEAD_INS)})[\s:]+(?=.*\w)", re.IGNORECASE | re.DOTALL)
_ACCOUNT = re.compile(r"/u/([^/?#]+)", re.IGNORECASE)


def name_key(name: str | None) -> str | None:
    """A name without letter case, spacing, punctuation, invisible and decorating characters, width and lead-in word; null
    if nothing is left. Letters and digits are kept as they are, so names that differ in one stay apart."""
    if not name:
        return None
    name = _LEAD.sub("", unicodedata.normalize("NFKC", name))
    key = "".join(ch for ch in name.casefold() if ch.isalnum())
    return key or None


def account_key(url: str | None) -> str | None:
    """The account of a profile address ``.../u/<account>``, whatever follows it; accounts and names share one namespace."""
    found = _ACCOUNT.search(url) if url else None
    return name_key(found[1]) if found else None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _keys(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
    known: dict[str, str | None] = {}
    for batch in names:
        out = []
        for row in batch:
            keys = []
            for i, raw in enumerate(row):
                if raw is None:
                    continue
                mark = f"{i >= 3}{raw}"
                if mark not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[mark] = account_key(raw) if i >= 3 else name_key(raw)
                if known[mark] is not None and known[mark] not in keys:
                    keys.append(known[mark])
            out.append(keys)
        yield pd.Series(out)


@F.pandas_udf(T.StringType())
def name_node(names: pd.Series) -> pd.Series:
    """The key of a single name."""
    return names.map(lambda n: name_key(n) if isinstance(n, str) else None)


def person_keys() -> Column:
    """The distinct keys of the names and accounts of a row of ``strategies``, an empty array if it has none."""
    return _keys(F.array("author", "user_info.username", "preview_author", "user_info.profile_url", "preview_author_url"))


def star(keys: str) -> Column:
    """Edges (u, v) from a row's first key to each of its keys, itself included."""
    return F.expr(f"transform({keys}, k -> struct({keys}[0] as u, k as v))")


def persons(rows: DataFrame, keys: str = "keys") -> DataFrame:
    """(node, root): the person of every key; keys of one row name one person. Edges are combined before they are shuffled."""
    return components(rows.where(F.size(keys) > 0).select(F.explode(star(keys)).alias("e")).select("e.*").distinct())
