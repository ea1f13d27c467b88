"""Checked queries: each a Spark function and, where SQL can express it, the equal DuckDB statement."""

from corpusloom.queries import builtin, curation, texts  # noqa: F401
from corpusloom.queries.base import QUERIES, SQL  # noqa: F401
