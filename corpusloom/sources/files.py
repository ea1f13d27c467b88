"""Readers and writers of JSON and Parquet files, and their inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.mixing import exact_sample
from corpusloom.operators.select import first_n


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files of a JSON array or of one object; both give rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_envelope(spark: SparkSession, path: str, item: str, field: str = "results") -> DataFrame:
    """Files of ``{..., "results": [...]}`` or of a bare array of the same items."""
    wrapped = spark.read.schema(f"{field} array<struct<{_inner(spark, item)}>>").option("multiLine", True).json(path).where(F.col(field).isNotNull()).selectExpr(f"inline({field})")
    bare = read_json(spark, path, item)
    return wrapped.unionByName(bare.where(F.coalesce(*[F.col(c).isNotNull() for c in bare.columns]) if len(bare.columns) == 1 else _any_set(bare)))


def _inner(spark: SparkSession, item: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in spark.createDataFrame([], item).schema)


def _any_set(df: DataFrame):
    out = F.lit(False)
    for c in df.columns:
        out = out | F.col(c).isNotNull()
    return out


def read_parquet(spark: SparkSession, path: str, pattern: str | None = None, tolerant: bool = False) -> DataFrame:
    """Parquet files by name pattern, columns of all files; ``tolerant`` skips unreadable ones, but if none can be read it is an error."""
    reader = spark.read.option("mergeSchema", True)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", True)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def newest_first(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, bytes, modified) of the files of a folder by name pattern, the one modified last first. Their content isn't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).orderBy(F.desc("modified"), "file")


def write_rows(df: DataFrame, path: str, columns: list[str], required: list[str], position: str | None = None, batch: int = 10) -> None:
    """Parquet with a fixed order of columns; rows that lack a required value (null or empty) are left out. With a ``position`` column
    there is a folder for each ``batch`` positions."""
    for c in required:
        df = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    if position is None:
        df.select(*columns).write.mode("append").parquet(path)
    else:
        df.select(F.expr(f"`{position}` div {batch}").alias("batch"), *columns).write.mode("append").partitionBy("batch").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A row a line, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_pairs(df: DataFrame, path: str, pair: list[str], metadata: list[str], **stats: Column) -> DataFrame:
    """Pairs and their metadata side by side; returns a row with the number of rows and the given aggregates."""
    df.select(*pair).write.mode("overwrite").json(f"{path}/pairs")
    df.select(*metadata).write.mode("overwrite").json(f"{path}/metadata")
    return df.agg(F.count("*").alias("rows"), *[c.alias(n) for n, c in stats.items()])


def write_run(df: DataFrame, path: str, every: int | None = None, position: str = "position", **metadata: str | int | float | bool) -> None:
    """Rows and the run's metadata (a row of its own), as a folder each. With ``every`` the rows are also saved by batches of so many
    positions, each in a folder that is complete as soon as it is there."""
    if every is not None:
        for b in sorted(r["b"] for r in df.select(F.expr(f"`{position}` div {every}").alias("b")).distinct().collect()):  # a row a batch
            df.where(F.expr(f"`{position}` div {every}") == b).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/intermediate/batch-{b}")
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/results")
    df.sparkSession.createDataFrame([tuple(metadata.values())], list(metadata)).write.mode("overwrite").json(f"{path}/metadata")


def file_inventory(df: DataFrame) -> DataFrame:
    """(file, size_mb, rows, columns, modified) of the files a DataFrame is read from; all have the DataFrame's columns."""
    m = F.col("_metadata")
    per = df.groupBy(m["file_path"].alias("file_path"), m["file_name"].alias("file"), m["file_size"].alias("size"), m["file_modification_time"].alias("modified")).agg(F.count("*").alias("rows"))
    return per.select("file", F.round(F.col("size") / 1048576, 2).alias("size_mb"), "rows", F.lit(len(df.columns)).alias("columns"), "modified")


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("size_mb").alias("size_mb"))


def latest_file(df: DataFrame) -> DataFrame:
    """(file): the one modified last."""
    return df.agg(F.max_by(F.col("_metadata.file_path"), F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"))).alias("file"))


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, filled, rows) for every column, in one pass."""
    types = dict(df.dtypes)
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"`{c}`").alias("filled"), F.col("__rows").alias("rows")) for c in df.columns])
    return counts.select(F.explode(each).alias("c")).select("c.*")


def inspected(df: DataFrame, order: str, n: int = 5, seed: int = 42) -> dict[str, DataFrame]:
    """The profile of a table, its first rows and a sample of as many."""
    return {"profile": column_profile(df), "head": first_n(df, order, n), "sample": exact_sample(df, order, n, seed)}
