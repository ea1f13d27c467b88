"""Incremental processing with Structured Streaming: checkpoints take the place of saved positions, and each file is read once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def increments(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process what has arrived since the last run and end; output and progress are exactly-once."""
    stream = stream.transform(transform) if transform else stream
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, key: str, value: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and sum by window and key; with a watermark, so that state of closed windows is dropped. Works on streams and tables."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total")).select(F.col("w.start").alias("starts"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("starts"), F.col("w.end").alias("ends"), "n")


def deduplicated(events: DataFrame, time: str, *keys: str, late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark on streams, once at all on tables."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys)) if events.isStreaming else events.dropDuplicates(list(keys))


class SavedProgress:
    """A run's progress in a shared folder, as a table of its states: show the last, set another, reset with a backup. A state is
    written whole before it counts, so a crash leaves the one before."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _states(self) -> DataFrame:
        self.spark.createDataFrame([], "version long, kind string, state string").write.mode("append").parquet(self.path)  # so that there is a table
        return self.spark.read.schema("version long, kind string, state string").parquet(self.path)

    def _last(self) -> tuple[int, dict]:
        row = self._states().agg(F.max_by(F.struct("version", "kind", "state"), "version").alias("r")).first()["r"]
        return (-1, {}) if row is None else (row["version"], json.loads(row["state"]) if row["kind"] == "set" else {})

    def _add(self, version: int, kind: str, state: dict) -> None:
        self.spark.createDataFrame([(version, kind, json.dumps(state, sort_keys=True))], "version long, kind string, state string").coalesce(1).write.mode("append").parquet(self.path)

    def show(self) -> dict:
        return self._last()[1]

    def set(self, **values: int | str) -> dict:
        version, state = self._last()
        self._add(version + 1, "set", state | values)
        return state | values

    def reset(self) -> bool:
        """Whether there was a state; it stays in the table as the backup."""
        version, state = self._last()
        if state:
            self._add(version + 1, "reset", {})
        return bool(state)

    def backup(self) -> dict:
        """The last state before a reset, or the current one."""
        row = self._states().where("kind = 'set'").agg(F.max_by("state", "version").alias("s")).first()["s"]
        return json.loads(row) if row else {}


def resumed(df: DataFrame, key: str, done: DataFrame, process: Callable[[DataFrame], DataFrame], overwrite: bool = False) -> DataFrame:
    """Rows whose key is among the done ones come from there; the others are processed. ``overwrite`` processes all."""
    if overwrite:
        return process(df)
    again = done.join(df.select(key).distinct(), key, "left_semi")
    return process(df.join(done.select(key).distinct(), key, "left_anti")).unionByName(again, allowMissingColumns=True)
