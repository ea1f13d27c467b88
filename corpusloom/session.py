"""Session building and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "corpusloom", **conf: str) -> SparkSession:
    """A single-node session with the settings every checked query assumes."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()
_written: list[str] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application, so that they needn't have it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="corpusloom-")) / "corpusloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Where it is unset a temporary one, on a single
    machine only; on a cluster, whose machines don't share one, it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for so many rows, at least the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def stored_at(df: DataFrame, name: str, *by: str) -> str:
    """Write ``df`` as a Parquet table in the shared folder, in folders by columns if any are given; its path."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.partitionBy(*by).parquet(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables that ``stored`` and ``stored_at`` have written so far, once the results that read them are no longer
    needed; how many there were. Checkpoints are deleted by Spark where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    context, count = spark.sparkContext, len(_written)
    while _written:
        path = context._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return count


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: columnar and compressed, for tables that are
    read several times with different columns."""
    return df.sparkSession.read.schema(df.schema).parquet(stored_at(df, name))
