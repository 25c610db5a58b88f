"""Session defaults and the shared work folder that staged tables live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of a table that may be sent to every executor.
BROADCAST_BYTES = 128 << 20

# Texts take about two thirds of the room that they take with Spark's default codec.
STAGED_CODEC = "zstd"

_RUN_ID = uuid.uuid4().hex[:12]


def build_session(app: str = "duolex", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="duolex-")


def work_dir(spark: SparkSession) -> str:
    """This run's folder under the cluster's shared checkpoint folder.

    `spark.checkpoint.dir` names the folder, or `setCheckpointDir` did. Only a local session without
    either gets a temporary folder; on a cluster each machine would see its own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        base = _own_folder()
    return f"{base.rstrip('/')}/duolex-{_RUN_ID}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs run within the block; put back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and return a scan of what was written.

    The scan cuts the lineage, survives the loss of executors, freezes columns
    such as row ids that depend on how the input was split, lets later passes
    read single columns, and has a known size, so the planner can tell a table
    that fits a broadcast from one that does not.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", STAGED_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_bytes(staged: DataFrame) -> int:
    """What the rows of a staged table of plain columns take in memory: lengths of texts, 8 bytes a number, 16 a row."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) for name, kind in staged.dtypes if kind in ("string", "binary")]
    fixed = F.lit(16 + 8 * len(staged.columns))
    each = sum(texts, fixed).cast("bigint")
    return staged.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]


def small_side(staged: DataFrame, max_rows: int = 2_000_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A staged table of plain columns, marked for broadcast up to `max_rows` rows and `max_bytes` bytes.

    The count comes from the file footers, the bytes from a pass over a table that is small by then. A
    larger one is returned as it is and joins by shuffle, where a heavy key is split at run time.
    """
    fits = staged.count() <= max_rows and broadcast_bytes(staged) <= max_bytes
    return F.broadcast(staged) if fits else staged


def delete_staged(staged: DataFrame) -> None:
    """Delete the files of one staged table that is not read any more."""
    spark = staged.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if f"/duolex-{_RUN_ID}/" in f"{folder}/":
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this run staged. Call it when no result is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path, True)
