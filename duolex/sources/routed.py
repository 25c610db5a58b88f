"""Routed rows in files of bounded size, whose number depends on the rows and not on the corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duolex.session import delete_staged, stage
from duolex.sources.sinks import routed_rows

ROWS_PER_FILE = 1_000_000
_ORDER = ["route", "Filename", "row_id", "sent_no"]
_MANIFEST = "route string, file string, n bigint, unnamed bigint, first string, last string"


def write_clustered(audit: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Writes the audit's rows below `path`, sorted by route, file and row, and returns the manifest.

    A folder per route holds files of about `rows_per_file` rows. Small corpora share a file; a corpus with
    most of the rows is cut over many, as rows are ranges of all four sort columns. The manifest has for
    each file its route, rows, rows without `Filename`, and the least and greatest `Filename`. It comes last:
    without one the layout is not complete and `read_clustered` fails. An existing `path` is an error.
    """
    spark = audit.sparkSession
    rows = stage(routed_rows(audit), "routed")
    n = rows.count()
    parts = max(1, -(-n // rows_per_file))
    rows.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER).write.partitionBy("route").parquet(f"{path}/rows")
    written = _rows(spark, path, rows.schema, [f"{path}/rows"]) if n else rows
    written.groupBy("route", F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("Filename").isNull(), 1)).alias("unnamed"),
        F.min("Filename").alias("first"), F.max("Filename").alias("last"),
    ).coalesce(1).write.parquet(f"{path}/manifest")
    spark.createDataFrame([], rows.schema).coalesce(1).write.parquet(f"{path}/columns")
    delete_staged(rows)
    return manifest(spark, path)


def _rows(spark: SparkSession, path: str, schema, files: list[str]) -> DataFrame:
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*files)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """route, file, n, unnamed, first, last: one row per file."""
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def read_clustered(spark: SparkSession, path: str, routes: list[str] | None = None,
                   corpora: list[str | None] | None = None) -> DataFrame:
    """Rows of the given routes and corpora (`Filename`; None stands for rows without one), all unless named.

    Only files that may hold such rows are opened; the driver gets their names.
    """
    schema = spark.read.parquet(f"{path}/columns").schema
    files, wanted = manifest(spark, path), F.lit(True)
    if routes is not None:
        files, wanted = files.filter(F.col("route").isin(routes)), wanted & F.col("route").isin(routes)
    if corpora is not None:
        named = [c for c in corpora if c is not None]
        missing = [F.col("unnamed") > 0] if None in corpora else []
        files = files.filter(_any([F.lit(c).between(F.col("first"), F.col("last")) for c in named] + missing))
        wanted &= _any([F.col("Filename").isin(named)] + [F.col("Filename").isNull() for _ in missing])
    found = [f"{path}/rows/route={r['route']}/{r['file']}" for r in files.select("route", "file").collect()]
    if not found:
        return spark.createDataFrame([], schema)
    return _rows(spark, path, schema, found).filter(wanted)
