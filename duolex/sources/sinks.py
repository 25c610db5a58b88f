"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duolex.session import STAGED_CODEC
from duolex.sources.corpus import CORPUS_COLUMNS

ROUTE_KEYS = ["route", "Filename", "Lang1", "Lang2"]


def _tsv(df: DataFrame, header: bool):
    return (
        df.write.option("sep", "\t").option("header", header)
        .option("quote", '"').option("escape", '"').option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )


def write_tsv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    _tsv(df, header).mode(mode).csv(path)


def write_tsv_by(df: DataFrame, path: str, *keys: str) -> None:
    """Header-less TSV files in a folder per value of `keys`, which the files do not hold."""
    _tsv(df, False).partitionBy(*keys).csv(path)


def routed_rows(audit: DataFrame) -> DataFrame:
    """Audit rows as they go to the route folders.

    A swapped pair goes out twice: swapped in `final`, and as it was, under the
    languages of its file, in `to_check`.
    """
    routes = F.when(
        F.col("drop_stage").isNull() & F.col("inverted"), F.array(F.lit("final"), F.lit("to_check"))
    ).otherwise(F.array(F.col("route")))
    back = (F.col("route") == "to_check") & F.col("inverted")

    def side(this: str, other: str):
        return F.when(back, F.col(other)).otherwise(F.col(this)).alias(this)

    return audit.withColumn("route", F.explode(routes)).select(
        "route", "Filename", "row_id", "sent_no", "File",
        side("Tr1", "Tr2"), side("Tr2", "Tr1"), side("Lang1", "Lang2"), side("Lang2", "Lang1"),
        "drop_stage", F.when(back, F.lit("inverted")).otherwise(F.col("reason")).alias("reason"),
    )


def write_routed(audit: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                 rebalance: bool = True) -> None:
    """One folder per route, file and language pair.

    With `rebalance` rows of a folder come together first, folders with little
    share a task and one with most of the rows is cut over many. Turn it off
    where a task already holds the rows of few folders.
    """
    rows = routed_rows(audit)
    if rebalance:
        rows = rows.hint("rebalance", *ROUTE_KEYS)
    writer = _tsv(rows, True) if fmt == "csv" else rows.write
    if fmt == "parquet":
        writer = writer.option("compression", STAGED_CODEC)
    writer.mode(mode).partitionBy(*ROUTE_KEYS).format(fmt).save(path)


def write_final_tsv(audit: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Kept pairs only, header-less, in the layout of the input files."""
    kept = audit.filter(F.col("drop_stage").isNull()).select(*CORPUS_COLUMNS)
    write_tsv(kept, path, header=False, mode=mode)


def write_training_shards(df: DataFrame, path: str, shard: str = "shard", length: str = "n_tokens",
                          order: str = "row_id", max_rows_per_file: int = 1_000_000,
                          mode: str = "errorifexists", dealt: bool = False) -> None:
    """Parquet files of whole shards, each in order of length. The rows are `dealt` if a task holds whole shards already."""
    rows = df if dealt else df.repartition(F.col(shard))
    (
        rows.sortWithinPartitions(shard, length, order)
        .write.mode(mode).option("maxRecordsPerFile", max_rows_per_file).option("compression", STAGED_CODEC).parquet(path)
    )
