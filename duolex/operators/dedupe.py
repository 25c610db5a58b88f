"""Exact duplicates, first occurrence kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duolex.functions.text import ColumnOrName, as_col
from duolex.session import small_side, stage


def text_key(*cols: ColumnOrName) -> Column:
    """256-bit digest of several texts; missing and empty differ, borders are marked."""
    parts = []
    for c in cols:
        col = as_col(c)
        parts.append(F.when(col.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(col).cast("string"), F.lit(":"), col)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def repeated_keys(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys that occur more than once with the first place of each.

    Counts and minima combine before the shuffle, so a key that holds a third
    of all rows arrives as one row per task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(order).alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def tag_later_copies(df: DataFrame, repeated: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds `is_copy`: true for every row after the first of its key.

    Only repeated keys are on the right. When their table is small it is
    broadcast and the rows do not move; else the join is by key, and a heavy key
    is split on the row side.
    """
    return (
        df.join(repeated.select(*keys, "first_id"), keys, "left")
        .withColumn("is_copy", F.coalesce(F.col(order) > F.col("first_id"), F.lit(False)))
        .drop("first_id")
    )


def keep_first(df: DataFrame, cols: list[str], order: str, within: list[str] | None = None) -> DataFrame:
    """First row of each set of equal texts, per file if `within` says so.

    Repeated keys are staged; while they fit a broadcast the texts do not move.
    """
    keys = [*(within or []), "text_key"]
    keyed = df.withColumn("text_key", text_key(*cols))
    repeated = small_side(stage(repeated_keys(keyed, keys, order), "repeated"))
    return tag_later_copies(keyed, repeated, keys, order).filter(~F.col("is_copy")).drop("text_key", "is_copy")
