"""Held-out test sentences kept out of training data.

The test lines are matched with the source side only, outer newlines off. The
joins carry no hint: the planner broadcasts a small line set and, for a large
one, shuffles and splits a source text that holds many of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duolex.functions.text import as_col, strip_newlines


def _line(src: str, normalise: bool) -> Column:
    return F.btrim(strip_newlines(src), F.lit(" ")) if normalise else strip_newlines(src)


def drop_test_lines(df: DataFrame, lines: DataFrame, src: str = "src", normalise: bool = False) -> DataFrame:
    """Rows whose source is no test line. `normalise` also takes off outer blanks."""
    return df.join(lines, _line(src, normalise) == lines["line"], "left_anti")


def leaked_rows(df: DataFrame, lines: DataFrame, src: str = "src", normalise: bool = False) -> DataFrame:
    """Rows whose source is a test line."""
    return df.join(lines, _line(src, normalise) == lines["line"], "left_semi")


def decontaminate(df: DataFrame, lines: DataFrame, src: str = "src", normalise: bool = False) -> DataFrame:
    """All rows with `leaked`, from one join. `lines` must be distinct."""
    marked = lines.select(as_col("line").alias("_line"))
    return (
        df.join(marked, _line(src, normalise) == F.col("_line"), "left")
        .withColumn("leaked", F.col("_line").isNotNull()).drop("_line")
    )
