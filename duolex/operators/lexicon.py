"""Word replacement from a lexicon table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duolex.operators.lookup import find_replacements


def lookup_lexicon(df: DataFrame, text: str, key: str, lexicon: DataFrame, **limits) -> DataFrame:
    """Replace blank-separated tokens by `lexicon(token, replacement)`.

    Of several replacements of a token the least counts; a missing text stays missing. See
    `find_replacements` for how a lexicon of any size is read; `key` names a row.
    """
    tokens = F.split(text, " ", -1)
    asked = df.withColumn("_asked", F.array(F.coalesce(tokens, F.array().cast("array<string>"))))
    found = find_replacements(asked, [key], "_asked", lexicon, "_found", **limits)
    rewritten = F.array_join(F.zip_with(
        F.col("_found")[0], F.col("_asked")[0], lambda r, t: F.coalesce(r, t)), " ")
    return found.withColumn(text, F.when(F.col(text).isNotNull(), rewritten)).drop("_asked", "_found")
