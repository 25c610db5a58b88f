"""Replacements of tokens from a table of any size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from duolex.session import broadcast_bytes, delete_staged, stage

# Entries that a task may hold as a dictionary.
MAX_ENTRIES = 500_000
MAX_BYTES = 32 << 20


def _entries(table: DataFrame) -> DataFrame:
    """One replacement per token, the least where a table has several."""
    known = table.filter(F.col("token").isNotNull() & F.col("replacement").isNotNull())
    return known.groupBy("token").agg(F.min("replacement").alias("replacement"))


def _sent_out(entries: DataFrame):
    return entries.sparkSession.sparkContext.broadcast(
        {r["token"]: r["replacement"] for r in entries.select("token", "replacement").collect()})


def _fits(staged: DataFrame, max_entries: int, max_bytes: int) -> bool:
    return staged.count() <= max_entries and broadcast_bytes(staged) <= max_bytes


def small_entries(table: DataFrame, max_entries: int = MAX_ENTRIES, max_bytes: int = MAX_BYTES):
    """The replacements of a table as a dictionary in the tasks, or None, and the staged entries, if they do not fit."""
    entries = stage(_entries(table), "entries")
    if not _fits(entries, max_entries, max_bytes):
        return None, entries
    held = _sent_out(entries)
    delete_staged(entries)
    return held, None


def replaced(tokens: pa.Array, held: dict[str, str]) -> pa.Array:
    """The replacement of each token, null where it has none. Every distinct one is looked up once."""
    coded = tokens.dictionary_encode()
    return pa.array([held.get(t) for t in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)


def _finder(entries: DataFrame):
    held = _sent_out(entries)

    @F.arrow_udf("array<array<string>>")
    def find(asked: pa.Array) -> pa.Array:
        inner = asked.values
        inner = pa.ListArray.from_arrays(inner.offsets, replaced(inner.values, held.value))
        return pa.ListArray.from_arrays(asked.offsets, inner)

    # Keeps the optimizer from copying the call into filters and lambdas, where it would run again or not at all.
    return find.asNondeterministic()


def find_replacements(df: DataFrame, keys: list[str], asked: str, table: DataFrame, out: str,
                      max_entries: int = MAX_ENTRIES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Adds `out`: for each token of `asked`, an array of arrays without null arrays, its `replacement` in
    `table(token, replacement)`, null where it has none.

    A table of a counted size goes to the tasks, and rows are read once and stay where they are. Of a larger
    one only entries that some row asks for are kept, which may make it fit. If not, the distinct tokens of
    each row are joined with it and hits alone come back to the rows; `keys` must then name a row. Both large
    cases stage `df`, so whatever made its rows runs once.
    """
    entries = stage(_entries(table), "entries")
    small = _fits(entries, max_entries, max_bytes)
    if not small:
        df = stage(df, "asking")
        wanted = df.select(F.explode(F.flatten(asked)).alias("token")).distinct()
        needed = stage(entries.join(wanted, "token", "left_semi"), "entries")
        delete_staged(entries)
        entries, small = needed, _fits(needed, max_entries, max_bytes)
    if small:
        found = df.withColumn(out, _finder(entries)(F.col(asked)))
        delete_staged(entries)
        return found
    tokens = df.select(*keys, F.explode(F.array_distinct(F.flatten(asked))).alias("token"))
    hits = tokens.join(entries, "token").groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct("token", "replacement"))).alias("_hits"))
    return df.join(hits, keys, "left").withColumn(out, F.transform(
        asked, lambda a: F.transform(a, lambda t: F.try_element_at(F.col("_hits"), t)))).drop("_hits")
