"""Exact duplicates behind a two-pass Bloom filter, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duolex.llm.common import repeat_rows, row_mark
from duolex.session import small_side, stage

# A filter has a power of two of blocks of BLOCK_BITS bits, at most MAX_BLOCKS of 4 KB: 64 MB in all.
BLOCK_BITS = 32_768
MAX_BLOCKS = 16_384
BITS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _probes(sha: str, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a row and its two bits there, from disjoint hex digits of its digest."""
    def digits(first: int, n: int) -> Column:
        return F.conv(F.substring(sha, first, n), 16, 10).cast("bigint")

    return digits(1, 8) % blocks, [digits(9, 4) % BLOCK_BITS, digits(13, 4) % BLOCK_BITS]


def possibly_repeated(digests: DataFrame, sha: str, n_rows: int) -> DataFrame:
    """Adds `_repeated`: false only where no other row has the same digest.

    First pass: rows set two bits each in a blocked filter, and a bit that two rows set is marked in a
    second one. Counts combine in each task before anything moves. Second pass: a row both of whose bits
    are marked is possibly repeated. The marked filter has at most MAX_BLOCKS rows of 4 KB, whatever the
    input, and so may go to every executor. Past its capacity more rows count as possibly repeated;
    results stay the same.
    """
    blocks = 1
    while blocks * BLOCK_BITS < n_rows * BITS_PER_ROW and blocks < MAX_BLOCKS:
        blocks *= 2
    block, bits = _probes(sha, blocks)
    hits = digests.select(block.alias("_block"), F.explode(F.array_distinct(F.array(*bits))).alias("_bit"))
    twice = hits.groupBy("_block", "_bit").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = stage(twice.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_marked")), "bloom")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_marked", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    joined = digests.withColumn("_block", block).join(F.broadcast(marked), "_block", "left")
    return joined.withColumn("_repeated", F.coalesce(is_set(bits[0]) & is_set(bits[1]), F.lit(False))).drop(
        "_block", "_marked")


def find_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, keep_id, group_size, kept, text_sha256, _mark: the copies of a text and the row of it that stays.

    Texts are equal when they are the same without blanks, tabs and line ends (null: empty). The row with
    most code points stays, then that of the smallest key (null last), then the first read. Texts are read
    once; digests are staged. Rows with a digest of their own pass straight through, only the rest moves:
    minima combine in each task, and go back to the rows by broadcast after a count of their rows and bytes;
    beyond it the join back splits a text that makes up much of the table.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = stage(df.select(
        F.col(key), F.length(whole).alias("_chars"), F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
        row_mark(df).alias("_mark"), F.monotonically_increasing_id().alias("_row")), "digests")
    split = possibly_repeated(rows, "text_sha256", rows.count())
    candidates = stage(split.filter("_repeated"), "repeated")
    order = F.struct(-F.col("_chars"), F.col(key).isNull(), F.col(key), F.col("_row"))
    groups = candidates.groupBy("text_sha256").agg(
        F.min_by(F.struct(F.col(key).alias("keep_id"), F.col("_row").alias("keep_row")), order).alias("k"),
        F.count(F.lit(1)).alias("group_size")).select("text_sha256", "k.*", "group_size")
    groups = small_side(stage(groups, "copy-groups"), 500_000)  # then copies of one text stay where they are
    settled = candidates.join(groups, "text_sha256").select(
        key, "keep_id", "group_size", (F.col("_row") == F.col("keep_row")).alias("kept"), "text_sha256", "_mark")
    alone = split.filter("not _repeated").select(
        key, F.col(key).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"),
        "text_sha256", "_mark")
    return alone.unionByName(settled)


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with one row of each text, as `find_copies` decides; all columns are as they were."""
    found = find_copies(df, key, text)
    return repeat_rows(df, found.select(key, "_mark", F.col("kept").cast("int").alias("copies")), key)
