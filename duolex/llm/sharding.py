"""Rendezvous hashing of record keys over weighted shards, in DataFrame functions alone."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from duolex.llm.common import ranked, unit_hash
from duolex.session import stage

ROWS_PER_RANGE = 500_000


def rendezvous(key: str | Column, weights: Sequence[float]) -> Column:
    """The shard whose score for the key is best; `weights[i]` is the share of shard i.

    A shard's score is -weight / ln(u), with u in (0, 1) from key and shard. Raising a weight or adding a
    shard moves rows into that shard only, and lowering or removing one moves only its own rows. Shards of
    weight 0 get nothing. Equal scores go to the smaller shard. A null key is a key like any other.
    """
    if not weights or any(not math.isfinite(w) or w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be finite, none negative, one positive")
    costs = [F.struct((-F.log(unit_hash(key, F.lit(i))) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard"))
             for i, w in enumerate(weights) if w]
    return (F.least(*costs) if len(costs) > 1 else costs[0])["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """Adds the shard of each row, in place of a column `out` if there is one; the other columns stay as they are.

    Rows that repeat a key share its shard; null keys share one, and an empty table stays empty.

    A narrow projection without any shuffle: nothing but the key and the weights decides.
    """
    return df.withColumn(out, rendezvous(key, weights))


def shard_index(df: DataFrame, key: str, text: str, weights: Sequence[float], grown: Sequence[float]) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of every row.

    `size` is the UTF-8 bytes of the text plus 1, a null text counting none (its checksum is that of the
    empty text); `slot` numbers the rows of a shard from 0 by key, checksum and size, null keys first;
    `grown_shard` is the shard under the weights `grown`. An empty table gives an empty one. Texts are read
    once and never shuffled: what moves is a few numbers per row, cut into ranges of bounded size.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key), (F.octet_length(whole).cast("bigint") + 1).alias("size"), F.crc32(whole).alias("text_crc32"))
    rows = rows.withColumns({
        "law": F.lit("key"), "shard": rendezvous(key, weights), "grown_shard": rendezvous(key, grown)})
    staged = stage(rows, "shards")
    ranges = max(1, -(-staged.count() // ROWS_PER_RANGE))
    return ranked(staged, ["shard"], [key, "text_crc32", "size"], "slot", ranges).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
