"""Mixing of sources to target weights: whole epochs, then a weighted sample without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from duolex.llm.common import ranked, repeat_rows, row_mark, small_or_shuffled, unit_hash
from duolex.session import stage

ROWS_PER_BUCKET = 1000
MAX_BUCKETS = 65_536


def count_words(text: str) -> Column:
    """Runs of characters other than blank, tab and line ends; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def quality_weight(text: str, size: str) -> Column:
    """1 where words have 2 to 12 characters on average, blanks aside; else, and without words, one half."""
    mean = F.try_divide(F.length(text) - F.col(size), F.col(size))
    return F.when(mean.between(2, 12), 1.0).otherwise(0.5)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds `target` to `source, source_size`: weights repeat over the sources by code point, null last.

    `share` times all sizes is dealt by weight. A target stops at `most` times its source's size and the
    excess is dealt anew by weight among the others until none is above. Only two sums per round reach
    the driver; sources are never gathered.
    """
    staged = stage(sizes.withColumn("_null", F.col("source").isNull()), "sources")
    placed = ranked(staged, [], ["_null", "source"], "_place", max(1, staged.count() // 500_000))
    ws = F.array(*[F.lit(float(w)) for w in weights])
    weighed = stage(placed.withColumns({
        "_weight": F.get(ws, (F.col("_place") % len(weights)).cast("int")), "_cap": F.col("source_size") * float(most)}),
        "weights")
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level = 0.0
    while True:
        full = F.col("_cap") <= F.lit(level) * F.col("_weight")
        used, open_weight = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).first()
        if not open_weight or (total - used) / open_weight <= level:
            break
        level = (total - used) / open_weight
    return weighed.select(
        "source", "source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("target"))


def mix(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        seed: int = 7, whole: bool = False) -> DataFrame:
    """`rows` (key, source, size, weight and others) with source_size, target, epochs, taken.

    A source gives as many whole epochs as its target holds. The rest is a weighted sample without
    replacement: rows in order of -ln(u) / weight, u from key and seed alone, up to the remaining words.
    The row on the border gives the words that are missing, or with `whole` all of them where that lands
    nearer. Rows of no words take nothing. Weights must be positive.

    A source may be any share of the table: sizes are summed by source and bucket of the order, which
    combines in each task; whole buckets are in or out, and only the bucket on a source's border, about
    ROWS_PER_BUCKET rows, is sorted. Rows of equal key go by their place in `rows`, which is staged.
    """
    u = unit_hash("key", F.lit(seed))
    drawn = stage(rows.withColumns({"_order": -F.log(u) / F.col("weight"), "_row": F.monotonically_increasing_id()}), "drawn")
    n, mean = drawn.agg(F.count(F.lit(1)), F.coalesce(F.avg("weight"), F.lit(1.0))).first()
    buckets = min(MAX_BUCKETS, max(16, n // ROWS_PER_BUCKET))
    bucket = F.floor((1 - F.exp(-F.col("_order") * F.lit(mean))) * buckets).cast("int")
    sums = stage(drawn.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_sum")), "buckets")
    targets = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    goals = stage(targets.withColumn("epochs", epochs).withColumn(
        "_left", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")), "targets")
    goals = goals.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    through = F.sum("_sum").over(W.partitionBy("source").orderBy("_bucket")).alias("_through")
    border = sums.select("source", "_bucket", "_sum", through).join(small_or_shuffled(goals), same).filter(
        (F.col("_through") > F.col("_left")) & (F.col("_through") - F.col("_sum") <= F.col("_left"))
    ).groupBy("_source").agg(F.min("_bucket").alias("_cut"), F.min_by(F.col("_through") - F.col("_sum"), "_bucket").alias("_before"))
    plan = stage(goals.join(border.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"),
                 "mix-plan")
    joined = drawn.withColumn("_bucket", bucket).join(small_or_shuffled(plan), same)
    on_border = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    inside = F.when(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")), F.col("size")).otherwise(0)
    clear = joined.filter(~on_border).withColumn("_part", inside)
    before = F.sum("size").over(W.partitionBy("source").orderBy("_order", "_row")) - F.col("size")
    room = F.col("_left") - F.col("_before") - before
    part = F.when(room >= F.col("size"), F.col("size")).when(room <= 0, 0)
    part = part.when(room * 2 >= F.col("size"), F.col("size")).otherwise(0) if whole else part.otherwise(room)
    split = joined.filter(on_border).withColumn("_part", part)
    return clear.unionByName(split).withColumn(
        "taken", (F.col("epochs") * F.col("size") + F.col("_part")).cast("bigint")
    ).drop("_order", "_row", "_bucket", "_cut", "_before", "_left", "_source", "_part")


def sized_rows(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What `mix` asks for, from a table of documents; texts are read once and left behind."""
    sized = df.select(F.col(key).alias("key"), F.col(source).alias("source"), count_words(text).alias("size"),
                      F.col(text).alias("_text"), row_mark(df).alias("_mark"))
    return sized.withColumn("weight", quality_weight("_text", "size")).drop("_text")


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, each whole and as often as it is taken; columns as they were.

    Documents without a word are no part of any target and stay once.
    """
    taken = mix(sized_rows(df, key, text, source), whole=True, **options)
    copies = F.when(F.col("size") > 0, F.try_divide("taken", "size")).otherwise(1).cast("int")
    return repeat_rows(df, taken.select(F.col("key").alias(key), "_mark", copies.alias("copies")), key)
