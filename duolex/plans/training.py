"""A training set from segments: vocabularies, shards of batched examples, and a manifest of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duolex.functions.text import whitespace_tokens
from duolex.operators.batches import SHARD_ROWS, TOKEN_BUDGET, shard_of, training_facts
from duolex.operators.subwords import META_PIECES, VOCAB_SIZE, learn_subwords
from duolex.session import delete_staged, settings, stage
from duolex.sources.sinks import write_training_shards
from duolex.sources.vocabulary import load_vocabulary, save_vocabulary

SIDES = ("src", "tgt")


def _unknown(rows: DataFrame, side: str, vocabulary: DataFrame, order: str) -> DataFrame:
    """Tokens of each row's side that the word vocabulary lacks; rows with none are left out."""
    known = vocabulary.filter(~F.col("piece").isin(META_PIECES)).select(F.expr("substring(piece, 2)").alias("_known"))
    tokens = rows.select(F.col(order).alias("_row"), F.explode(whitespace_tokens(side)).alias("_token"))
    # A vocabulary is bounded by its size.
    strange = tokens.join(F.broadcast(known), F.col("_token") == F.col("_known"), "left_anti")
    return strange.groupBy("_row").agg(F.count(F.lit(1)).alias(f"unknown_{side}"))


def build_training_set(df: DataFrame, target: str, order: str = "row_id", vocab_size: int = VOCAB_SIZE,
                       shard_rows: int = SHARD_ROWS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Writes all that training reads below `target` and returns the manifest.

    `vocabularies/src` and `vocabularies/tgt` hold the word vocabularies, `shards` the examples (`order`, src,
    tgt, shard, n_tokens, batch_id, unknown tokens of either side), `manifest` a row per shard: examples,
    batches, tokens, its largest batch and the versions of the vocabularies. No batch is larger than
    `budget` unless one example alone is. The manifest is written last, so a job that has one is complete.

    Places, batches and counts are found without the texts, which move once, to the task that writes their shard.
    """
    spark = df.sparkSession
    segments = stage(df.select(order, *SIDES).withColumn("_no", F.monotonically_increasing_id()), "segments")
    facts = stage(training_facts(segments, *SIDES, order, "_no", shard_rows, budget), "batches")
    found = facts.select("_no", "shard", "n_tokens", "batch_id", F.col(order).alias("_order"))
    made = {}
    for side in SIDES:
        path = f"{target}/vocabularies/{side}"
        made[side] = save_vocabulary(learn_subwords(segments.filter(F.col(side).isNotNull()), side, "word", vocab_size), path, "word")
        vocabulary, _, _ = load_vocabulary(spark, path, made[side])
        counts = _unknown(segments, side, vocabulary, order)
        found = found.join(counts, F.col("_order") == F.col("_row"), "left").drop("_row").withColumn(
            f"unknown_{side}", F.coalesce(f"unknown_{side}", F.lit(0)))
    # Both sides are dealt by shard, as the files are, so neither the join nor the writer moves them.
    texts = segments.withColumn("_shard", shard_of(facts, order, "_no")).withColumnRenamed("_no", "_text").repartition("_shard")
    rows = found.drop("_order").repartition("shard").join(
        texts.hint("merge"), (F.col("shard") == F.col("_shard")) & (F.col("_no") == F.col("_text"))).select(
        order, *SIDES, "n_tokens", "shard", "batch_id", *[f"unknown_{side}" for side in SIDES])
    with settings(spark, {"spark.sql.adaptive.skewJoin.enabled": "false"}):  # which would cut shards over tasks
        write_training_shards(rows, f"{target}/shards", order=order, dealt=True)
    for staged in (segments, facts):
        delete_staged(staged)
    batches = spark.read.parquet(f"{target}/shards").groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").cast("bigint").alias("tokens"))
    batches.groupBy("shard").agg(
        F.sum("n").alias("examples"), F.count(F.lit(1)).alias("batches"), F.sum("tokens").alias("tokens"),
        F.max("tokens").alias("largest_batch")).withColumns(
        {f"vocabulary_{side}": F.lit(made[side]) for side in SIDES}).write.parquet(f"{target}/manifest")
    return spark.read.parquet(f"{target}/manifest")


def read_training_set(spark: SparkSession, target: str) -> DataFrame:
    """The examples of a complete training set; one without manifest is an error."""
    manifest = spark.read.parquet(f"{target}/manifest").select(F.col("shard").alias("_shard"))
    rows = spark.read.parquet(f"{target}/shards")
    # A row per shard; shards hold about a million examples each.
    return rows.join(F.broadcast(manifest), F.col("shard") == F.col("_shard"), "left_semi")
