"""Queries of this subpackage: each operator on whole tables, with its production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from duolex.llm import divergence, exact_dedup, licenses, minhash, mixing, packing, sharding, simhash, spelling, substrings, token_counts, topk, toxicity
from duolex.llm.common import fresh_path, read_table
from duolex.session import stage

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


SHARDS = 8
# Tokenizer versions that are counted: the file, and words as `mixing` counts them.
BPE_VERSION, WORDS_VERSION = "word_bpe_49k", "words-1"


@query
def op1_sharding(spark, d):
    docs = read_table(spark, d, "documents")
    return sharding.shard_index(docs, "doc_id", "text", [1.0] * SHARDS, [1.0] * (SHARDS + 1))


@query
def op3_exact_dedup(spark, d):
    return exact_dedup.find_copies(read_table(spark, d, "documents")).drop("_mark")


@query
def op7_mixing(spark, d):
    mixed = mixing.mix(mixing.sized_rows(read_table(spark, d, "documents")))
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "source", "epochs")


@query
def op2_packing(spark, d):
    return packing.pack(read_table(spark, d, "documents"))


@query
def op5_licenses(spark, d):
    found = licenses.scan_licenses(read_table(spark, d, "documents"))
    base = F.filter("hits", lambda h: h["label"].isin(*licenses.BASE_LABELS) & (h["kind"] == "base"))
    starts = F.transform("base", lambda h: h["start"])
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda h: h["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", F.array_join("expressions", "; ").alias("expressions"),
        "permitted")


@query
def op10_simhash(spark, d):
    return simhash.near_groups(read_table(spark, d, "documents")).drop("_mark", "_root")


@query
def op8_toxicity(spark, d):
    scored = toxicity.fit_and_score(read_table(spark, d, "documents"), read_table(spark, d, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op9_topk(spark, d):
    return topk.top_k(read_table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_substrings(spark, d):
    return substrings.shared_passages(read_table(spark, d, "documents"))


@query
def op6_token_counts(spark, d):
    """All documents come in; copies of a text go; documents with repeated lines are counted anew without those.

    Of the rows of one text one stays: that of the least doc_id (null last), source and language. Rows are told
    apart by a number of their own, as ids may repeat or be missing.
    """
    docs = read_table(spark, d, "documents").withColumns({
        "row": F.monotonically_increasing_id(),
        "whole": F.coalesce("text", F.lit("")), "lines": F.split(F.coalesce("text", F.lit("")), "\n")})
    docs = docs.withColumns({"once": F.array_join(F.array_distinct("lines"), "\n"), "digest": F.sha2("whole", 256)})
    facts = docs.select("row", "doc_id", "source", "lang", "digest", "whole", F.nullif("once", "whole").alias("revised"))
    keep = ["row", "doc_id", "source", "lang", "digest"]
    texts = facts.select(*keep, F.explode(F.array(
        F.struct(F.lit(False).alias("again"), F.col("whole").alias("text")),
        F.struct(F.lit(True).alias("again"), F.col("revised").alias("text")))).alias("t")).select(
        *keep, "t.*").filter("text is not null").withColumn("words", mixing.count_words("text"))
    counted = stage(token_counts.count_tokens(texts, [*keep, "again", "words"]), "token-counts")
    versions = F.explode(F.array(
        F.struct(F.lit(BPE_VERSION).alias("tokenizer"), F.col("tokens")),
        F.struct(F.lit(WORDS_VERSION).alias("tokenizer"), F.col("words").alias("tokens"))))
    rows = counted.select(*keep, "again", versions.alias("v")).select(*keep, "again", "v.*")
    base = rows.filter("not again")
    first = base.groupBy("digest", "tokenizer").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang", "row")).alias("first"))
    first = first.select(F.col("digest").alias("_digest"), F.col("tokenizer").alias("_tokenizer"), F.col("first.row").alias("_first"))
    first = stage(first, "first-copies")
    mine = (F.col("digest") == F.col("_digest")) & (F.col("tokenizer") == F.col("_tokenizer"))
    copies = base.join(first, mine & (F.col("row") != F.col("_first")))
    kept = rows.join(first, mine & (F.col("row") == F.col("_first")))
    old = kept.filter("not again").select("digest", "tokenizer", F.col("tokens").alias("old_tokens"))
    changed = kept.filter("again").join(old, ["digest", "tokenizer"])
    rollup = token_counts.Rollup(spark, fresh_path(spark, "rollup"))
    for batch, deltas in (("1-load", token_counts.inserts(base)), ("2-copies", token_counts.deletes(copies)),
                          ("3-lines", token_counts.revisions(changed)), ("2-copies", token_counts.deletes(copies))):
        rollup.commit(batch, deltas)
    return rollup.totals()


@query
def op12_divergence(spark, d):
    return divergence.audit(read_table(spark, d, "documents"))


@query
def op13_minhash(spark, d):
    return minhash.near_groups(read_table(spark, d, "documents"))


@query
def op11_spelling(spark, d):
    return spelling.group_variants(read_table(spark, d, "documents"))
