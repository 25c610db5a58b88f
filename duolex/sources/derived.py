"""Bilingual tables derived from a document collection.

Line `pos` of a document is paired with line `pos` of the next document, and
known cases (equal sides, prefixes, swapped sides, newlines, exact copies) are
planted by a fixed rule, so that every cleaning step has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from duolex.functions import metrics, text
from duolex.sources.corpus import test_line_set

# A document holds fewer lines than this; ids stay ordered by document and line.
_LINES_PER_DOCUMENT = 1 << 20
# Ids of documents whose neighbours are found together.
_NEIGHBOURS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out when they come in fewer partitions than there are task slots.

    A table that splits into enough of them, by files or by blocks, is left as it is.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(2 * slots)


def line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, pos, File, t1, t2, l1, l2: every non-blank line with its neighbour's, null where there is none.

    The last document has no neighbour; its second language is its own. Each text moves once, to the run of ids
    that it lies in; the first of a run goes to the run before it, too. Rows of one id have each the same neighbours.
    """
    docs = spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    run = F.floor(F.col("doc_id") / F.lit(_NEIGHBOURS))
    to = F.when(F.col("doc_id") % _NEIGHBOURS == 0, F.array(run, run - 1)).otherwise(F.array(run))
    beside = W.partitionBy("_run").orderBy("doc_id").rangeBetween(1, 1)
    placed = docs.withColumn("_run", F.explode(to)).withColumn(
        "_next", F.collect_list(F.struct(F.col("text").alias("text2"), F.col("lang").alias("l2"))).over(beside))
    own = placed.filter(F.col("_run").eqNullSafe(run)).withColumn(
        "_next", F.explode_outer(F.when(F.col("doc_id").isNotNull(), F.col("_next"))))
    lines = own.select(
        "doc_id", F.col("source").alias("File"), F.col("lang").alias("l1"), F.coalesce("_next.l2", "lang").alias("l2"),
        F.split("_next.text2", "\n").alias("others"), F.posexplode(F.split("text", "\n")).alias("pos", "t1"))
    other = F.get("others", F.col("pos"))
    return lines.filter(F.trim("t1") != "").select(
        "doc_id", "pos", "File", "t1", F.when(F.trim(other) != "", other).alias("t2"), "l1", "l2")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus table with planted cases: row_id, Filename and the five corpus columns.

    `Filename` holds one language pair per file, as a corpus folder does.
    """
    base = line_pairs(spark, folder).withColumn("m", (F.col("doc_id") * 7 + F.col("pos")) % 20)
    m, t1, t2 = F.col("m"), F.col("t1"), F.col("t2")
    tr1 = (
        F.when(m.isin(1, 3), F.concat(F.lit(text.SERIES_PREFIX), t1))
        .when(m == 4, t2).when(m == 5, F.concat(t1, F.lit("\n"))).otherwise(t1)
    )
    tr2 = (
        F.when(m.isin(0, 4), t1)
        .when(m.isin(2, 3), F.concat(F.lit(text.SUMMARY_PREFIX), t2)).otherwise(t2)
    )
    copies = F.explode(F.when(m == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return base.withColumn("copy", copies).select(
        ((F.col("doc_id") * _LINES_PER_DOCUMENT + F.col("pos")) * 2 + F.col("copy")).alias("row_id"),
        F.concat_ws("_", "File", "l1", "l2").alias("Filename"),
        "File", tr1.alias("Tr1"), tr2.alias("Tr2"), F.col("l1").alias("Lang1"), F.col("l2").alias("Lang2"),
    )


def held_out_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out test lines: all benchmark lines and all lines of documents labelled toxic."""
    flagged = table(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    texts = (
        table(spark, folder, "documents").select("doc_id", "text").join(flagged, "doc_id", "left_semi")
        .select("text").unionByName(table(spark, folder, "benchmark").select("text"))
    )
    return test_line_set(texts.select(F.explode(F.split("text", "\n")).alias("value")))


# The planted judgement is a quadratic in the three measures.
PLANTED_INTERCEPT = 90.00137
PLANTED_COEFFICIENTS = [-0.30, -0.20, 0.25, 0.0004, 0.0003, -0.0006, 0.0002, -0.0005, 0.0007]


def translations(spark: SparkSession, folder: str) -> DataFrame:
    """row_id, source, translation over all aligned lines.

    For odd documents the translation is the line of the next document, for even
    ones the line itself without every fifth token.
    """
    thinned = F.array_join(
        F.filter(F.split("t1", " ", -1), lambda _, i: i % 5 != 4), " "
    )
    return line_pairs(spark, folder).select(
        (F.col("doc_id") * _LINES_PER_DOCUMENT + F.col("pos")).alias("row_id"),
        F.col("t1").alias("source"),
        F.when(F.col("doc_id") % 2 == 1, F.col("t2")).otherwise(thinned).alias("translation"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Translations with their measures and two judges whose mean is the planted quadratic and an error.

    The judges differ by `noise`, which their mean loses, and err alike by `error`, which it keeps.
    """
    feats = translations(spark, folder).select(
        "row_id", "source", "translation",
        metrics.wer("source", "translation").alias("wer"),
        metrics.cer("source", "translation").alias("cer"),
        metrics.f_measure("source", "translation").alias("f_score"),
    )
    w, c, f = F.col("wer"), F.col("cer"), F.col("f_score")
    terms = [w, c, f, w * w, w * c, w * f, c * c, c * f, f * f]
    planted = F.lit(PLANTED_INTERCEPT)
    for k, term in zip(PLANTED_COEFFICIENTS, terms):
        planted = planted + F.lit(k) * term
    noise = (F.col("row_id") % 7 - 3) / 4.0
    error = (F.col("row_id") * 37 % 101 - 50) / 25.0
    return feats.withColumn("planted", planted + error).select(
        "row_id", "source", "translation", "wer", "cer", "f_score",
        (F.col("planted") + noise).alias("evaluator1 scores"),
        (F.col("planted") - noise).alias("evaluator2 scores"),
    )
