"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from duolex.session import stage, work_dir

# Rows of at most two numbers each that may be sent to every executor; 16 bytes a row at least.
BROADCAST_ROWS = 1_000_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def small_or_shuffled(staged: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table of a few numbers per row, marked for broadcast up to `max_rows` rows.

    The count comes from the file footers. Beyond the bound the join shuffles and gives the same rows.
    """
    return F.broadcast(staged) if staged.count() <= max_rows else staged


def unit_hash(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of the MD5 of the parts joined by `:`."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null"))
                              for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / float(1 << 52)


def ranked(staged: DataFrame, groups: list[str], order: list[str], out: str, partitions: int) -> DataFrame:
    """Adds `out`, the gapless place from 0 of each row within its group, in the given order.

    Groups may be of any size: rows are cut into sorted ranges (equal rows by their place in the staged
    table), each range counts its rows per group, and the ranges' counts are summed up ahead of it.
    The widest window holds one range of one group, or one count per range.
    """
    ranges = staged.withColumn("_rk_tie", F.monotonically_increasing_id()).repartitionByRange(
        partitions, *order, "_rk_tie").sortWithinPartitions(*order, "_rk_tie")
    cut = stage(ranges.withColumns({"_rk_range": F.spark_partition_id(), "_rk_place": F.monotonically_increasing_id()}), "ranges")
    counts = cut.groupBy(*groups, "_rk_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*groups).orderBy("_rk_range").rowsBetween(W.unboundedPreceding, -1)
    starts = stage(counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_rk_range").alias("_r"),
                                 F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rk_start")), "range-starts")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)],
                  F.col("_rk_range") == F.col("_r"))
    local = W.partitionBy(*groups, "_rk_range").orderBy("_rk_place")
    return cut.withColumn("_rk_local", F.row_number().over(local) - 1).join(small_or_shuffled(starts), same).withColumn(out, (F.col("_rk_start") + F.col("_rk_local")).cast("bigint")).drop(
        "_rk_range", "_rk_place", "_rk_tie", "_rk_local", "_r", "_rk_start", *[f"_g{i}" for i in range(len(groups))])


def quoted(names: list[str]) -> list[str]:
    """Column names that may hold dots, as references."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def text_mark(text: str = "text") -> Column:
    """A hash of the text as it is."""
    return F.xxhash64(F.col(text))


def row_mark(df: DataFrame) -> Column:
    """Tells rows apart that share a key: a hash of all columns, nulls told from texts. Rows of one mark are equal.

    Maps have no hash and are left out.
    """
    names = [n for n, kind in zip(quoted(df.columns), df.schema) if "map" not in kind.dataType.simpleString()]
    return F.xxhash64(*[F.isnull(n) for n in names], *names)


def repeat_rows(df: DataFrame, decisions: DataFrame, key: str = "doc_id", most: int | None = None) -> DataFrame:
    """The rows of `df`, each as often as `decisions` (key, _mark, copies; a row for each of `df`) says.

    `_mark` is `row_mark(df)` of the row. Rows stay where they are while the keys whose copies are not one
    fit a broadcast. Keys that several rows share, null among them, are settled apart: only rows equal in all
    columns share a mark, and they come back as often as their copies sum up to, `most` at the most. So no row
    takes another one's decision, and none is put in another one's place. Columns are those of `df`, in
    order, whatever their names.
    """
    a, b, c, n, r = (f"_{x}{uuid.uuid4().hex[:6]}" for x in ("key", "mark", "copies", "n", "row"))
    asked = decisions.select(F.col(key).alias(a), F.col("_mark").alias(b), F.col("copies").cast("int").alias(c))
    per_text = asked.groupBy(a, b).agg(
        (F.sum(c) if most is None else F.least(F.sum(c), F.lit(most))).alias(c), F.count(F.lit(1)).alias(n))
    per_key = per_text.groupBy(a).agg(F.sum(n).alias(n), F.sum(c).alias(c))
    columns = quoted(df.columns)
    special = stage(per_key.filter((F.col(n) > 1) | F.col(a).isNull() | (F.col(c) != 1)), "special-keys")
    shared = special.filter((F.col(n) > 1) | F.col(a).isNull())
    single = special.filter((F.col(n) == 1) & F.col(a).isNotNull())

    def times(frame: DataFrame) -> DataFrame:
        return frame.withColumn(r, F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col(c), F.lit(1)).cast("int"))))

    rest = df if shared.isEmpty() else df.join(
        small_or_shuffled(shared.select(a)), F.col(key).eqNullSafe(F.col(a)), "left_anti")
    once = rest.join(small_or_shuffled(single.select(a, c)), F.col(key) == F.col(a), "left")
    if special.filter(F.col(c) > 1).isEmpty():
        out = once.filter(F.coalesce(F.col(c), F.lit(1)) > 0).select(*columns)
    else:
        out = times(once).select(*columns)
    if shared.isEmpty():
        return out
    odd = df.join(small_or_shuffled(shared.select(a)), F.col(key).eqNullSafe(F.col(a)), "left_semi")
    whole = odd.groupBy(F.col(key).alias("k"), row_mark(df).alias("m")).agg(
        F.any_value(F.struct(*columns)).alias("row"))
    back = whole.join(per_text, F.col("k").eqNullSafe(F.col(a)) & (F.col("m") == F.col(b)))
    return out.unionByName(times(back).select("row.*"))
