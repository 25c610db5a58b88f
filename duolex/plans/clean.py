"""Cleaning of a bilingual corpus, from raw rows to a full audit.

Nothing is filtered on the way: each row carries the step that dropped it and
why. Kept rows, routed files and step counts are views of that one audit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from duolex.functions.text import clean_pair
from duolex.operators.dedupe import repeated_keys, tag_later_copies, text_key
from duolex.operators.langid import predict_languages
from duolex.operators.routing import aligned_sentences, equal_pair, language_verdict, length_ratio
from duolex.session import STAGED_CODEC, delete_staged, small_side, stage
from duolex.sources.corpus import CORPUS_COLUMNS, read_corpus
from duolex.sources.sinks import write_final_tsv, write_routed, write_tsv

# Columns of the step table after `Filename` and `Original`, in step order.
STEPS = ["Step_1", "Step_2", "Step_3(1)", "Step_4", "Step_3(2)", "Step_5"]

TO_DELETE = ["equal", "duplicate", "ratio_delete", "sentence_count", "language"]
AUDIT_COLUMNS = ["path", "Filename", "row_id", "sent_no", "File", "Tr1", "Tr2", "Lang1", "Lang2",
                 "drop_stage", "reason", "inverted", "route"]


def prepare(df: DataFrame) -> DataFrame:
    """Per-row facts the later passes need without the texts: equal sides, key, first ratio.

    A file is told by `path`; a frame without one has files of distinct names.
    """
    c1, c2 = clean_pair("Tr1", "Tr2")
    return df.select(
        F.col("path" if "path" in df.columns else "Filename").alias("path"), "Filename", "row_id", "File", "Tr1", "Tr2", "Lang1", "Lang2",
        equal_pair("Tr1", "Tr2").alias("is_equal"),
        text_key("Tr1", "Tr2").alias("text_key"),
        length_ratio(c1, c2).alias("ratio_1"),
    )


def tag_step1(prepared: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Step 1: equal sides, then later copies of a pair within its file."""
    keys = ["path", "text_key"]
    if repeated is None:
        repeated = repeated_keys(prepared.filter("not is_equal"), keys, "row_id")
    tagged = tag_later_copies(prepared, repeated, keys, "row_id")
    reason = F.when(F.col("is_equal"), "equal").when(F.col("is_copy"), "duplicate")
    return tagged.withColumn("reason", reason).withColumn(
        "drop_stage", F.when(F.col("reason").isNotNull(), F.lit(1))
    ).drop("is_copy", "is_equal", "text_key")


def tag_step2(df: DataFrame) -> DataFrame:
    """Step 2: clean the texts of live rows."""
    live = F.col("drop_stage").isNull()
    c1, c2 = clean_pair("Tr1", "Tr2")
    return df.withColumns({
        "Tr1": F.when(live, c1).otherwise(F.col("Tr1")),
        "Tr2": F.when(live, c2).otherwise(F.col("Tr2")),
    })


def tag_step3(df: DataFrame, stage_no: int, label=None) -> DataFrame:
    """Step 3: drop live rows whose lengths differ too much. Runs at two stages."""
    label = length_ratio("Tr1", "Tr2") if label is None else label
    found = F.when(F.col("drop_stage").isNull(), F.nullif(label, F.lit("Ok")))
    reason = F.when(found.isNotNull(), F.concat(F.lit("ratio_"), F.lower(found))).otherwise(F.col("reason"))
    drop = F.when(found.isNotNull(), F.lit(stage_no)).otherwise(F.col("drop_stage"))
    return df.withColumns({"reason": reason, "drop_stage": drop})


def first_row_languages(df: DataFrame, within: str = "path", order: str = "row_id") -> DataFrame:
    """Language pair of the first row of each file; `order` is unique within a file.

    The first place is a plain minimum, kept in a hash table per task; its row is
    then fetched by a second narrow scan, which spares sorting all rows by file.
    """
    first = df.groupBy(within).agg(F.min(order).alias(order))
    return df.select(within, order, "Lang1", "Lang2").join(first, [within, order]).select(
        within, F.col("Lang1").alias("first1"), F.col("Lang2").alias("first2"))


def stamp_languages(df: DataFrame, first: DataFrame, within: str = "path") -> DataFrame:
    """Every live row gets the language pair of its file."""
    live = F.col("drop_stage").isNull() if "drop_stage" in df.columns else F.lit(True)
    return df.join(first, within, "left").withColumns({
        "Lang1": F.when(live, F.col("first1")).otherwise(F.col("Lang1")),
        "Lang2": F.when(live, F.col("first2")).otherwise(F.col("Lang2")),
    }).drop("first1", "first2")


def tag_step4(df: DataFrame) -> DataFrame:
    """Step 4: long live pairs become their aligned sentences, or drop if counts differ."""
    live = F.col("drop_stage").isNull()
    sents = F.when(live, aligned_sentences("Tr1", "Tr2"))
    others = [c for c in df.columns if c not in ("Tr1", "Tr2", "reason", "drop_stage")]
    out = df.select(
        *others, "Tr1", "Tr2", "reason", "drop_stage",
        F.posexplode_outer(sents).alias("sent_no", "sent"),
    )
    lost = F.col("drop_stage").isNull() & F.col("sent_no").isNull()
    return out.select(
        *others,
        F.coalesce("sent_no", F.lit(0)).alias("sent_no"),
        F.when(F.col("sent_no").isNotNull(), F.col("sent.s1")).otherwise(F.col("Tr1")).alias("Tr1"),
        F.when(F.col("sent_no").isNotNull(), F.col("sent.s2")).otherwise(F.col("Tr2")).alias("Tr2"),
        F.when(lost, "sentence_count").otherwise(F.col("reason")).alias("reason"),
        F.when(lost, F.lit(4)).otherwise(F.col("drop_stage")).alias("drop_stage"),
    )


def tag_step5(df: DataFrame, profiles: DataFrame, **options) -> DataFrame:
    """Step 5: keep, swap or drop live rows by the languages of their texts."""
    live = F.col("drop_stage").isNull()
    asked = df.withColumns({"_t1": F.when(live, F.col("Tr1")), "_t2": F.when(live, F.col("Tr2"))})
    found = predict_languages(asked, {"found1": "_t1", "found2": "_t2"}, profiles,
                              ["row_id", "sent_no"], **options)
    return apply_language_verdict(found).drop("_t1", "_t2")


def apply_language_verdict(df: DataFrame) -> DataFrame:
    """The verdict on `found1`, `found2` as swapped columns and tags."""
    verdict = F.when(
        F.col("drop_stage").isNull(), language_verdict("Lang1", "Lang2", "found1", "found2")
    )
    judged = df.withColumn("_verdict", verdict)
    swap, wrong = F.coalesce(F.col("_verdict") == "swap", F.lit(False)), F.col("_verdict") == "delete"

    def either(this: str, other: str):
        return F.when(swap, F.col(other)).otherwise(F.col(this))

    return judged.withColumns({
        "Tr1": either("Tr1", "Tr2"), "Tr2": either("Tr2", "Tr1"),
        "Lang1": either("Lang1", "Lang2"), "Lang2": either("Lang2", "Lang1"),
        "inverted": swap,
        "reason": F.when(wrong, "language").otherwise(F.col("reason")),
        "drop_stage": F.when(wrong, F.lit(6)).otherwise(F.col("drop_stage")),
    }).drop("_verdict")


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "route",
        F.when(F.col("drop_stage").isNull(), "final")
        .when(F.col("reason").isin(TO_DELETE), "to_delete").otherwise("to_check"),
    )


def find_repeated(prepared: DataFrame) -> DataFrame:
    """Keys of pairs that occur again in their file, staged."""
    alive = prepared.filter("not is_equal")
    return stage(repeated_keys(alive, ["path", "text_key"], "row_id"), "repeated")


def through_step2(prepared: DataFrame, repeated: DataFrame) -> DataFrame:
    """Steps 1 and 2 on a staged, prepared corpus; one row in, one row out."""
    return tag_step2(tag_step1(prepared, small_side(repeated)))


def through_step4(prepared: DataFrame, repeated: DataFrame) -> DataFrame:
    """Steps 1 to 4. The first live row of a file is never a later copy, so its
    languages come from the row facts alone."""
    ratio = tag_step3(through_step2(prepared, repeated), 3, F.col("ratio_1")).drop("ratio_1")
    first = stage(first_row_languages(prepared.filter("not is_equal and ratio_1 = 'Ok'")), "first-langs")
    return tag_step4(stamp_languages(ratio, small_side(first)))


def audit_of(prepared: DataFrame, repeated: DataFrame, profiles: DataFrame, **options) -> DataFrame:
    split = through_step4(prepared, repeated)
    return with_route(tag_step5(tag_step3(split, 5), profiles, **options)).select(*AUDIT_COLUMNS)


def clean_corpus(df: DataFrame, profiles: DataFrame, **options) -> DataFrame:
    """Audit of a corpus frame with Filename, row_id and the five corpus columns; `row_id` is unique.

    The rows are staged once with their facts. Narrow passes over the facts
    yield two small tables (repeated pairs, languages of a file); one wide pass
    then does all steps row by row, without moving the texts when those tables
    fit a broadcast.
    """
    prepared = stage(prepare(df), "corpus")
    return audit_of(prepared, find_repeated(prepared), profiles, **options)


def after_step4(audit: DataFrame) -> DataFrame:
    """Rows as they were after step 4, swaps undone."""
    def side(this: str, other: str):
        return F.when(F.col("inverted"), F.col(other)).otherwise(F.col(this)).alias(this)

    return audit.filter("drop_stage is null or drop_stage > 4").select(
        "path", "Filename", "row_id", "sent_no", "File",
        side("Tr1", "Tr2"), side("Tr2", "Tr1"), side("Lang1", "Lang2"), side("Lang2", "Lang1"))


def step_table(audit: DataFrame, with_path: bool = False) -> DataFrame:
    """Rows alive after each step, per file, from one aggregate over the audit.

    Files of one name have a line each; `with_path` tells them apart.

    Up to Step 3 rows are the input rows, from Step 4 on they are sentences.
    """
    head = F.col("sent_no") == 0
    gone = F.coalesce("drop_stage", F.lit(99))

    def alive(name: str, no: int):
        rows = gone > no if no >= 4 else head & (gone > no)
        return F.count(F.when(rows, 1)).alias(name)

    return audit.groupBy("path", "Filename").agg(
        F.count(F.when(head, 1)).alias("Original"),
        *[alive(name, no) for no, name in enumerate(STEPS, 1)],
    ).select(*(["path"] if with_path else []), "Filename", "Original", *STEPS)


def route_counts(audit: DataFrame) -> DataFrame:
    """Rows per step, reason and route; kept rows have no step."""
    return audit.groupBy("drop_stage", "reason", "route").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("inverted"), 1)).alias("n_inverted"))


def clean_folder(spark: SparkSession, source: str, target: str, profiles: DataFrame,
                 multiline: bool = True, fmt: str = "parquet", read: Callable[[], None] = lambda: None) -> DataFrame:
    """Clean every file of a folder and write all results below `target`.

    Writes `audit`, the route folders, the snapshots after steps 2 and 4, the
    kept pairs as header-less TSV and the step table, and returns the latter. `read` is called once the files of the
    folder are not needed any more.
    """
    rows = read_corpus(spark, source, multiline, staged=False)
    prepared = stage(prepare(rows), "corpus")
    delete_staged(rows)
    read()
    repeated = find_repeated(prepared)
    audit = audit_of(prepared, repeated, profiles)
    audit.write.option("compression", STAGED_CODEC).parquet(f"{target}/audit")
    audit = spark.read.schema(audit.schema).parquet(f"{target}/audit")
    write_routed(audit, f"{target}/routes", fmt)
    through_step2(prepared, repeated).filter("drop_stage is null").select(
        "path", "Filename", "row_id", *CORPUS_COLUMNS).write.option("compression", STAGED_CODEC).parquet(f"{target}/steps/step_2")
    for staged in (prepared, repeated):
        delete_staged(staged)
    after_step4(audit).write.option("compression", STAGED_CODEC).parquet(f"{target}/steps/step_4")
    write_final_tsv(audit, f"{target}/final")
    counts = step_table(audit)
    write_tsv(counts.orderBy("Filename"), f"{target}/table_segments")
    return counts
