"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duolex.functions import metrics, text
from duolex.operators import (
    batches, decontaminate, dedupe, langid, lexicon, nbest, quality, routing, segments, sentences, subwords,
)
from duolex.plans import clean, training
from duolex.session import stage, work_dir
from duolex.sources import corpus, derived, routed, sinks, vocabulary

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def _r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    docs = derived.spread(derived.table(spark, d, "documents").select("text", "lang"))
    return stage(langid.train_profiles(docs), "profiles")


def _audit(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_corpus(derived.pairs(spark, d), _profiles(spark, d))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return derived.pairs(spark, d).select("row_id", F.col("Tr1").alias("src"), F.col("Tr2").alias("tgt"))


# -- files --------------------------------------------------------------------

@query
def src_corpus_tsv(spark, d):
    path = _fresh(spark, "corpus-tsv")
    sinks.write_tsv(derived.pairs(spark, d).select(*corpus.CORPUS_COLUMNS), path, header=False)
    return corpus.read_corpus(spark, path).select(*corpus.CORPUS_COLUMNS)


@query
def src_scored_tsv(spark, d):
    path = _fresh(spark, "scored-tsv")
    table = derived.translations(spark, d).select(
        "row_id", (F.length("translation") * 0.25).alias("evaluator2 scores"), "translation", "source",
        (F.length("source") * 0.5).alias("evaluator1 scores"))
    sinks.write_tsv(table, path)
    return corpus.read_scored(spark, path)


@query
def src_test_lines(spark, d):
    path = _fresh(spark, "test-lines")
    lines = derived.table(spark, d, "benchmark").select("text").unionByName(
        derived.table(spark, d, "documents").select("text"))
    lines.select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return corpus.read_test_lines(spark, path)


@query
def sink_routed_layout(spark, d):
    path = _fresh(spark, "routes")
    sinks.write_routed(_audit(spark, d), path)
    return spark.read.parquet(path).groupBy(*sinks.ROUTE_KEYS, "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def sink_routed_clustered(spark, d):
    """Kept rows and rows to check, read back by the manifest with their texts."""
    path = _fresh(spark, "clustered")
    routed.write_clustered(_audit(spark, d), path, rows_per_file=10_000)
    return routed.read_clustered(spark, path, routes=["final", "to_check"]).select(
        *sinks.ROUTE_KEYS, "row_id", "sent_no", "Tr1", "Tr2", "reason")


@query
def sink_training_shards(spark, d):
    path = _fresh(spark, "shards")
    rows = batches.training_rows(_segments(spark, d), "src", "tgt", "row_id", shard_rows=1000)
    sinks.write_training_shards(rows, path)
    return spark.read.parquet(path).groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").cast("bigint").alias("tokens"))


# -- filters and routing ------------------------------------------------------

@query
def filter_equal_pair(spark, d):
    return derived.pairs(spark, d).filter(~routing.equal_pair("Tr1", "Tr2")).select("row_id", "Tr1", "Tr2")


@query
def filter_equal_sentences_val(spark, d):
    return _segments(spark, d).filter(routing.equal_sentences_ok("src", "tgt"))


@query
def classify_length_ratio(spark, d):
    return derived.pairs(spark, d).select("row_id", routing.length_ratio("Tr1", "Tr2").alias("label"))


@query
def filter_long_text(spark, d):
    return derived.pairs(spark, d).filter(routing.long_text("Tr1", "Tr2")).select("row_id")


@query
def filter_sentence_count_match(spark, d):
    long = derived.pairs(spark, d).filter(routing.long_text("Tr1", "Tr2"))
    return long.select(
        "row_id", F.posexplode(routing.aligned_sentences("Tr1", "Tr2")).alias("sent_no", "s")
    ).select("row_id", "sent_no", "s.s1", "s.s2")


@query
def filter_supported_langs(spark, d):
    return derived.pairs(spark, d).filter(routing.supported("Lang1") & routing.supported("Lang2")).select(
        "row_id", "Lang1", "Lang2")


@query
def route_language_check(spark, d):
    found = langid.predict_languages(
        derived.pairs(spark, d), {"found1": "Tr1", "found2": "Tr2"}, _profiles(spark, d), ["row_id"])
    return found.select(
        "row_id", routing.language_verdict("Lang1", "Lang2", "found1", "found2").alias("verdict"))


# -- duplicates and counts ----------------------------------------------------

@query
def distinct_pairs_keep_first(spark, d):
    return dedupe.keep_first(derived.pairs(spark, d), ["Tr1", "Tr2"], "row_id", ["Filename"]).select(
        "row_id", "Filename", "Tr1", "Tr2")


@query
def agg_duplicate_count(spark, d):
    keyed = derived.pairs(spark, d).select("Filename", "row_id", dedupe.text_key("Tr1", "Tr2").alias("text_key"))
    repeated = dedupe.repeated_keys(keyed, ["Filename", "text_key"], "row_id")
    return repeated.groupBy("Filename").agg(F.sum(F.col("copies") - 1).alias("duplicates"))


@query
def agg_first_row_lang(spark, d):
    return clean.first_row_languages(derived.pairs(spark, d), "File")


@query
def proj_stamp_lang(spark, d):
    pairs = derived.pairs(spark, d)
    return clean.stamp_languages(pairs, clean.first_row_languages(pairs, "File"), "File").select(
        "row_id", "File", "Lang1", "Lang2")


@query
def agg_step_table(spark, d):
    return clean.step_table(_audit(spark, d))


@query
def agg_route_counts(spark, d):
    return clean.route_counts(_audit(spark, d))


# -- cleaning and normalising -------------------------------------------------

@query
def job_step1_equal_dedupe(spark, d):
    return clean.tag_step1(clean.prepare(derived.pairs(spark, d))).select("row_id", "drop_stage", "reason")


@query
def job_step2_clean(spark, d):
    c1, c2 = text.clean_pair("Tr1", "Tr2")
    return derived.pairs(spark, d).select("row_id", c1.alias("Tr1"), c2.alias("Tr2"))


@query
def job_step3_ratio(spark, d):
    tagged = derived.pairs(spark, d).withColumns({
        "reason": F.lit(None).cast("string"), "drop_stage": F.lit(None).cast("int")})
    return clean.tag_step3(tagged, 3).select("row_id", "drop_stage", "reason")


def _informal(c: str) -> Column:
    """Plants informal spellings for the formaliser to find."""
    return F.replace(F.replace(F.col(c), F.lit(" the "), F.lit(" thru ")), F.lit(" of"), F.lit(" nite"))


def _capitals(c: str) -> Column:
    """Plants runs of capitals for the abbreviation rule to find."""
    return F.translate(F.col(c), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


@query
def norm_english_formalizer(spark, d):
    return derived.pairs(spark, d).select("row_id", text.english_formalize(_informal("Tr1")).alias("src"))


@query
def norm_spanish_plural_abbrev(spark, d):
    return derived.pairs(spark, d).select(
        "row_id", text.spanish_plural_abbreviations(_capitals("Tr1")).alias("src"))


def _process_segments(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = _segments(spark, d).select("row_id", _informal("src").alias("src"), _capitals("tgt").alias("tgt"))
    steps = ["equals_sentences_val",
             ("contains_test_val", {"lines": derived.held_out_lines(spark, d)}),
             "english_formalizer_norm", "spanish_plural_abbreviations"]
    return segments.process(rows, steps, "en", "es", mode)


@query
def job_segment_process(spark, d):
    return _process_segments(spark, d, "train")


@query
def job_segment_decode_src(spark, d):
    return _process_segments(spark, d, "decode_src")


@query
def job_segment_decode_tgt(spark, d):
    return _process_segments(spark, d, "decode_tgt")


@query
def job_segment_own_steps(spark, d):
    """A caller's normaliser and validator: no digits in the source, a target that is there."""
    segments.register_normalizer("no_digits", lambda df, *_: df.withColumn("src", F.regexp_replace("src", "[0-9]", "")))
    segments.register_validator("has_target", lambda df, *_: df.filter("tgt is not null"))
    return segments.process(_segments(spark, d), ["no_digits", "has_target"], "en", "de")


@query
def lookup_lexicon(spark, d):
    words = derived.table(spark, d, "benchmark").select(
        F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ", -1)).alias("token")).distinct()
    table = words.filter("token <> ''").select("token", F.concat(F.lit("<"), F.col("token"), F.lit(">")).alias("replacement"))
    rows = stage(_segments(spark, d).select("row_id", "src"), "segments")
    return lexicon.lookup_lexicon(rows, "src", "row_id", table)


# -- decontamination ----------------------------------------------------------

@query
def anti_test_lines(spark, d):
    return decontaminate.drop_test_lines(_segments(spark, d), derived.held_out_lines(spark, d)).select("row_id", "src")


@query
def semi_test_lines(spark, d):
    return decontaminate.leaked_rows(_segments(spark, d), derived.held_out_lines(spark, d)).select("row_id", "src")


@query
def job_decontaminate(spark, d):
    return decontaminate.decontaminate(_segments(spark, d), derived.held_out_lines(spark, d)).select(
        "row_id", F.col("leaked").cast("int").alias("leaked"))


# -- sentences and languages --------------------------------------------------

@query
def split_sentences(spark, d):
    return derived.spread(derived.table(spark, d, "documents")).select(
        "doc_id", F.posexplode(text.split_sentences("text")).alias("sent_no", "sentence"))


@query
def learn_abbreviations(spark, d):
    docs = derived.spread(derived.table(spark, d, "documents"))
    return sentences.learn_abbreviations(docs).select("lang", "token", "n", "dotted", _r6("score").alias("score"))


@query
def split_sentences_lang(spark, d):
    """Sentences by the abbreviations of each document's language, learned from all documents."""
    docs = derived.spread(derived.table(spark, d, "documents").select("doc_id", "text", "lang"))
    found = sentences.split_by_language(docs, sentences.learn_abbreviations(docs))
    return found.select("doc_id", F.posexplode("sentences").alias("sent_no", "sentence"))


@query
def job_step4_sentence_split(spark, d):
    tagged = derived.pairs(spark, d).withColumns({
        "reason": F.lit(None).cast("string"), "drop_stage": F.lit(None).cast("int")})
    stamped = clean.stamp_languages(tagged, clean.first_row_languages(tagged, "Filename"), "Filename")
    return clean.tag_step4(stamped).select(
        "row_id", "sent_no", "Tr1", "Tr2", "Lang1", "Lang2", "drop_stage", "reason")


@query
def job_train_langid(spark, d):
    return langid.train_profiles(derived.spread(derived.table(spark, d, "documents").select("text", "lang")))


@query
def job_score_langid(spark, d):
    return langid.predict_languages(
        derived.pairs(spark, d), {"found1": "Tr1", "found2": "Tr2"}, _profiles(spark, d), ["row_id"]
    ).select("row_id", "found1", "found2")


@query
def job_step5_language(spark, d):
    tagged = derived.pairs(spark, d).withColumns({
        "reason": F.lit(None).cast("string"), "drop_stage": F.lit(None).cast("int"), "sent_no": F.lit(0)})
    return clean.tag_step5(tagged, _profiles(spark, d)).select(
        "row_id", "Tr1", "Tr2", "Lang1", "Lang2", "drop_stage", "reason",
        F.col("inverted").cast("int").alias("inverted"))


@query
def job_clean_corpus(spark, d):
    return _audit(spark, d).drop("path").withColumn("inverted", F.col("inverted").cast("int"))


def _corpus_folder(spark: SparkSession, d: str) -> str:
    """The pairs as TSV files in two folders, whose files have the same names."""
    folder = _fresh(spark, "corpora")
    # The pairs are made once and written where they lie.
    rows = derived.pairs(spark, d).withColumn("part", F.pmod(F.xxhash64("Filename"), F.lit(2)))
    sinks.write_tsv_by(rows.select("part", *corpus.CORPUS_COLUMNS), folder, "part")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in store.globStatus(path(f"{folder}/part=*")):
        _rename_files(spark, part.getPath().toString())
    return folder


def _delete(spark: SparkSession, folder: str) -> None:
    """Deletes files that were made to be read once."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _rename_files(spark: SparkSession, folder: str) -> None:
    """Gives a folder's part files the names corpus-0.csv, corpus-1.csv, ..."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in store.listStatus(path(folder)) if f.getPath().getName().startswith("part-"))
    for n, name in enumerate(names):
        store.rename(path(f"{folder}/{name}"), path(f"{folder}/corpus-{n}.csv"))


def _file_per_pair(spark: SparkSession, d: str) -> str:
    """The pairs as a corpus folder: a TSV file for each `Filename`, rows in order."""
    folder, files = _fresh(spark, "by-pair"), _fresh(spark, "corpus-folder")
    rows = derived.pairs(spark, d).repartition("Filename").sortWithinPartitions("Filename", "row_id")
    sinks.write_tsv_by(rows.select("Filename", *corpus.CORPUS_COLUMNS), folder, "Filename")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(files))
    for part in store.globStatus(path(f"{folder}/Filename=*/part-*")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        store.rename(part.getPath(), path(f"{files}/{name}.tsv"))
    return files


def _clean_pairs(spark: SparkSession, d: str, target: str) -> DataFrame:
    """The folder job over the pairs; their files are deleted once they are read."""
    profiles, files = _profiles(spark, d), _file_per_pair(spark, d)
    return clean.clean_folder(spark, files, target, profiles, read=lambda: _delete(spark, files))


@query
def job_clean_folder(spark, d):
    """The folder job from files to files: the header-less pairs that it keeps."""
    target = _fresh(spark, "cleaned")
    _clean_pairs(spark, d, target)
    return corpus.read_corpus(spark, f"{target}/final", staged=False).select(*corpus.CORPUS_COLUMNS)


@query
def sink_step_table(spark, d):
    """The step table that the folder job writes, with the bare names of the files it read."""
    target = _fresh(spark, "cleaned")
    counts = _clean_pairs(spark, d, target)
    return spark.read.schema(counts.schema).option("sep", "\t").option("header", True).csv(f"{target}/table_segments")


@query
def src_corpus_tsv_blocks(spark, d):
    """Files of all pairs in order, one for 50,000 documents, whose texts have line ends in them, read in many blocks;
    rows keep their order."""
    path = _fresh(spark, "ordered-files")
    files = max(1, -(-derived.table(spark, d, "documents").count() // 50_000))
    rows = derived.pairs(spark, d).withColumns({
        "Tr1": F.replace("Tr1", F.lit(" "), F.lit("\n")), "Tr2": F.concat(F.lit('"'), F.col("Tr2"))})
    sinks.write_tsv(rows.repartitionByRange(files, "row_id").sortWithinPartitions("row_id").select(
        F.col("row_id").cast("string").alias("File"), *corpus.CORPUS_COLUMNS[1:]), path, header=False)
    blocks = {"spark.sql.files.maxPartitionBytes": str(64 << 10), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in blocks}
    try:
        for k, v in blocks.items():
            spark.conf.set(k, v)
        read = corpus.read_corpus(spark, path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    placed = batches.position(read, "row_id", "place")
    return placed.select("place", *corpus.CORPUS_COLUMNS)


@query
def job_read_folders(spark, d):
    """Pairs per text over files of the same name in two folders; ids must tell all rows apart."""
    rows = corpus.read_corpus(spark, f"{_corpus_folder(spark, d)}/*")
    # Where no id stands twice, texts need not move a second time to count those that differ.
    repeated = rows.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ids = F.count("row_id") if repeated.isEmpty() else F.countDistinct("row_id")
    return rows.groupBy("Tr1", "Tr2", "Lang1", "Lang2").agg(F.count(F.lit(1)).alias("n"), ids.alias("ids"))


@query
def job_translate_folders(spark, d):
    """Translation of files of the same name in two folders; each result must belong to its own source."""
    folder = _corpus_folder(spark, d)
    rows = corpus.read_corpus(spark, f"{folder}/*").select("row_id", F.col("Tr1").alias("src"))
    _delete(spark, folder)
    done = stage(nbest.translate(rows, load_copier, phrase_table=_phrases(spark, d)).select(
        "row_id", F.col("src").alias("asked"), F.col("translation")[0]["sent"].alias("sent")), "translated")
    # Sources and results meet as digests first. Where each row has one result, of its own source, texts need not meet.
    digests = [side.select("row_id", dedupe.text_key(c).alias("key"), F.lit(n).alias("n"), F.lit(1 - n).alias("m"))
               for n, (side, c) in enumerate(((rows, "src"), (done, "asked")))]
    odd = digests[0].unionByName(digests[1]).groupBy("row_id", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).filter("n <> 1 OR m <> 1")
    own = done.withColumn("src", F.col("asked")) if odd.isEmpty() else rows.join(done, "row_id")
    return own.groupBy("src", "asked").agg(
        F.count(F.lit(1)).alias("n"), F.min("sent").alias("least"), F.max("sent").alias("most"))


# -- quality ------------------------------------------------------------------

@query
def metric_wer(spark, d):
    return derived.translations(spark, d).select("row_id", _r6(metrics.wer("source", "translation")).alias("wer"))


@query
def metric_cer(spark, d):
    return derived.translations(spark, d).select("row_id", _r6(metrics.cer("source", "translation")).alias("cer"))


@query
def metric_f_measure(spark, d):
    return derived.translations(spark, d).select(
        "row_id", _r6(metrics.f_measure("source", "translation")).alias("f_score"))


@query
def job_quality_features(spark, d):
    return quality.quality_features(derived.translations(spark, d)).select(
        "row_id", *[_r6(c).alias(c) for c in quality.FEATURES])


@query
def feat_poly2(spark, d):
    feats = quality.quality_features(derived.translations(spark, d))
    terms = feats.select("row_id", *quality.poly2())
    return terms.select("row_id", *[F.round(c, 4).alias(c) for c in quality.TERMS])


@query
def stat_gram_matrix(spark, d):
    rows = quality.gram_matrix(quality.with_judgement(derived.scored(spark, d)))
    return rows.select("i", "j", F.round("value", 5).alias("value"))


@query
def model_quality_fit(spark, d):
    rows = stage(quality.with_judgement(derived.scored(spark, d)).select(*quality.FEATURES, "score"), "scored")
    return quality.fit_quality(rows).as_frame(spark).select("term", F.round("weight", 5).alias("weight"))


@query
def model_quality_predict(spark, d):
    rows = stage(
        quality.with_judgement(derived.scored(spark, d)).select("row_id", *quality.FEATURES, "score"), "scored")
    return quality.fit_from_moments(rows).predict(rows).select("row_id", F.round("prediction", 3).alias("prediction"))


@query
def model_quality_evaluate(spark, d):
    """Fits on two of three documents and is judged on the third."""
    rows = stage(
        quality.with_judgement(derived.scored(spark, d)).select("row_id", *quality.FEATURES, "score"), "scored")
    train = F.shiftright("row_id", 20) % 3 != 0
    return quality.evaluate_quality(rows.filter(train), rows.filter(~train)).select(_r6("pearson").alias("pearson"))


@query
def stat_pearson(spark, d):
    return quality.pearson(derived.scored(spark, d), "evaluator1 scores", "wer").select(_r6("pearson").alias("pearson"))


# -- subwords and training data -----------------------------------------------

def _documents(spark: SparkSession, d: str) -> DataFrame:
    return derived.spread(derived.table(spark, d, "documents").select("doc_id", "text"))


def _rounded(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.select("piece", _r6("score").alias("score"), "id")


@query
def job_learn_subwords_char(spark, d):
    return _rounded(subwords.learn_subwords(_documents(spark, d), "text", "char"))


@query
def job_learn_subwords_word(spark, d):
    return _rounded(subwords.learn_subwords(_documents(spark, d), "text", "word"))


SYMBOLS = ["###"]
_LEARNED: dict[tuple[str, str, str], DataFrame] = {}


def _learned(spark: SparkSession, d: str, model_type: str) -> DataFrame:
    """The vocabulary of the documents at the default settings, learned once in a session and staged."""
    key = (spark.sparkContext.applicationId, d, model_type)
    if key not in _LEARNED:
        symbols = SYMBOLS if model_type == "unigram" else []
        _LEARNED[key] = stage(subwords.learn_subwords(_documents(spark, d), "text", model_type, symbols=symbols), "vocabulary")
    return _LEARNED[key]


@query
def job_learn_subwords_bpe(spark, d):
    return _learned(spark, d, "bpe")


@query
def job_learn_subwords(spark, d):
    return _learned(spark, d, "unigram")


@query
def job_apply_subwords(spark, d):
    pieces = subwords.apply_subwords("text", _learned(spark, d, "unigram"), symbols=SYMBOLS)
    return _documents(spark, d).select("doc_id", pieces.alias("pieces"))


def _round_trip(spark: SparkSession, d: str, model_type: str) -> DataFrame:
    """Texts cut into pieces and put together again, and whether every piece is in the vocabulary."""
    vocabulary = _learned(spark, d, model_type)
    symbols = SYMBOLS if model_type == "unigram" else []
    cut = stage(_documents(spark, d).select("doc_id", subwords.apply_subwords(
        "text", vocabulary, model_type, symbols).alias("pieces")), "pieces")
    used = cut.select("doc_id", F.explode(F.split("pieces", " ")).alias("piece")).filter("piece <> ''")
    strange = used.join(vocabulary.select(F.col("piece").alias("known")), F.col("piece") == F.col("known"), "left_anti")
    unknown = strange.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("n"))
    return cut.join(unknown, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", subwords.undo_subwords("pieces").alias("text"), F.coalesce("n", F.lit(0)).alias("unknown"))


@query
def job_apply_subwords_round_trip(spark, d):
    return _round_trip(spark, d, "unigram")


@query
def job_apply_subwords_bpe(spark, d):
    return _round_trip(spark, d, "bpe")


@query
def job_apply_subwords_char(spark, d):
    return _documents(spark, d).select("doc_id", subwords.apply_subwords("text", None, "char").alias("pieces"))


@query
def job_undo_subwords(spark, d):
    pieces = _documents(spark, d).select("doc_id", subwords.apply_subwords("text", None, "word").alias("pieces"))
    return pieces.select("doc_id", subwords.undo_subwords("pieces").alias("text"))


@query
def topk_vocab(spark, d):
    return batches.top_vocabulary(batches.token_counts(_documents(spark, d), "text"), 8000)


@query
def topk_vocab_sides(spark, d):
    return batches.side_vocabularies(stage(_segments(spark, d), "segments"), "src", "tgt", 8000)


@query
def win_token_batches(spark, d):
    rows = _segments(spark, d).select("row_id", F.size(text.whitespace_tokens("src")).alias("n_tokens"))
    return batches.token_batches(stage(rows, "lengths"), "n_tokens", "row_id")


@query
def win_token_batches_full(spark, d):
    """Batches that never pass the budget unless one row alone does."""
    rows = _segments(spark, d).select("row_id", F.size(text.whitespace_tokens("src")).alias("n_tokens"))
    return batches.full_batches(stage(rows, "lengths"), "n_tokens", "row_id")


@query
def job_build_training_files(spark, d):
    """The whole training set, written and read again: sums of each batch beside what the manifest says."""
    path = _fresh(spark, "training-set")
    manifest = training.build_training_set(_segments(spark, d), path, shard_rows=1000)
    sums = training.read_training_set(spark, path).groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").cast("bigint").alias("tokens"),
        F.sum("unknown_src").alias("unknown_src"), F.sum("unknown_tgt").alias("unknown_tgt"))
    return sums.join(manifest.select("shard", "examples", "batches", "largest_batch"), "shard")


@query
def src_vocab(spark, d):
    """A vocabulary that was learned, saved twice and loaded again."""
    path = _fresh(spark, "vocabularies")
    learned = stage(subwords.learn_subwords(_documents(spark, d), "text", "char"), "vocabulary")
    version = vocabulary.save_vocabulary(learned, path, "char")
    vocabulary.save_vocabulary(learned.repartition(3), path, "char")
    pieces, model_type, _ = vocabulary.load_vocabulary(spark, path, version)
    saved = len(vocabulary.versions(spark, path))
    return _rounded(pieces).withColumns({"model_type": F.lit(model_type), "versions": F.lit(saved)})


@query
def job_build_training_set(spark, d):
    rows = stage(_segments(spark, d), "segments")
    return batches.training_rows(rows, "src", "tgt", "row_id", shard_rows=1000).select(
        "row_id", "shard", "n_tokens", "batch_id")


# -- batch inference ----------------------------------------------------------

@query
def win_fixed_batches(spark, d):
    return batches.fixed_batches(stage(_segments(spark, d).select("row_id"), "ids"), "row_id")


@query
def topk_nbest(spark, d):
    turns = derived.table(spark, d, "conversations").select(
        "conv_id", "turn", (-F.length("text")).alias("score"))
    return nbest.top_nbest(turns, "conv_id", "score", "turn", 5)


@query
def topk_nbest_arrays(spark, d):
    turns = derived.table(spark, d, "conversations").select(
        "conv_id", "turn", (-F.length("text")).alias("score"))
    arrays = nbest.collect_nbest(nbest.top_nbest(turns, "conv_id", "score", "turn", 5), "conv_id", ["turn", "score"])
    return arrays.select("conv_id", F.posexplode("translation").alias("place", "t")).select(
        "conv_id", "place", "t.turn", "t.score")


_REACH = 8


def _attend(tokens: Column) -> Column:
    """Attention of output place i on source place i modulo a fixed reach."""
    return F.transform(tokens, lambda _, i: F.transform(
        F.sequence(F.lit(0), F.lit(_REACH - 1)), lambda j: F.when(j == i % _REACH, 1.0).otherwise(0.0)))


def _phrases(spark: SparkSession, d: str) -> DataFrame:
    words = derived.table(spark, d, "benchmark").select(
        F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ", -1)).alias("token")).distinct()
    return words.select("token", F.concat(F.lit("<"), F.col("token"), F.lit(">")).alias("replacement"))


@query
def lookup_phrase_table(spark, d):
    source = F.split(F.coalesce("src", F.lit("")), " ", -1)
    tokens = F.transform(F.col("source_tokens"), lambda t, i: F.when(i % 3 == 0, nbest.UNKNOWN).otherwise(t))
    rows = stage(_segments(spark, d).select("row_id", source.alias("source_tokens")), "segments").withColumn("tokens", tokens)
    rows = rows.withColumn("attn", _attend(F.col("tokens")))
    done = nbest.lookup_phrase_table(rows, ["row_id"], "tokens", "attn", "source_tokens", _phrases(spark, d))
    return done.select("row_id", F.array_join("tokens", " ").alias("sent"))


def load_copier():
    """A stand-in translator: copies short tokens, does not know long ones, and
    offers the reversed sentence second."""
    weights = np.eye(_REACH)

    def predict(sources: list[str]):
        out = []
        for source in sources:
            known = [t if len(t) < 5 else "<unk>" for t in source.split(" ")]
            attn = weights[np.arange(len(known)) % _REACH]
            out.append([(known[::-1], attn[::-1], -float(len(known)) - 1.0), (known, attn, -float(len(known)))])
        return out

    return predict


def load_counter():
    """A stand-in whose score is the place of a source in its batch, so batches must be exact."""
    return lambda sources: [[([], [], float(i))] for i in range(len(sources))]


def load_nothing():
    """A stand-in that must not be asked."""
    raise RuntimeError("all ranges are done")


@query
def job_exact_batches(spark, d):
    done = nbest.translate(_segments(spark, d), load_counter, exact_batches=True)
    return done.select("row_id", F.col("translation")[0]["score"].alias("place"))


@query
def job_batch_translate(spark, d):
    done = nbest.translate(_segments(spark, d), load_copier, n_best=2, phrase_table=_phrases(spark, d))
    return done.select("row_id", F.posexplode("translation").alias("rank", "t")).select(
        "row_id", "rank", "t.sent", "t.score")


@query
def job_translate_resumed(spark, d):
    """Translation kept range by range; the second call finds all ranges done and asks no predictor."""
    path, rows = _fresh(spark, "translations"), stage(_segments(spark, d).select("row_id", "src"), "segments")
    size = max(1, -(-rows.count() // 4))
    nbest.translate_into(rows, load_copier, path, range_rows=size, n_best=2, phrase_table=_phrases(spark, d))
    done = nbest.translate_into(rows, load_nothing, path, range_rows=size, n_best=2)
    return done.select("row_id", F.posexplode("translation").alias("rank", "t")).select(
        "row_id", "rank", "t.sent", "t.score")
