import csv
import random

import pytest
from pyspark.sql import functions as F

from duolex.functions.text import english_formalize
from duolex.operators import decontaminate, segments
from duolex.plans import catalog
from duolex.sources import commits, corpus, derived, sinks, vocabulary

NB = chr(0xA0)


def run(spark, steps, src_lang, tgt_lang, mode="train", src="thru EE UU", tgt="thru EE UU"):
    df = spark.createDataFrame([(src, tgt)], "src string, tgt string")
    return tuple(segments.process(df, steps, src_lang, tgt_lang, mode).first())


def test_formaliser_sides(spark):
    name = ["english_formalizer_norm"]
    assert run(spark, name, "en", "en") == ("through EE UU", "thru EE UU")
    assert run(spark, name, "fr", "en") == ("thru EE UU", "through EE UU")
    assert run(spark, name, "en", "en", "decode_tgt") == ("thru EE UU", "through EE UU")
    assert run(spark, name, "en", "fr", "decode_src") == ("through EE UU", "thru EE UU")
    assert run(spark, name, "en", "fr", "decode_tgt") == ("thru EE UU", "thru EE UU")
    with pytest.raises(ValueError):
        run(spark, name, "fr", "es")


def test_abbreviation_sides(spark):
    name = ["spanish_plural_abbreviations"]
    assert run(spark, name, "es", "es") == (f"thru EE.{NB}UU.", f"thru EE.{NB}UU.")
    assert run(spark, name, "es", "en", tgt=None) == (f"thru EE.{NB}UU.", None)
    assert run(spark, name, "en", "es", "decode_src") == ("thru EE UU", "thru EE UU")


def test_validators_only_in_training(spark):
    df = spark.createDataFrame([("a b c d e", "a b c d e")], "src string, tgt string")
    for mode, n in [("train", 0), ("decode_src", 1), ("decode_tgt", 1)]:
        assert segments.process(df, ["equals_sentences_val"], "en", "es", mode).count() == n


def test_own_steps_and_order(spark):
    segments.register_normalizer("shout", segments.column_normalizer(F.upper, "en", both_sides=True))
    segments.register_validator("no_thru", lambda df, s, t: df.filter(~F.col("src").contains("thru")))
    assert run(spark, ["english_formalizer_norm", "shout"], "en", "fr")[0] == "THROUGH EE UU"
    assert run(spark, ["shout", "english_formalizer_norm"], "en", "fr")[0] == "THRU EE UU"
    df = spark.createDataFrame([("thru", "x")], "src string, tgt string")
    assert segments.process(df, ["no_thru"], "en", "fr").count() == 0
    with pytest.raises(KeyError):
        segments.process(df, ["unheard_of"], "en", "fr")


def test_decontamination(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("one line\n\n  blank sides \n   \none line\n", encoding="utf-8")
    lines = corpus.read_test_lines(spark, str(tmp_path / "lines.txt"))
    assert sorted(r["line"] for r in lines.collect()) == ["", "blank sides", "one line"]
    df = spark.createDataFrame(
        [(0, "one line\n"), (1, " blank sides "), (2, "blank sides"), (3, ""), (4, "new"), (5, None)], "i int, src string")

    def left(**options):
        return sorted(r["i"] for r in decontaminate.drop_test_lines(df, lines, **options).collect())

    assert left() == [1, 4, 5]
    assert left(normalise=True) == [4, 5]
    tagged = decontaminate.decontaminate(df, lines)
    assert sorted(r["i"] for r in tagged.filter("leaked").collect()) == [0, 2, 3]
    assert sorted(r["i"] for r in decontaminate.leaked_rows(df, lines).collect()) == [0, 2, 3]


def test_corpus_file_quoting(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(
        'f\t"two\nlines"\t"say ""hi"""\ten\tfr\nf\t  outer blanks \tback\\slash\ten\t\nf\tNA\tnull\ten\tfr\n', encoding="utf-8")
    rows = corpus.read_corpus(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [tuple(r)[3:] for r in rows] == [
        ("f", "two\nlines", 'say "hi"', "en", "fr"), ("f", "  outer blanks ", "back\\slash", "en", None),
        ("f", "NA", "null", "en", "fr")]
    assert {r["Filename"] for r in rows} == {"a.tsv"}


def test_round_trip_of_hard_fields(spark, tmp_path):
    hard = ['tab\there', 'quote "q"', "new\nline", " blank ", "back\\slash", '"', "\\", '\\"', "plain"]
    df = spark.createDataFrame([("f", h, h[::-1], "en", "fr") for h in hard], corpus.CORPUS_SCHEMA)
    sinks.write_tsv(df, str(tmp_path / "t"), header=False)
    back = corpus.read_corpus(spark, str(tmp_path / "t")).select(*corpus.CORPUS_COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_row_order_over_blocks(spark, tmp_path):
    lines = "".join(f"f\t{i}\tx{'y' * 90}\ten\tfr\n" for i in range(20_000))
    (tmp_path / "big.tsv").write_text(lines, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(200_000))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = corpus.read_corpus(spark, str(tmp_path), multiline=False)
        assert df.rdd.getNumPartitions() > 4
        got = [int(r["Tr1"]) for r in df.select("Tr1", "row_id").orderBy("row_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(range(20_000))


def test_scored_file(spark, tmp_path):
    (tmp_path / "s.tsv").write_text(
        "evaluator2 scores\textra\tsource\ttranslation\tevaluator1 scores\n2.5\te\ts\tt\t1\n", encoding="utf-8")
    assert tuple(corpus.read_scored(spark, str(tmp_path)).first()) == ("s", "t", 1.0, 2.5)


def test_rows_on_a_stream(spark, tmp_path):
    schema = "src string, tgt string"
    spark.createDataFrame([("thru", "a"), ("a b c d e", "A b c d e")], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    lines = spark.createDataFrame([("held out",)], "line string")
    done = segments.process(
        stream, ["equals_sentences_val", ("contains_test_val", {"lines": lines}), "english_formalizer_norm"], "en", "fr")
    q = done.writeStream.format("memory").queryName("rows_out").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.table("rows_out").collect()] == [("through", "a")]
    assert english_formalize("x") is not None


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder in "ab":
        (tmp_path / folder).mkdir()
        for name in ("x.tsv", "y.tsv"):
            (tmp_path / folder / name).write_text("".join(f"f\t{folder}{name}{i}\tt{i}\ten\tfr\n" for i in range(3)))
    rows = corpus.read_corpus(spark, f"{tmp_path}/*").orderBy("row_id").collect()
    assert [r["Tr1"] for r in rows] == [f"{d}{n}{i}" for d in "ab" for n in ("x.tsv", "y.tsv") for i in range(3)]
    assert len({r["row_id"] for r in rows}) == 12 and len({r["path"] for r in rows}) == 4


def test_ids_over_many_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for f in "ab":
            (tmp_path / f"{f}.tsv").write_text("".join(f"f\t{i}\tx\ten\tfr\n" for i in range(2000)))
        rows = corpus.read_corpus(spark, str(tmp_path), multiline=False).orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r["Tr1"]) for r in rows] == [*range(2000), *range(2000)]
    assert [r["row_id"] for r in rows] == [*range(2000), *((1 << corpus.FILE_BITS) + i for i in range(2000))]


def _messy(rng):
    t = " ".join(rng.choice(["a", "bb", "ccc", "\u00e9"]) for _ in range(rng.randint(1, 6)))
    return rng.choice([t, t, t.replace(" ", "\n"), f'say "{t}"\n"end" ok', "tab\there", "x" + "\n\n" * 400 + "z", '"', "", "\n"])


def test_quoted_records_over_blocks(spark, tmp_path):
    """Blocks that begin inside a field, or lie in one as a whole; both line ends; quotes within plain fields."""
    rng, want = random.Random(3), []
    for f, (end, quoting) in enumerate([("\n", csv.QUOTE_MINIMAL), ("\n", csv.QUOTE_ALL), ("\r\n", csv.QUOTE_MINIMAL)]):
        rows = [(f"f{f}", _messy(rng), _messy(rng), "en", "de") for _ in range(150)]
        with open(tmp_path / f"{f}.tsv", "w", newline="", encoding="utf-8") as h:
            csv.writer(h, delimiter="\t", lineterminator=end, quoting=quoting).writerows(rows)
        want += [tuple(x or None for x in r) for r in rows]
    (tmp_path / "9.tsv").write_text('f9\t5" disk\tit "was" so\ten\tde\n\nf9\t"q\nr"\t\ten\tde', encoding="utf-8")
    (tmp_path / "empty.tsv").write_text("")
    want += [("f9", '5" disk', 'it "was" so', "en", "de"), ("f9", "q\nr", None, "en", "de")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        rows = corpus.read_corpus(spark, str(tmp_path)).orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r[c] for c in corpus.CORPUS_COLUMNS) for r in rows] == want
    assert len({r["row_id"] for r in rows}) == len(want)


def test_commits_are_made_once(spark, tmp_path):
    assert commits.committed(spark, str(tmp_path)) == {}
    assert commits.commit(spark, str(tmp_path), "1", "first") and not commits.commit(spark, str(tmp_path), "1", "second")
    assert commits.committed(spark, str(tmp_path)) == {"1": "first"}


def test_vocabulary_versions(spark, tmp_path):
    path, schema = str(tmp_path), "piece string, score double, id int"
    one = spark.createDataFrame([("a", -1.0, 0), ("b", -2.5, 1)], schema)
    two = spark.createDataFrame([("a", -1.0, 0), ("b", -2.5, 2)], schema)
    first = vocabulary.save_vocabulary(one, path, "bpe", ["#"])
    assert vocabulary.save_vocabulary(one.orderBy("score"), path, "bpe", ["#"]) == first
    others = [vocabulary.save_vocabulary(one, path, "unigram", ["#"]), vocabulary.save_vocabulary(two, path, "bpe", ["#"])]
    assert len({first, *others}) == 3
    assert [v["version"] for v in vocabulary.versions(spark, path)] == [first, *others]
    pieces, kind, symbols = vocabulary.load_vocabulary(spark, path, first)
    assert sorted(map(tuple, pieces.collect())) == [("a", -1.0, 0), ("b", -2.5, 1)] and (kind, symbols) == ("bpe", ["#"])
    assert sorted(vocabulary.load_vocabulary(spark, path)[0].collect())[1]["id"] == 2
    with pytest.raises(FileNotFoundError):
        vocabulary.load_vocabulary(spark, path, "none")


def test_small_blocks_share_tasks(spark, tmp_path):
    """Many small blocks are read by fewer tasks, and rows and their order stay."""
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.tsv").write_text("".join(f'f{i}\t"x\n{i}"\ty\ten\tde\n' for i in range(400)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        blocks = spark.read.text(str(path))
        assert blocks.rdd.getNumPartitions() > 50
        assert corpus._in_tasks(blocks).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        rows = corpus.read_corpus(spark, str(path)).orderBy("row_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r["File"], r["Tr1"]) for r in rows] == [(f"f{i}", f"x\n{i}") for i in range(400)]


def test_folders_are_read_with_one_move_of_texts(spark, tmp_path, monkeypatch):
    docs = [(i, "\n".join(f"line {i % 3} {j}" for j in range(4)), "en" if i % 2 else "de", f"s{i % 5}") for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = []
    pairs = derived.pairs
    monkeypatch.setattr(derived, "pairs", lambda *a: made.append(1) or pairs(*a))
    found = catalog.all_queries()["job_read_folders"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(made) == 1 and plan.count("Exchange hashpartitioning") == 1
    wanted = pairs(spark, str(tmp_path)).groupBy("Tr1", "Tr2", "Lang1", "Lang2").count()
    assert sorted((r["n"], r["ids"]) for r in found.collect()) == sorted((r["count"],) * 2 for r in wanted.collect())


def test_rows_that_the_caller_stages_are_not_staged_before(spark, tmp_path, monkeypatch):
    rows = [(f"f{i}", f"a\n{i}" if i % 3 else f"b {i}", f"c {i}", "en", "de") for i in range(50)]
    sinks.write_tsv(spark.createDataFrame(rows, corpus.CORPUS_COLUMNS), f"{tmp_path}/c", header=False)
    names, stage = [], corpus.stage
    monkeypatch.setattr(corpus, "stage", lambda df, name: names.append(name) or stage(df, name))
    plain = corpus.read_corpus(spark, f"{tmp_path}/c", staged=False)
    assert "corpus-rows" not in names
    assert sorted(plain.collect()) == sorted(corpus.read_corpus(spark, f"{tmp_path}/c").collect()) and plain.count() == 50


def test_lines_of_quoted_fields_are_staged_by_the_chunk(spark, tmp_path, monkeypatch):
    """A field of many lines is some rows while it is read, and what was staged on the way is deleted."""
    rows = [("f", "\n".join(f"w{i} {j}" for j in range(2000)), f'"{i}', "en", "de") for i in range(30)]
    sinks.write_tsv(spark.createDataFrame(rows, corpus.CORPUS_COLUMNS).coalesce(1), f"{tmp_path}/c", header=False)
    staged, stage = {}, corpus.stage
    monkeypatch.setattr(corpus, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    monkeypatch.setattr(corpus, "CHUNK_BYTES", 50_000)
    gone, delete = [], corpus.delete_staged
    monkeypatch.setattr(corpus, "delete_staged", lambda df: gone.append(staged["corpus-lines"].count()) or delete(df))
    read = corpus.read_corpus(spark, f"{tmp_path}/c")
    assert sorted(tuple(r[c] for c in corpus.CORPUS_COLUMNS) for r in read.collect()) == sorted(rows)
    assert [r["row_id"] for r in read.orderBy("row_id").collect()] == [2000 * i for i in range(30)]
    assert len(gone) == 1 and gone[0] <= 30
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged["corpus-lines"].inputFiles()[0])
    assert not left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(left)


def _texts(spark, path, ids):
    docs = [(i, "\n".join(f"line {n} {j}" for j in range(3)) if n % 7 else None, "en" if n % 2 else None, f"s{n % 5}") for n, i in enumerate(ids)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    df.write.parquet(f"{path}/documents.parquet")
    return df


def test_neighbours_are_found_with_one_move_of_texts(spark, tmp_path):
    """Ids that come twice, gaps, ids below zero, and the borders of runs."""
    docs = _texts(spark, tmp_path, [*range(-3, 4), 3, 254, 255, 255, 256, 256, 257, 511, 512, 600, 602, None, None])
    following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("text2"), F.col("lang").alias("l2"))
    want = docs.join(following, "doc_id", "left").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "t1"), F.split("text2", "\n").alias("o"), F.coalesce("l2", "lang").alias("l2"))
    want = want.select("doc_id", "pos", "t1", F.get("o", F.col("pos")).alias("t2"), "l2")
    found = derived.line_pairs(spark, str(tmp_path))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.select(want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_translations_meet_their_sources_as_digests(spark, tmp_path, monkeypatch):
    """Texts meet only where a translator mixes results up, which shows."""
    _texts(spark, tmp_path, range(40))
    spark.createDataFrame([(0, "line here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    query = catalog.all_queries()["job_translate_folders"]
    plain = query(spark, str(tmp_path))
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(map(tuple, plain.collect()), key=str)
    assert rows and all(r[0] == r[1] for r in rows)
    translate = catalog.nbest.translate

    def mixed(df, *args, **options):
        asked = translate(df, *args, **options)
        return asked.withColumn("row_id", F.when(F.col("row_id") == 0, 1).when(F.col("row_id") == 1, 0).otherwise(F.col("row_id")))

    monkeypatch.setattr(catalog.nbest, "translate", mixed)
    other = query(spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in other) == sum(r[2] for r in rows)
    assert any(r["src"] != r["asked"] for r in other)
