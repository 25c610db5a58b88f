import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duolex.operators import dedupe, langid
from duolex.plans import clean
from duolex.session import stage
from duolex.sources import derived


@pytest.fixture(scope="module")
def profiles(spark, small):
    return stage(langid.train_profiles(derived.table(spark, small, "documents")), "profiles")


@pytest.fixture(scope="module")
def audit(spark, small, profiles):
    return stage(clean.clean_corpus(derived.pairs(spark, small), profiles), "audit")


def test_one_status_per_row(audit, spark, small):
    assert audit.select("row_id").distinct().count() == derived.pairs(spark, small).count()
    assert audit.groupBy("row_id", "sent_no").count().filter("count > 1").count() == 0
    assert audit.filter("(drop_stage is null) <> (route = 'final')").count() == 0
    assert audit.filter("(drop_stage is null) <> (reason is null)").count() == 0


def test_large_profiles_agree(spark, small, profiles):
    rows = derived.pairs(spark, small)
    columns = {"found1": "Tr1", "found2": "Tr2"}
    fast = langid.predict_languages(rows, columns, profiles, ["row_id"]).select("row_id", *columns)
    slow = langid.predict_languages(rows, columns, profiles, ["row_id"], max_broadcast_rows=5).select("row_id", *columns)
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_language_of_edge_texts(spark, profiles):
    rows = spark.createDataFrame([(0, ""), (1, None), (2, "ab"), (3, "the nation and the"), (4, "\U0001F600" * 5)], "k int, s string")
    for limit in (langid.MAX_BROADCAST_ROWS, 5):
        got = {r["k"]: r["p"] for r in langid.predict_languages(rows, {"p": "s"}, profiles, ["k"], limit).collect()}
        assert got[1] is None and got[0] == got[2] == "de" and got[3] == "en" and got[4] is not None


def test_languages_are_found(spark, small, profiles):
    docs = derived.table(spark, small, "documents").select("doc_id", "text", "lang")
    got = langid.predict_languages(docs, {"p": "text"}, profiles, ["doc_id"])
    assert got.filter("p = lang").count() / got.count() > 0.95


def test_keep_first(spark):
    rows = [(0, "f", "a", "b"), (1, "f", "a", "b"), (2, "g", "a", "b"), (3, "f", None, "b"), (4, "f", None, "b"),
            (5, "f", "", "b"), (6, "f", "A", "b"), (7, "f", "ab", ""), (8, "f", "a", None), (9, "f", "nan", "b")]
    df = spark.createDataFrame(rows, "row_id long, Filename string, Tr1 string, Tr2 string")

    def kept(within):
        return sorted(r["row_id"] for r in dedupe.keep_first(df, ["Tr1", "Tr2"], "row_id", within).collect())

    assert kept(["Filename"]) == [0, 2, 3, 5, 6, 7, 8, 9]
    assert kept(None) == [0, 3, 5, 6, 7, 8, 9]


def test_heavy_key(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    kept = dedupe.keep_first(df, ["t"], "row_id")
    assert kept.count() == 20_001
    assert kept.filter("t = 'same'").first()["row_id"] == 0


def _write(path, rows):
    path.write_text("".join("\t".join(r) + "\n" for r in rows), encoding="utf-8")


def test_folder_end_to_end(spark, tmp_path, profiles):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    en, fr = "the nation and the other thing for that", "le ciel avec une pierre dans leur maison"
    _write(source / "one.tsv", [
        ("f", "Same text", "same TEXT", "en", "fr"), ("f", en, fr, "en", "fr"), ("f", en, fr, "en", "fr"),
        ("f", fr, en, "en", "fr"), ("f", en, "x", "en", "fr"), ("f", "SERIES TITLE: " + en + " one", fr + " un", "en", "fr"),
        ("f", en + " two", " ".join([fr] * 3), "en", "fr"),
        ("f", " ".join(["the nation and."] * 14), " ".join(["avec une pierre."] * 14), "en", "fr"),
        ("f", " ".join(["the nation and."] * 14), " ".join(["avec une pierre"] * 14), "en", "fr"),
        ("f", '"' + en + '\nquoted ""x"""', fr + " et", "en", "fr"),
    ])
    _write(source / "two.tsv", [("g", en, fr, "en", "fr"), ("g", "", "", "en", "fr")])
    table = {r["Filename"]: r for r in clean.clean_folder(spark, str(source), str(target), profiles).collect()}
    one, two = table["one.tsv"], table["two.tsv"]
    assert [one[c] for c in ["Original", *clean.STEPS]] == [10, 8, 8, 6, 18, 18, 18]
    assert [two[c] for c in ["Original", *clean.STEPS]] == [2, 1, 1, 1, 1, 1, 1]
    routes = spark.read.parquet(f"{target}/routes")
    reasons = {(r["route"], r["reason"]): r["count"] for r in routes.groupBy("route", "reason").count().collect()}
    assert reasons == {
        ("final", None): 19, ("to_check", "inverted"): 1, ("to_check", "ratio_check"): 1, ("to_delete", "equal"): 2,
        ("to_delete", "duplicate"): 1, ("to_delete", "ratio_delete"): 1, ("to_delete", "sentence_count"): 1}
    back = routes.filter("reason = 'inverted'").first()
    assert (back["Tr1"], back["Tr2"], back["Lang1"], back["Lang2"]) == (fr, en, "en", "fr")
    final = spark.read.csv(f"{target}/final", sep="\t", quote='"', escape='"', multiLine=True)
    assert final.count() == 19
    assert final.filter(F.col("_c1") == en + 'quoted "x"').count() == 1
    swapped = routes.filter(f"route = 'final' and Tr1 = '{en}' and Lang1 = 'fr'")
    assert swapped.count() == 1
    assert spark.read.parquet(f"{target}/steps/step_2").count() == 9
    step4 = spark.read.parquet(f"{target}/steps/step_4")
    assert step4.count() == 19 and step4.filter("Lang1 = 'en'").count() == 19


def test_shuffled_tables_agree(audit, spark, small, profiles, monkeypatch):
    """The same audit when no side table is small enough for a broadcast."""
    monkeypatch.setattr(clean, "small_side", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        other = stage(clean.clean_corpus(derived.pairs(spark, small), profiles, max_broadcast_rows=5), "audit")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert other.exceptAll(audit).count() == 0 and audit.exceptAll(other).count() == 0


def test_empty_corpus(spark, profiles):
    schema = "Filename string, row_id long, File string, Tr1 string, Tr2 string, Lang1 string, Lang2 string"
    audit = clean.clean_corpus(spark.createDataFrame([], schema), profiles)
    assert audit.count() == 0 and clean.step_table(audit).count() == 0


def test_folders_with_files_of_one_name(spark, tmp_path):
    import random

    rng = random.Random(2)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(6)) for _ in range(8)]
    for folder, pair in (("a", "en\tfr"), ("b", "de\tes")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "x.tsv").write_text("".join(f"f\t{x}\t{x[::-1]}\t{pair}\n" for x in lines))
    df = clean.read_corpus(spark, f"{tmp_path}/in/*")
    profiles = langid.train_profiles(spark.createDataFrame([("abc abc", "en"), ("xyz", "fr")], "text string, lang string"), "text", "lang")
    audit = clean.clean_corpus(df, profiles)
    assert audit.count() == audit.select("row_id").distinct().count() == 16
    assert audit.filter("reason = 'duplicate'").count() == 0
    counts = clean.step_table(audit, with_path=True).collect()
    assert len(counts) == 2 and all(r["Original"] == 8 and r["Filename"] == "x.tsv" for r in counts)
    stamped = {(r["path"].split("/")[-2], r["Lang1"]) for r in audit.filter("not inverted").collect()}
    assert stamped <= {("a", "en"), ("b", "de")}


def test_language_scores_take_little_memory():
    """A task's arrays follow a run of texts of bounded length, not the batch."""
    grams = sorted({a + b + c for a in "abcd" for b in "abcd" for c in "abcd"})
    codes = langid._gram_codes(grams)
    gains = np.array([[1] * 32 + [0] * 32, [0] * 32 + [1] * 32])
    held = SimpleNamespace(value=(["x", "y"], codes, gains, np.array([0, 0])))
    texts = pd.Series([("ab" if i % 2 else "cd") * 150 for i in range(10_000)])
    predict = langid._predictor(held).func
    tracemalloc.start()
    try:
        found = predict(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.tolist() == ["x" if i % 2 else "y" for i in range(10_000)]
    assert most < 16 << 20


def test_folder_job_keeps_no_copy_that_it_has_read(spark, small):
    """The files of the folder and the staged rows are gone once the results stand."""
    from duolex import session
    from duolex.plans import catalog

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(session.work_dir(spark)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def there():
        names = ("corpus-folder", "corpus-lines", "corpus-rows", "corpus-", "repeated")
        return {f.getPath().getName() for f in store.globStatus(path(f"{session.work_dir(spark)}/*"))
                if f.getPath().getName().startswith(names) and any(not x.isDirectory() for x in store.listStatus(f.getPath()))}

    before = there()
    assert catalog.all_queries()["sink_step_table"](spark, small).count() > 0
    assert there() == before
