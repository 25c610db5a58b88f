import zlib

import pytest

from duolex.llm import toxicity


@pytest.fixture(scope="module")
def planted(spark):
    """Clean and toxic texts; invented insults `zork...` are known from labels alone."""
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{(i * 31 + j * 17) % 501}" for j in range(30 + i % 90)]
        toxic = i % 5 == 0
        if toxic:
            words[3:3] = ["you", f"zork{'abcdefg'[i % 7]}", "IDIOT!!"] if i % 2 else [f"zork{'abcdefg'[i % 7]}"] * 2
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_rows(planted):
    docs, labels = planted
    rows = toxicity.fit_and_score(docs, labels).collect()
    assert len(rows) == 1500
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) / len(held) > 0.97
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in rows)


def test_held_out_labels_are_not_read(planted, spark):
    docs, labels = planted
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) toxic")
    a, b = (sorted(map(tuple, toxicity.fit_and_score(docs, x).select("doc_id", "score").collect())) for x in (labels, flipped))
    assert a == b


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    from duolex.llm.queries import all_queries

    rows = all_queries()["op8_toxicity"](spark, small).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    known = [r for r in rows if r["doc_id"] in truth]
    assert len(rows) == docs.count()
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in known) / len(known) > 0.85


def test_odd_rows(spark, odd, odd_wide, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    bad = spark.createDataFrame([(None, 1), (1, None), (2, 7), (12, 1), (12, 0), (3, 0)], "doc_id long, toxic int")
    for df in (odd, odd_wide):
        for labels in (none, bad):
            rows = toxicity.fit_and_score(df, labels).collect()
            assert len(rows) == 17 and all(0 <= r["score"] <= 1 for r in rows)
            assert next(r for r in rows if r["doc_id"] == 12)["predicted"] == 1
            assert next(r for r in rows if r["doc_id"] == 4)["predicted"] == 0
        assert toxicity.drop_toxic(df, none).columns == df.columns
    assert toxicity.fit_and_score(empty, none).count() == 0


def test_features_by_hand():
    second = frozenset(w.encode() for w in toxicity.SECOND_PERSON)
    weights = toxicity.Weights({b"idiot": 4.0, b"zork*": 2.0})
    row = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT, zorkling! m0ron 1d10t", weights, frozenset([b"idiot"]), second)))
    assert row["top_term"] == 4.0 and row["densest_window"] == 2 and row["insult_density"] == pytest.approx(100 / 7)
    assert row["near_second_person"] == pytest.approx(100 / 7) and row["shouted_words"] == pytest.approx(100 / 7)
    assert row["obfuscated_terms"] == 1 and row["obfuscation_density"] == pytest.approx(200 / 7)
    assert toxicity.features(None, weights, frozenset(), second) == [0.0] * len(toxicity.FEATURES)
