import zlib
from collections import Counter, defaultdict

import pytest

from duolex.llm import mixing, sharding


def test_growing_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    three = {r[0]: r[1] for r in sharding.assign_shards(ids, "doc_id", [1, 1, 2]).collect()}
    four = {r[0]: r[1] for r in sharding.assign_shards(ids, "doc_id", [1, 1, 2, 1]).collect()}
    assert all(four[i] in (three[i], 3) for i in three)
    share = Counter(three.values())
    assert abs(share[2] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    assert abs(Counter(four.values())[3] / 20_000 - 0.2) < 0.02


def test_weights(spark):
    ids = spark.range(200)
    assert {r["shard"] for r in sharding.assign_shards(ids, "id", [0, 1, 0]).collect()} == {1}
    for wrong in ([], [0.0], [-1, 2], [float("nan"), 1]):
        with pytest.raises(ValueError):
            sharding.rendezvous("id", wrong)


def test_index_of_odd_rows(odd, odd_wide, empty, odd_rows):
    for df in (odd, odd_wide):
        rows = sharding.shard_index(df, "doc_id", "text", [1] * 3, [1] * 4).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
            (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert r["grown_shard"] in (r["shard"], 3)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_index(empty, "doc_id", "text", [1], [1, 1]).count() == 0
    assert "Z" not in {r["shard"] for r in sharding.assign_shards(odd_wide, "doc_id", [1, 1]).collect()}


def _mixed(df, **options):
    return mixing.mix(mixing.sized_rows(df), **options).collect()


def test_taken_words_meet_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = _mixed(docs)
    assert rows and sorted(rows) == sorted(_mixed(docs.repartition(5)))
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    total = sum(r["size"] for r in rows)
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total
    whole = _mixed(docs, whole=True)
    assert all(not r["size"] or r["taken"] % r["size"] == 0 for r in whole)


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 90)], "source string, source_size long")
    got = {r[0]: r[2] for r in mixing.source_targets(sizes, (5, 2, 1), 1.5, 2.0).collect()}
    # 450 words by 5, 2, 1, 5; a and null stop at twice their sizes, which leaves 250 for b and c by 2 and 1.
    assert got["a"] == 20 and got[None] == 180 and abs(got["b"] - 250 * 2 / 3) < 1e-9 and abs(got["c"] - 250 / 3) < 1e-9


def test_heavier_rows_come_first(spark):
    rows = spark.range(4000).selectExpr("id key", "'s' source", "10L size", "if(id % 2 = 0, 4.0D, 0.5D) weight")
    taken = mixing.mix(rows, weights=[1.0], share=0.5).collect()
    by = Counter(r["key"] % 2 for r in taken if r["taken"])
    assert by[0] > 2 * by[1] and sum(r["taken"] for r in taken) == 20_000


def test_mix_of_odd_rows(odd, odd_wide, empty):
    for df in (odd, odd_wide):
        rows = _mixed(df)
        assert len(rows) == 17 and all(r["taken"] == 0 for r in rows if r["size"] == 0)
        mixed = mixing.mix_documents(df)
        assert mixed.columns == df.columns
        texts = {r["text"] for r in df.collect()}
        assert {r["text"] for r in mixed.collect()} <= texts
    assert _mixed(empty) == [] and mixing.mix_documents(empty).count() == 0


def test_one_source_of_most_rows(spark):
    rows = spark.range(30_000).selectExpr("id key", "if(id % 3 = 0, 'x' || id % 7, 'hot') source", "id % 50 size", "1.0D weight")
    got = mixing.mix(rows).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
