import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from duolex.llm import exact_dedup, simhash
from duolex.llm.components import connected_components


def _brute_copies(rows):
    groups = {}
    for i, (key, text, *_) in enumerate(rows):
        sha = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups.setdefault(sha, []).append((-len(text or ""), key is None, key or 0, i))
    return groups


def test_odd_rows(odd, odd_wide, empty, odd_rows):
    groups = _brute_copies(odd_rows)
    for df in (odd, odd_wide):
        rows = exact_dedup.find_copies(df).collect()
        assert len(rows) == len(odd_rows)
        for sha, members in groups.items():
            mine = [r for r in rows if r["text_sha256"] == sha]
            first = odd_rows[min(members)[3]][0]
            assert {(r["keep_id"], r["group_size"], len(mine)) for r in mine} == {(first, len(members), len(members))}
            assert sum(r["kept"] for r in mine) == 1
        kept = exact_dedup.drop_copies(df)
        assert kept.columns == df.columns
        want = Counter((odd_rows[min(m)[3]][0], odd_rows[min(m)[3]][1]) for m in groups.values())
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want
    assert exact_dedup.find_copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_filter_misses_no_copy(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BLOCKS", 1)
    df = spark.range(60_000).selectExpr("id doc_id", "'t' || if(id % 3 = 0, 7, if(id % 5 = 0, id % 1000, id)) text")
    want = Counter(Counter(r["text"] for r in df.collect()).values())
    got = Counter(r["group_size"] for r in exact_dedup.find_copies(df).filter("kept").collect())
    assert got == want


def _brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def _brute_components(keys, fps, bits=3):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for i in range(len(keys)):
            low = min(label[j] for j in np.flatnonzero(near[i]))
            changed |= low < label[i]
            label[i] = low
    members = {}
    for i, l in enumerate(label):
        members.setdefault(l, []).append(i)
    out = {}
    for m in members.values():
        first = min((keys[i] for i in m if keys[i] is not None), default=None)
        out.update((i, first) for i in m)
    return out


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").toPandas()
    got = simhash.near_groups(spark.createDataFrame(docs)).toPandas().set_index("doc_id")
    fps = [_brute_fingerprint(t) for t in docs.text]
    want = _brute_components(docs.doc_id.tolist(), fps)
    for i, key in enumerate(docs.doc_id):
        assert got.fingerprint[key] == f"{fps[i]:016x}" and got.component_id[key] == want[i]


def test_odd_near_copies(odd, odd_wide, empty, odd_rows):
    fps = [_brute_fingerprint(t) for _, t, *_ in odd_rows]
    want = _brute_components([r[0] for r in odd_rows], fps)
    groups = _brute_components(list(range(len(odd_rows))), fps)  # told apart by row, as keys repeat
    for df in (odd, odd_wide):
        rows = simhash.near_groups(df).collect()
        assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == Counter(
            (r[0], f"{fps[i]:016x}", want[i]) for i, r in enumerate(odd_rows))
        kept = simhash.drop_near_copies(df)
        assert kept.columns == df.columns
        assert kept.count() == len(set(groups.values()))
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0


def test_rows_of_one_key_do_not_drop_each_other(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 60)) for _ in range(40)]
    rows = [(7 if i % 3 == 0 else i, t) for i, t in enumerate(texts)]
    rows += [(7, texts[1]), (2, texts[4] + " "), (2, texts[5] + "\t"), (None, texts[8]), (None, texts[6])]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(" ".join(r["text"].split()) for r in kept) == Counter(texts)
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(1, texts[1]), (2, texts[4] + " "), (2, texts[5] + "\t"), (8, texts[8]), (7, texts[6])}


@pytest.mark.parametrize("blocks", [None, 40])
def test_links_of_a_dense_ball(spark, monkeypatch, blocks):
    if blocks:  # several blocks a shard
        monkeypatch.setattr(simhash, "HOME_BLOCK", blocks)
        monkeypatch.setattr(simhash, "VISIT_BLOCK", blocks)
    monkeypatch.setattr(simhash, "PAIRS", 500)
    rng = np.random.default_rng(3)
    spread = rng.integers(0, 2 ** 63, 1500, dtype=np.uint64) * np.uint64(2)
    flips = np.uint64(1) << rng.integers(0, 64, (1200, 4), dtype=np.uint64)
    ball = spread[0] ^ np.bitwise_or.reduce(flips, axis=1)
    fps = np.unique(np.concatenate([spread, ball, spread[1:200] ^ np.uint64(7), spread[200:300] ^ np.uint64(15)]))
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = connected_components(simhash.near_links(frame, len(fps)), "a", "b").collect()
    got = {r["node"]: r["root"] for r in links}
    signed = fps.view(np.int64).tolist()
    want = _brute_components(list(range(len(fps))), fps.tolist())
    mine = {}
    for i, x in enumerate(signed):
        mine.setdefault(got.get(x, x), []).append(i)
    theirs = {}
    for i, first in want.items():
        theirs.setdefault(first, []).append(i)
    assert sorted(map(tuple, mine.values())) == sorted(map(tuple, theirs.values()))


def test_components_of_paths_stars_and_nulls(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000), (None, 3), (7000, None)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001 + i: 1000 for i in range(300)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
