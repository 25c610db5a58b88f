import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from duolex.llm import licenses, queries, topk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def test_query_against_brute_force(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.all_queries()["op5_licenses"](spark, small).collect()
    assert len(rows) == len(docs) and any(r["n_base"] for r in rows)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == _brute(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_overlapping_and_glued_phrases():
    scan = lambda t: licenses.scan_text(t, licenses._automaton(), frozenset(licenses.PERMISSIVE))
    for text in ("MIT License MIT-license", "the\x00MIT\nLICENSE.", "mit licenses", "émit license", "general general public license",
                 "mit  ...  license apache license mit license", "license mit"):
        n, hits, *_ = scan(text)
        base = sorted((h[0], h[3]) for h in hits if h[2] == "base")
        assert (n, len(base), min((b[0] for b in base), default=None)) == _brute(text)[:3], text


@pytest.mark.parametrize("text, postfix, permitted", [
    ("MIT", ["MIT"], True), ("GPL-2.0-only", ["GPL-2.0-only"], False),
    ("GPL-2.0 OR MIT", ["GPL-2.0", "MIT", "or"], True), ("GPL-2.0 and MIT", ["GPL-2.0", "MIT", "and"], False),
    ("MIT OR GPL-2.0 AND GPL-3.0", ["MIT", "GPL-2.0", "GPL-3.0", "and", "or"], True),
    ("(MIT OR GPL-2.0) AND GPL-3.0", ["MIT", "GPL-2.0", "or", "GPL-3.0", "and"], False),
    ("Apache-2.0 WITH LLVM-exception OR MIT */", ["Apache-2.0", "LLVM-exception", "with", "MIT", "or"], True),
    ("MIT AND", ["MIT"], True), ("MIT) AND X", ["MIT"], True), ("MIT and then some", ["MIT", "then", "and"], False)])
def test_expressions(text, postfix, permitted):
    got = licenses.parse_expression(text)
    assert got == postfix
    assert licenses.evaluate(got, frozenset(licenses.PERMISSIVE))[1] is permitted


def test_broken_expressions():
    for text in ("", "AND MIT", "(MIT", "()", "*/", "((MIT) OR X"):
        assert licenses.parse_expression(text) is None


def test_tags_and_odd_rows(spark, odd_wide, empty, odd_rows):
    rows = spark.createDataFrame([(1, "// SPDX-License-Identifier: (GPL-2.0 OR MIT)\ncode"), (2, "SPDX license identifier")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(rows).collect()}
    assert got[1]["expressions"] == ["(GPL-2.0 OR MIT)"] and got[1]["permitted"] and got[1]["labels"] == ["spdx", "spdx:gpl-2.0", "spdx:mit"]
    assert got[2]["expressions"] == [] and got[2]["permitted"] is None and 0 < got[2]["score"] < got[1]["score"]
    rows = licenses.scan_licenses(odd_wide).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in rows) == Counter((r[0], _brute(r[1])[0]) for r in odd_rows)
    assert licenses.scan_licenses(empty).count() == 0


@pytest.mark.parametrize("n, asked, width, scale", [(3000, 120, 16, 1), (900, 40, 64, 1), (30, 9, 4, 1), (4, 4, 3, 1), (800, 20, 8, 2.0 ** 26)])
def test_search_is_exact(n, asked, width, scale):
    rng = np.random.default_rng(n)
    rows = np.floor(64 * rng.normal(0, 0.15, (n, width))) * scale
    rows[n // 2:n // 2 + n // 4] = rows[0]  # a very common vector
    ids, place = rng.permutation(n).astype(np.int64), rng.permutation(n)[:asked]
    q, r, s = topk.search_block(rows[place], place, rows, ids, 20)
    whole = [[int(x) for x in v] for v in rows]
    for i in range(asked):
        want = sorted((-sum(a * b for a, b in zip(whole[place[i]], whole[j])), ids[j]) for j in range(n) if j != place[i])[:20]
        assert [(-int(b), ids[a]) for a, b in zip(r[q == i], s[q == i])] == want


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 8)
    monkeypatch.setattr(topk, "QUERIES", 2)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5]), (20, [1.0, -1.0]), (20, [1.0, -1.0]), (40, None), (60, [nan, 1.0]), (1, [inf, 1.0]), (2, [None, 1.0]),
            (3, [0.5, 0.5]), (None, [2.0, 2.0]), (4, [1.0]), (5, []), (80, [-0.01, 0.01]), (6, [1e300, 1.0])] + [(100 + i, [0.5, 0.5]) for i in range(1, 19)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, row string")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=3).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(by) == [0, 20, 80] and len(by[20]) == 6
    assert sorted(by[0])[0] == (1, 6, 2 ** 63 - 1) and sorted(by[0])[1] == (2, None, 8192)
    assert sorted(by[0])[2] == (3, 3, 2048)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
