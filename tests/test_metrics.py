import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from duolex.functions import metrics
from duolex.operators import quality


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        below = [i]
        for j, y in enumerate(b, 1):
            below.append(min(row[j] + 1, below[-1] + 1, row[j - 1] + (x != y)))
        row = below
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcé\U0001F600", max_size=90), st.text("abcdé\U0001F600", max_size=90))
def test_edit_distance(a, b):
    assert metrics.edit_distance(a, b) == table_distance(a, b)


def test_measures_by_hand(spark):
    random.seed(5)
    words = ["a", "B", "ccc", "é", "z_q", "w!", "\U0001F600", "x"]
    rows = [
        (i, " ".join(random.choice(words) for _ in range(random.randint(0, 60))),
         "\t".join(random.choice(words) for _ in range(random.randint(0, 60)))) for i in range(200)
    ] + [(900, None, "a"), (901, "a", None), (902, "", ""), (903, "!", "?")]
    got = spark.createDataFrame(rows, "i int, s string, t string").select(
        "i", "s", "t", metrics.wer("s", "t").alias("w"), metrics.cer("s", "t").alias("c"),
        metrics.f_measure("s", "t").alias("f")).collect()
    for r in got:
        s, t = r["s"], r["t"]
        if s is None or t is None:
            assert r["w"] is None and r["c"] is None and r["f"] is None
            continue
        a, b = s.split(), t.split()
        x, y = set(re.findall(r"\w+", s.lower())), set(re.findall(r"\w+", t.lower()))
        assert r["w"] == (pytest.approx(table_distance(a, b) / len(a) * 100) if a else None)
        assert r["c"] == (pytest.approx(table_distance(s, t) / len(s) * 100) if s else None)
        assert r["f"] == (pytest.approx(200 * len(x & y) / (len(x) + len(y))) if x and y else None)


@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 120, (400, 3))
    y = 50 - x @ [0.3, 0.1, -0.2] + 0.001 * x[:, 0] * x[:, 2] + rng.normal(0, 2, 400)
    frame = spark.createDataFrame(
        [(*map(float, r), float(v)) for r, v in zip(x, y)], "wer double, cer double, f_score double, score double")
    terms = np.column_stack([x, *(x[:, i] * x[:, j] for i in range(3) for j in range(i, 3))])
    design = np.column_stack([np.ones(len(x)), terms])
    return frame, y, design @ np.linalg.lstsq(design, y, rcond=None)[0]


@pytest.mark.parametrize("fit", [quality.fit_quality, quality.fit_from_moments])
def test_fit_against_numpy(judged, fit):
    frame, y, want = judged
    model = fit(frame)
    got = model.predict(frame).select("prediction").toPandas()["prediction"].to_numpy()
    assert np.allclose(np.sort(got), np.sort(want), atol=1e-6)


def test_pearson_against_numpy(judged):
    frame, y, want = judged
    got = quality.evaluate_quality(frame, frame).first()["pearson"]
    assert got == pytest.approx(np.corrcoef(y, want)[0, 1], abs=1e-9)


def test_constant_feature(spark):
    rows = [(float(i), 5.0, float(i % 7), 2.0 * i) for i in range(50)]
    frame = spark.createDataFrame(rows, "wer double, cer double, f_score double, score double")
    errors = quality.fit_from_moments(frame).predict(frame).select(F.max(F.abs(F.col("prediction") - F.col("score"))))
    assert errors.first()[0] < 1e-6


def test_distances_of_many_pairs_at_once():
    rnd = random.Random(3)
    pairs = []
    for symbols in ("ab", "abcdefghij ä\U0001f600", [f"w{i}" for i in range(500)]):
        for top in (3, 64, 65, 200, 900):
            for _ in range(60):
                a = [rnd.choice(symbols) for _ in range(rnd.randint(0, top))]
                b = [rnd.choice(symbols) for _ in range(rnd.randint(0, top))]
                b = rnd.choice([b, [s for s in a if rnd.random() < 0.8], [s if rnd.random() < 0.9 else "z" for s in a], a])
                pairs.append((a, b))
    first, second = zip(*pairs)
    alone = [metrics.edit_distance(a, b) for a, b in pairs]
    assert metrics.edit_distances(first, second, metrics._token_codes).tolist() == alone
    texts = [["".join(x) for x in side] for side in (first, second)]
    alone = [metrics.edit_distance(a, b) for a, b in zip(*texts)]
    assert metrics.edit_distances(*texts, metrics._char_codes).tolist() == alone
    assert metrics.edit_distances([], [], metrics._char_codes).tolist() == []


def test_moments_take_each_measure_once(spark):
    rows = [("a b c", "a b d", 1.0), ("x y", "x", 3.0), ("", "a", 2.0), (None, "a", 2.0), ("k l", "l k m", None), ("p q", "p q", float("nan"))]
    df = quality.quality_features(spark.createDataFrame(rows, "source string, translation string, score double"))
    table = quality.gram_matrix(df)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_token_distance(") == 1 and plan.count("array_intersect") == 1
    whole = quality.gram_matrix(df.filter("source in ('a b c', 'x y')").select(*quality.FEATURES, "score").localCheckpoint())
    found, wanted = ({(r["i"], r["j"]): r["value"] for r in t.collect()} for t in (table, whole))
    assert found == pytest.approx(wanted)
