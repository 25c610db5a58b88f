import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import Window, functions as F

from duolex.operators import batches, lexicon, nbest
from duolex.plans import training
from duolex.sources.vocabulary import load_vocabulary

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_running_sum(spark, width):
    random.seed(width)
    ids = sorted(random.sample(range(5_000_000), 400))
    values = [random.randint(0, 50) for _ in ids]
    df = spark.createDataFrame(list(zip(ids, values)), "k long, v long").repartition(5)
    got = batches.running_sum(df, F.col("v"), "k", "s", width).orderBy("k").collect()
    total = 0
    for r, i, v in zip(got, ids, values):
        total += v
        assert (r["k"], r["s"]) == (i, total)


def test_positions_over_many_groups(spark):
    step = 3 * (1 << 21)
    df = spark.range(3000).select((F.col("id") * step).alias("k"))
    got = batches.position(df, "k")
    assert got.filter(F.col("position") != F.col("k") / step).count() == 0


def test_batches(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1000).alias("n"))
    sizes = [r["count"] for r in batches.fixed_batches(df, "k").groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [30, 30, 30, 10]
    tokens = batches.token_batches(df, "n", "k").groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in tokens][:3] == [4, 4, 4]


def load():
    def predict(sources):
        return [[(["a", "<unk>", "<unk>"], [[1.0, 0.0], [0.0, 1.0], [0.9, 0.1]], -1.0), (["x"] * len(s), [], -0.5)]
                for s in sources]
    return predict


def load_random():
    return lambda sources: [[([str(random.randint(0, 10**9))], [[1.0]], float(len(sources)))] for _ in sources]


def test_translate_ranks_and_fills(spark):
    df = spark.createDataFrame([(0, "left right"), (1, "solo")], "row_id long, src string")
    out = {r["row_id"]: r["translation"] for r in nbest.translate(df, load, n_best=5).collect()}
    assert [c["sent"] for c in out[0]] == ["x x x x x x x x x x", "a right left"]
    assert [c["sent"] for c in out[1]] == ["x x x x", "a <unk> solo"]
    assert out[1][0]["src"] == "solo" and out[1][1]["attn"][2] == [0.9, 0.1] and out[1][1]["score"] == -1.0
    assert len(nbest.translate(df, load).filter("row_id = 1").first()["translation"]) == 1
    raw = nbest.translate(df, load, n_best=5, replace_unk=False).filter("row_id = 1").first()["translation"]
    assert raw[1]["sent"] == "a <unk> <unk>"


def test_translate_with_phrase_table(spark):
    df = spark.createDataFrame([(0, "left right"), (1, "solo"), (2, "")], "row_id long, src string")
    table = spark.createDataFrame([("left", "links"), ("other", "x")], "token string, replacement string")
    out = {r["row_id"]: r["translation"] for r in nbest.translate(df, load, n_best=5, phrase_table=table).collect()}
    assert [c["sent"] for c in out[0]] == ["x x x x x x x x x x", "a right links"]
    assert [c["sent"] for c in out[1]] == ["x x x x", "a <unk> solo"]
    assert [c["sent"] for c in out[2]] == ["", "a <unk> "]


def test_attention_arrays_stay_arrays(spark):
    """Weights of a predictor's arrays are never made into Python numbers one by one."""
    def load_arrays():
        class Weights(np.ndarray):
            def tolist(self):
                raise AssertionError("number by number")

        def predict(sources):
            return [[(["<unk>", "b"], np.array([[0.0, 1.0], [1.0, 0.0]]).view(Weights), 1.0)] for _ in sources]
        return predict

    df = spark.createDataFrame([(0, "left right"), (1, "solo")], "row_id long, src string")
    for options in ({}, {"phrase_table": spark.createDataFrame([("right", "rechts")], "token string, replacement string")}):
        out = {r["row_id"]: r["translation"][0] for r in nbest.translate(df, load_arrays, **options).collect()}
        assert [out[i]["sent"] for i in (0, 1)] == ["rechts b" if options else "right b", "<unk> b"]
        assert out[0]["attn"] == [[0.0, 1.0], [1.0, 0.0]]


def test_odd_candidates_as_column_functions_give_them(spark):
    """Ragged, empty and missing attention, missing weights and tokens, NaN scores and weights."""
    nan = float("nan")

    def load_odd():
        def predict(sources):
            rng, out = random.Random(len(sources)), []
            for s in sources:
                candidates = []
                for _ in range(rng.randint(0, 4)):
                    tokens = [rng.choice(["<unk>", "<unk>", "a", "", None]) for _ in range(rng.randint(0, 4))]
                    attn = None if rng.random() < 0.1 else [
                        None if rng.random() < 0.1 else [rng.choice([0.0, -0.0, 0.5, nan, None, float("-inf")]) for _ in range(rng.randint(0, 4))]
                        for _ in range(rng.randint(0, 5))]
                    candidates.append((tokens, attn, rng.choice([0.0, -0.0, 1.0, nan, -2.0])))
                out.append(candidates)
            return out
        return predict

    rows = [(i, None if i % 9 == 0 else " ".join("xyz"[j] for j in range(i % 4))) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, src string").coalesce(1)
    raw = nbest.predict_candidates(df, "src", "row_id", load_odd)
    source = F.split(F.coalesce("src", F.lit("")), " ", -1)
    sents = raw.select("row_id", F.posexplode("candidates").alias("place", "c"), source.alias("s")).select(
        "row_id", "place", F.col("c.score").alias("score"), F.array_join(nbest.replace_unknown(
            F.col("c.tokens"), F.col("c.attn"), F.col("s")), " ").alias("sent"))
    best_first = Window.partitionBy("row_id").orderBy((-F.col("score")).asc(), "place")
    wanted = {(r["row_id"], r["rank"]): (r["sent"], str(r["score"])) for r in sents.withColumn(
        "rank", F.row_number().over(best_first) - 1).filter("rank < 3").collect()}
    table = spark.createDataFrame([("none", "x")], "token string, replacement string")
    for options in ({}, {"phrase_table": table}, {"phrase_table": table, "max_entries": 0}):
        done = nbest.translate(df, load_odd, n_best=3, **options)
        assert {(r["row_id"], r["place"]): (r["t"]["sent"], str(r["t"]["score"])) for r in done.select(
            "row_id", F.posexplode("translation").alias("place", "t")).collect()} == wanted


def test_exact_batches_do_not_depend_on_layout(spark):
    df = spark.range(95).select(F.col("id").alias("row_id"), F.lit("s").alias("src"))
    runs = [
        sorted((r["row_id"], r["translation"][0]["sent"], r["translation"][0]["score"]) for r in nbest.translate(
            df.repartition(n), load_random, exact_batches=True).collect()) for n in (1, 6)]
    assert runs[0] == runs[1]
    assert [s for _, _, s in runs[0]] == [30.0] * 90 + [5.0] * 5


def test_exact_batches_load_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load_counted():
        loads.add(1)
        return load_random()

    df = spark.range(3000).select(F.col("id").alias("row_id"), F.lit("s").alias("src"))
    rows = nbest.translate(df, load_counted, exact_batches=True).collect()
    assert len(rows) == 3000 and loads.value <= 32


def test_long_sources_keep_their_candidates(spark):
    df = spark.createDataFrame([(0, "x " * 5000), (1, "y")], "row_id long, src string")
    long = lambda: lambda sources: [[(s.split(), [], 0.0)] for s in sources]
    assert [len(r["translation"]) for r in nbest.translate(df, long).collect()] == [1, 1]


def test_running_sum_over_many_levels(spark):
    ids = spark.range(3000).selectExpr("id * id as k", "id % 7 as v")
    rows = batches.running_sum(ids, F.col("v"), "k", "s", width=3).orderBy("k").collect()
    total = 0
    for r in rows:
        total += r["v"]
        assert r["s"] == total


def test_batches_fill_up_across_arrow_batches(spark):
    df = spark.range(100).coalesce(1).select(F.col("id").alias("row_id"), F.lit("s").alias("src"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        scores = [r["translation"][0]["score"] for r in nbest.translate(df, load_random).orderBy("row_id").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert scores == [30.0] * 90 + [10.0] * 10


def test_lexicon_join(spark):
    df = spark.createDataFrame([(0, "a b  a"), (1, "zz"), (2, None)], "k long, s string")
    table = spark.createDataFrame([("a", "b"), ("b", "a")], "token string, replacement string")
    out = {r["k"]: r["s"] for r in lexicon.lookup_lexicon(df, "s", "k", table).collect()}
    assert out == {0: "b a  b", 1: "zz", 2: None}


# Fits; fits once unasked entries are left out; does not fit.
SIZES = [{}, {"max_entries": 3}, {"max_entries": 0}]


@pytest.mark.parametrize("limits", SIZES)
def test_lexicon_of_any_size(spark, limits):
    rows = [(i, " ".join(random.Random(i).choice(["a", "b", "", "cc", "a"]) for _ in range(i % 7))) for i in range(60)]
    rows += [(60, None), (61, "a " * 4000 + "b")]
    df = spark.createDataFrame(rows, "k long, s string").repartition(5)
    entries = [("a", "y"), ("a", "x"), ("b", None), ("", "-"), (None, "n"), ("cc", "a b"), ("u", "v"), ("w", "v")]
    table = spark.createDataFrame(entries, "token string, replacement string")
    found = {"a": "x", "": "-", "cc": "a b"}
    out = lexicon.lookup_lexicon(df, "s", "k", table, **limits)
    assert out.columns == df.columns
    assert {r["k"]: r["s"] for r in out.collect()} == {
        k: None if s is None else " ".join(found.get(t, t) for t in s.split(" ")) for k, s in rows}
    none = lexicon.lookup_lexicon(df, "s", "k", table.limit(0), **limits)
    assert {r["k"]: r["s"] for r in none.collect()} == dict(rows)
    assert lexicon.lookup_lexicon(df.limit(0), "s", "k", table, **limits).count() == 0


@pytest.mark.parametrize("limits", SIZES)
def test_phrase_table_of_any_size(spark, limits):
    """Unknown tokens with, beyond and without an entry; the predictor runs once a source in any case."""
    calls = spark.sparkContext.accumulator(0)

    def load():
        def predict(sources):
            calls.add(len(sources))
            out = []
            for s in sources:
                t = s.split(" ")
                attn = [[1.0 if j == i else 0.0 for j in range(len(t))] for i in range(len(t))]
                out.append([(["<unk>"] * len(t), attn, 1.0), (t[:1], attn[:1], 2.0), (["<unk>"], [[]], 0.0)])
            return [c if s else [] for c, s in zip(out, sources)]
        return predict

    rows = [(i, " ".join(random.Random(i).choice("abcd") for _ in range(1 + i % 5))) for i in range(50)] + [(50, None)]
    df = spark.createDataFrame(rows, "row_id long, src string").repartition(3)
    table = spark.createDataFrame([("a", "A"), ("b", "B b"), ("c", None), *[(f"z{i}", "z") for i in range(9)]],
                                  "token string, replacement string")
    found = {"a": "A", "b": "B b"}
    got = nbest.translate(df, load, n_best=3, phrase_table=table, **limits).collect()
    assert calls.value == 51
    assert {r["row_id"]: [t["sent"] for t in r["translation"]] for r in got} == {
        i: [] if s is None else [s.split(" ")[0], " ".join(found.get(t, t) for t in s.split(" ")), "<unk>"] for i, s in rows}


def test_nbest_hot_source(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("src_id"),
                                    F.col("id").alias("c"), (F.col("id") % 100).cast("double").alias("score"))
    top = nbest.top_nbest(df, "src_id", "score", "c", 2).filter("src_id = 0").orderBy("rank").collect()
    assert [(r["c"], r["score"]) for r in top] == [(199, 99.0), (299, 99.0)]


def _greedy(sizes, budget):
    out, batch, fill, empty = [], 0, 0, True
    for n in sizes:
        if not empty and (fill > budget or fill + (n or 0) > budget):
            batch, fill = batch + 1, 0
        empty, fill = False, fill + (n or 0)
        out.append(batch)
    return out


@pytest.mark.parametrize("first", [[], [25], [0, 0, 25], [None, 10, 0]])
def test_full_batches(spark, first):
    """Against one pass row by row; rows past the budget, empty ones and missing sizes among them."""
    rng = random.Random(len(first))
    sizes = first + [rng.choice([0, 0, 1, 3, 5, 9, 25, None]) for _ in range(120)]
    df = spark.createDataFrame([(i * 37, s) for i, s in enumerate(sizes)], "id long, n int").repartition(3)
    for width, fanout in ((1000, 4), (7, 3), (1, 5)):
        rows = batches.full_batches(df, "n", "id", 10, width, fanout).orderBy("id").collect()
        assert [r["batch_id"] for r in rows] == _greedy(sizes, 10)
        assert [r["n"] for r in rows] == sizes


def test_full_batches_of_nothing(spark):
    assert batches.full_batches(spark.createDataFrame([], "id long, n int"), "n", "id").collect() == []


def test_training_files(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(1, 6))), None if i % 9 == 0 else "t " * rng.randint(1, 14)) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, src string, tgt string")
    manifest = training.build_training_set(df, str(tmp_path / "t"), vocab_size=5, shard_rows=40, budget=16).orderBy("shard").collect()
    made = training.read_training_set(spark, str(tmp_path / "t")).collect()
    words = [w for _, s, _ in rows for w in s.split()]
    known = sorted(set(words), key=lambda w: (-words.count(w), w))[:2]
    size = {i: max(len(s.split()), len((t or "").split())) for i, s, t in rows}
    for m in manifest:
        here = sorted((r["n_tokens"], r["row_id"], r["batch_id"]) for r in made if r["shard"] == m["shard"])
        ids = list(range(m["shard"] * 40, min(m["shard"] * 40 + 40, 90)))
        assert [r[1] for r in here] == sorted(ids, key=lambda i: (size[i], i))
        assert [r[2] for r in here] == _greedy([size[i] for _, i, _ in here], 16)
        assert (m["examples"], m["tokens"], m["batches"]) == (len(ids), sum(size[i] for i in ids), here[-1][2] + 1)
        assert m["largest_batch"] <= 16
    text = {i: s for i, s, _ in rows}
    assert all(r["unknown_src"] == sum(w not in known for w in text[r["row_id"]].split()) for r in made)
    pieces, kind, _ = load_vocabulary(spark, str(tmp_path / "t/vocabularies/src"))
    assert kind == "word" and pieces.count() == 5


def _exchanges(node, column: str) -> int:
    """Exchanges of a plan that move a column."""
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.inputPlan()
    children = node.children()
    below = sum(_exchanges(children.apply(i), column) for i in range(children.size()))
    return below + (node.nodeName() == "Exchange" and f" {column}#" in " " + node.output().mkString(" "))


def test_texts_of_a_training_set_move_once(spark, tmp_path, monkeypatch):
    """To the task that writes their shard; rows that share an id, at the border of two shards too, stay whole."""
    plans, write = [], training.write_training_shards
    monkeypatch.setattr(training, "write_training_shards", lambda rows, *args, **kw: (
        plans.append(rows._jdf.queryExecution().executedPlan()), write(rows, *args, **kw)))
    ids = [*range(7), *[7] * 25, *range(8, 40), None]
    df = spark.createDataFrame([(i, f"s{n} x", f"t{n}" if n % 3 else None) for n, i in enumerate(ids)], "row_id long, src string, tgt string")
    training.build_training_set(df.repartition(5), str(tmp_path / "t"), vocab_size=50, shard_rows=10, budget=8)
    assert _exchanges(plans[0], "src") == 1
    made = training.read_training_set(spark, str(tmp_path / "t")).collect()
    assert sorted(r["src"] for r in made) == sorted(f"s{n} x" for n, i in enumerate(ids) if i is not None)
    shards = {n: [r["row_id"] for r in made if r["shard"] == n] for n in range(7)}
    assert [len(shards[n]) for n in range(7)] == [10] * 6 + [4]
    assert all(max(shards[n]) <= min(shards[n + 1]) for n in range(6))


def test_translation_goes_on_where_it_stopped(spark, tmp_path):
    """The predictor dies in the third of five ranges; the second job asks it for the rest alone."""
    calls, path = spark.sparkContext.accumulator(0), str(tmp_path / "done")

    def load_dying():
        def predict(sources):
            calls.add(len(sources))
            if "25" in sources:
                raise RuntimeError("no more")
            return [[([s], [[1.0]], 0.0)] for s in sources]
        return predict

    def load_counted():
        def predict(sources):
            calls.add(len(sources))
            return [[([s], [[1.0]], 0.0)] for s in sources]
        return predict

    df = spark.range(50).select(F.col("id").alias("row_id"), F.col("id").cast("string").alias("src"))
    with pytest.raises(Exception, match="no more"):
        nbest.translate_into(df, load_dying, path, range_rows=10)
    calls.value = 0
    rows = nbest.translate_into(df, load_counted, path, range_rows=10).collect()
    assert calls.value == 30
    assert sorted((r["row_id"], r["translation"][0]["sent"]) for r in rows) == [(i, str(i)) for i in range(50)]
    assert nbest.translate_into(df, load_counted, path, range_rows=10).count() == 50 and calls.value == 30
    with pytest.raises(ValueError):
        nbest.translate_into(df.limit(49), load_counted, path, range_rows=10)
