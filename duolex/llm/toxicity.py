"""Toxicity of whole texts: boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from duolex.llm.common import repeat_rows, row_mark, unit_hash
from duolex.session import stage

# At most about SAMPLE labelled rows serve each of the three fits: lexicon, trees, calibration.
SAMPLE = 20_000
# Words or word beginnings of the learned lexicon; each must occur in LEAST toxic texts of the sample.
TERMS, LEAST, LEAST_WEIGHT = 5000, 3, 2.0
PREFIXES = (4, 5, 6)
# Terms that a task counts before it hands them on.
HELD_TERMS = 100_000
TREES, DEPTH, STEP = 24, 3, 0.3
WINDOW, NEAR = 20, 3
SEED = 11

# Insults that count from the start, whatever the labels say.
INSULTS = (
    "bastard clown clowns disgusting dumb filth fool garbage idiot idiotic idiots imbecile loser losers moron morons "
    "pathetic pig scum scumbag shut stupid trash ugly vermin worthless "
    "arschloch abschaum dummkopf idioten vollidiot blöd crétin imbécile connard débile estúpido imbécil idiota basura"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes"
).split()

FEATURES = [
    "log_words", "insult_density", "term_density", "log_term_hits", "top_term", "near_second_person", "second_person_density",
    "capital_rate", "shouted_words", "exclamation_density", "punctuation_runs", "obfuscation_density", "obfuscated_terms",
    "densest_window",
]

# Lower-cases A-Z and makes a blank of every other ASCII character but digits and lower-case letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128))
_SHOUTED = re.compile(rb"(?<![A-Za-z\x80-\xff])[A-Z]{3,}(?![A-Za-z\x80-\xff])")
_RUNS = re.compile(rb"[!?*#%&$@]{2,}")
_DISGUISED = re.compile(rb"[0-9@$]*[A-Za-z]+(?:[0-9@$*]+[A-Za-z]+)+")
_UNMASK = bytes.maketrans(b"013457@$", b"oieastas")


def _terms(word: bytes) -> list[bytes]:
    """A word and its beginnings; the latter end in a star."""
    return [word] + [word[:n] + b"*" for n in PREFIXES if len(word) > n]


class Weights(dict):
    """Weight of a word, the largest of its own and its beginnings'; words met are kept, up to a bound."""

    def __init__(self, terms: dict[bytes, float], most: int = 100_000):
        super().__init__()
        self.terms, self.most = terms, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        get = self.terms.get
        self[word] = found = max(get(t, 0.0) for t in _terms(word))
        return found


def features(text: str | None, weights: Weights, insults: frozenset, second: frozenset) -> list[float]:
    """One number per name in FEATURES. Null and empty texts give zeros.

    Densities are per hundred words. A hit is a word with a weight; a hit is near a second person within
    NEAR words; the densest window is the most hits within WINDOW words.
    """
    import math

    raw = (text or "").encode("utf-8", "replace")
    words = raw.translate(_FOLD).split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits = [(i, v) for i, w in enumerate(words) if (v := weights[w])]
    persons = [i for i, w in enumerate(words) if w in second]
    per = 100.0 / n
    near, at = 0, 0
    for i, _ in hits:
        while at < len(persons) and persons[at] < i - NEAR:
            at += 1
        near += at < len(persons) and persons[at] <= i + NEAR
    densest, first = 0, 0
    for last in range(len(hits)):
        while hits[last][0] - hits[first][0] >= WINDOW:
            first += 1
        densest = max(densest, last - first + 1)
    letters = len(raw.translate(None, _NOT_LETTER))
    disguised = _DISGUISED.findall(raw)
    unmasked = sum(
        weights[d.translate(_UNMASK).lower()] > 0 or weights[re.sub(rb"[0-9@$*]", b"", d).lower()] > 0 for d in disguised)
    return [
        math.log1p(n), per * sum(w in insults for w in (words[i] for i, _ in hits)), per * sum(v for _, v in hits),
        math.log1p(len(hits)), max((v for _, v in hits), default=0.0), per * near, per * len(persons),
        len(raw.translate(None, _NOT_CAPITAL)) / max(1, letters), per * len(_SHOUTED.findall(raw)),
        per * (raw.count(b"!") + raw.count(b"?")), per * len(_RUNS.findall(raw)), per * len(disguised),
        float(unmasked), float(densest)]


def _count_terms(batches: Iterator) -> Iterator:
    """Texts per term and label of a task, handed on whenever many terms have come up."""
    import pyarrow as pa
    from collections import Counter

    toxic_in, clean_in = Counter(), Counter()

    def rows():
        names = list(toxic_in | clean_in)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([toxic_in[t] for t in names], pa.int64()),
             pa.array([clean_in[t] for t in names], pa.int64())], ["term", "toxic", "clean"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            words = set((text.as_py() or "").encode("utf-8", "replace").translate(_FOLD).split())
            (toxic_in if toxic else clean_in).update({t for w in words for t in _terms(w)})
            if len(toxic_in) + len(clean_in) > HELD_TERMS:
                yield rows()
                toxic_in.clear()
                clean_in.clear()
    yield rows()


def learn_terms(texts: DataFrame) -> dict[bytes, float]:
    """At most TERMS terms of (text, toxic) rows with their log odds ratio, smoothed by one text a side."""
    toxic, clean = texts.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    counted = texts.select("text", "toxic").mapInArrow(_count_terms, "term binary, toxic long, clean long")
    summed = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 1) / (toxic + 2)) - F.log((F.col("clean") + 1) / (clean + 2))
    best = summed.filter(F.col("toxic") >= LEAST).select("term", weight.alias("weight")).filter(
        F.col("weight") > LEAST_WEIGHT).orderBy(F.desc("weight"), "term").limit(TERMS)
    return {bytes(r["term"]): r["weight"] for r in best.collect()}


def _featurize(terms: dict[bytes, float]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights = Weights(terms)
        insults = frozenset(w.encode() for w in INSULTS)
        second = frozenset(w.encode() for w in SECOND_PERSON)
        for batch in batches:
            rows = [features(t.as_py(), weights, insults, second) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["key", "_mark", "features"])

    return run


def fold(key: str | Column) -> Column:
    """0 to 4 by the checksum of the key as text; rows without key are in fold 0 and never learned from."""
    return F.coalesce(F.crc32((F.col(key) if isinstance(key, str) else key).cast("string")) % 5, F.lit(0)).cast("int")


def labelled_sample(labels: DataFrame, key: str, label: str, sample: int) -> DataFrame:
    """key, toxic, fold: one row per labelled key of folds 1 to 4, thinned by key to `sample` rows a fit."""
    rows = labels.select(F.col(key).cast("bigint").alias("_id"), F.col(label).cast("int").alias("toxic")).filter(
        "_id is not null and toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    rows = stage(rows.withColumn("fold", fold("_id")).filter("fold > 0"), "labelled")
    share = min(1.0, 4 * sample / max(1, rows.count()))
    return F.broadcast(stage(rows.filter(unit_hash("_id", F.lit(SEED)) < share), "label-sample"))


def fit_and_score(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id",
                  label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """key, held_out, score, predicted, features, _mark of every row.

    Labels of fold 0 are never read. Folds 1 and 2 give the lexicon, 3 the trees, 4 the calibration, at
    most about `sample` labelled rows each, so no fit sees what another was made from. Only the text
    enters a score. Where a fold lacks a class its fit is left out: no trees means a score by density of
    insults, no calibration the trees' own probability. Repeated rows score alike; null and empty texts
    are scored like a text without any sign. Whole texts are read where they are; only the label sample,
    bounded by `sample`, is sent around.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    known = labelled_sample(labels, label_key, label, sample)
    rows = df.select(F.col(key).cast("bigint").alias("key"), row_mark(df).alias("_mark"), F.col(text).alias("text"))
    early = known.filter("fold in (1, 2)")
    terms = {w.encode(): 4.0 for w in INSULTS}
    terms.update(learn_terms(stage(rows.join(early, F.col("key") == F.col("_id")).select("text", "toxic"), "lexicon-texts")))
    staged = stage(rows.mapInArrow(_featurize(terms), "key long, _mark long, features array<double>"), "features")
    vectors = staged.withColumn("vector", array_to_vector("features"))
    learn = vectors.join(known, F.col("key") == F.col("_id"))
    sides = {(r["fold"], r["toxic"]) for r in learn.groupBy("fold", "toxic").count().collect()}
    if {(3, 0), (3, 1)} <= sides:
        trees = GBTClassifier(
            featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
        model = trees.fit(stage(learn.filter("fold = 3").select("vector", "toxic"), "tree-rows").coalesce(8))
        scored = model.transform(vectors).withColumn("raw", vector_to_array("probability")[1]).drop(
            "prediction", "rawPrediction", "probability")
    else:
        scored = vectors.withColumn("raw", 1 - F.exp(-F.col("features")[FEATURES.index("insult_density")]))
    if {(3, 0), (3, 1), (4, 0), (4, 1)} <= sides:
        held = scored.join(known.filter("fold = 4"), F.col("key") == F.col("_id")).select("raw", "toxic")
        steps = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="_step").fit(stage(held, "calibration"))
        # A tenth of the trees' own probability orders rows that share a step, without crossing one half.
        step = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_step")))
        ordered = F.when(step >= 0.5, F.greatest(F.lit(0.5), 0.9 * step + 0.1 * F.col("raw"))).otherwise(
            F.least(F.lit(0.4999), 0.9 * step + 0.1 * F.col("raw")))
        scored = steps.transform(scored).withColumn("score", ordered)
    else:
        scored = scored.withColumn("score", F.col("raw"))
    return scored.select(
        F.col("key").alias(key), (fold("key") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "features", "_mark")


def drop_toxic(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`df` without the rows predicted toxic; columns as they were."""
    scored = stage(fit_and_score(df, labels, key, text, **options).select(key, "_mark", "predicted"), "toxicity")
    return repeat_rows(df, scored.select(key, "_mark", (1 - F.col("predicted")).alias("copies")), key)
