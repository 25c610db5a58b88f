"""Translation quality as a degree-two regression on error rates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duolex.functions.metrics import cer, f_measure, wer

FEATURES = ["wer", "cer", "f_score"]
TERMS = ["wer", "cer", "f_score", "wer_wer", "wer_cer", "wer_f_score", "cer_cer", "cer_f_score", "f_score_f_score"]


def quality_features(df: DataFrame, source: str = "source", translation: str = "translation") -> DataFrame:
    return df.withColumns({
        "wer": wer(source, translation), "cer": cer(source, translation), "f_score": f_measure(source, translation)
    })


def poly2(features: list[str] = FEATURES) -> list[Column]:
    """All terms of degree one and two without a constant: a b c aa ab ac bb bc cc."""
    cols = [F.col(c) for c in features]
    squares = [
        (cols[i] * cols[j]).alias(f"{features[i]}_{features[j]}")
        for i in range(len(cols)) for j in range(i, len(cols))
    ]
    return [*cols, *squares]


def with_judgement(df: DataFrame, judges: tuple[str, str] = ("evaluator1 scores", "evaluator2 scores"),
                   out: str = "score") -> DataFrame:
    """The mean of the two judges as the score to fit."""
    return df.withColumn(out, (F.col(f"`{judges[0]}`") + F.col(f"`{judges[1]}`")) / 2)


def gram_matrix(df: DataFrame, label: str = "score", features: list[str] = FEATURES,
                scale: float = 100.0) -> DataFrame:
    """Rows (i, j, value): centred second moments of the terms and the label, one aggregate.

    Features are divided by `scale` first and moments are taken about the mean,
    so the sums stay well conditioned. Rows with a missing value do not count.
    """
    base = df.select(*[(F.col(f) / scale).alias(f) for f in features], F.col(label).alias("label"))
    terms = base.select(*poly2(features), "label")
    names = terms.columns
    cells = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    # Not a filter, which would be pushed down to the measures and take each of them twice.
    whole = reduce(lambda x, y: x & y, [F.col(n).isNotNull() & ~F.isnan(n) for n in names])
    terms = terms.select(F.when(whole, F.struct(*names)).alias("t")).select("t.*")
    wide = terms.agg(*[F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in cells])
    entries = F.array(*[
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"), F.col(f"`{a}|{b}`").alias("value")) for a, b in cells
    ])
    return wide.select(F.inline(entries))


@dataclass(frozen=True)
class QualityModel:
    intercept: float
    coefficients: tuple[float, ...]

    def predict(self, df: DataFrame, features: list[str] = FEATURES, out: str = "prediction") -> DataFrame:
        """Predicted score as plain arithmetic on the feature columns."""
        score = F.lit(self.intercept)
        for weight, term in zip(self.coefficients, poly2(features)):
            score = score + F.lit(weight) * term
        return df.withColumn(out, score)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        rows = [("intercept", self.intercept), *zip(TERMS, self.coefficients)]
        return spark.createDataFrame([(n, float(v)) for n, v in rows], "term string, weight double")


def fit_quality(df: DataFrame, label: str = "score", features: list[str] = FEATURES) -> QualityModel:
    """Ordinary least squares of `label` on the nine terms, in one pass over the rows."""
    terms = df.select(*poly2(features), F.col(label).alias("label")).dropna()
    names = [c for c in terms.columns if c != "label"]
    data = VectorAssembler(inputCols=names, outputCol="features").transform(terms)
    fitted = LinearRegression(labelCol="label", regParam=0.0, solver="normal").fit(data)
    return QualityModel(float(fitted.intercept), tuple(float(c) for c in fitted.coefficients))


def fit_from_moments(df: DataFrame, label: str = "score", features: list[str] = FEATURES,
                     scale: float = 100.0) -> QualityModel:
    """The same fit from the moment table: the driver solves a nine-by-nine system.

    Of several best fits (terms that depend on each other) the smallest is taken.
    """
    scaled = df.select(*[(F.col(f) / scale).alias(f) for f in features], F.col(label).alias("label"))
    terms = scaled.select(*poly2(features), "label").dropna()
    names = terms.columns
    means = [F.avg(n).alias(f"mean|{n}") for n in names]
    cells = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    row = terms.agg(*means, *[F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in cells]).first()
    size = len(names) - 1
    gram = np.empty((size + 1, size + 1))
    for a, b in cells:
        i, j = names.index(a), names.index(b)
        gram[i, j] = gram[j, i] = row[f"{a}|{b}"]
    spread = np.sqrt(np.diag(gram)[:size])
    spread[spread == 0] = 1.0
    solution = np.linalg.lstsq(
        gram[:size, :size] / np.outer(spread, spread), gram[:size, size] / spread, rcond=1e-12)[0] / spread
    centre = np.array([row[f"mean|{n}"] for n in names])
    intercept = centre[size] - solution @ centre[:size]
    degrees = np.array([1] * len(features) + [2] * (size - len(features)))
    return QualityModel(float(intercept), tuple(float(x) for x in solution / scale ** degrees))


def pearson(df: DataFrame, first: str, second: str, out: str = "pearson") -> DataFrame:
    return df.agg(F.corr(F.col(f"`{first}`"), F.col(f"`{second}`")).alias(out))


def evaluate_quality(train: DataFrame, test: DataFrame, label: str = "score") -> DataFrame:
    """Fit on one table, predict another, correlate with its scores."""
    model = fit_quality(train, label)
    return pearson(model.predict(test), label, "prediction")
