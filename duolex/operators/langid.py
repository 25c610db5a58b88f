"""Language profiles from character trigrams, and the language of texts.

Weights are logarithms in whole millionths, so sums are exact, the same in any
order, and ties are true ties (the smaller language code wins).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from duolex.functions.text import trigrams
from duolex.session import stage

SCALE = 1_000_000
# Profiles up to this many rows are sent to the tasks whole (about 200 MB there).
MAX_BROADCAST_ROWS = 4_000_000
_CHUNK_CHARS = 1 << 16


def count_trigrams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, gram, n. Counts combine in each task before the shuffle."""
    return (
        df.select(F.col(lang).alias("lang"), F.explode(trigrams(text)).alias("gram"))
        .groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    )


def train_profiles(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Profiles (lang, gram, n, weight, unseen): add-one smoothed log-probabilities.

    The vocabulary is all trigrams seen in any language; priors are even.
    """
    counts = stage(count_trigrams(df, text, lang), "trigrams")
    vocabulary = counts.select("gram").distinct().count()
    totals = counts.groupBy("lang").agg((F.sum("n") + F.lit(vocabulary)).alias("mass"))

    def micro(p):
        return F.round(F.ln(p) * SCALE).cast("bigint")

    return counts.join(totals, "lang").select(
        "lang", "gram", "n",
        micro((F.col("n") + 1) / F.col("mass")).alias("weight"),
        micro(F.lit(1.0) / F.col("mass")).alias("unseen"),
    )


def _gram_codes(grams) -> np.ndarray:
    units = np.frombuffer("".join(grams).encode("utf-32-le"), dtype="<u4").astype(np.int64).reshape(-1, 3)
    return units[:, 0] << 42 | units[:, 1] << 21 | units[:, 2]


def _broadcast_model(profiles: DataFrame):
    """langs, sorted trigram codes, weight gain over unseen per code and language, unseen."""
    rows = profiles.select("lang", "gram", (F.col("weight") - F.col("unseen")).alias("gain"), "unseen").toPandas()
    langs = sorted(rows["lang"].unique())
    codes, at = np.unique(_gram_codes(rows["gram"]), return_inverse=True)
    which = rows["lang"].map({l: i for i, l in enumerate(langs)}).to_numpy()
    gains = np.zeros((len(langs), len(codes)), dtype=np.int64)
    gains[which, at] = rows["gain"].to_numpy()
    unseen = np.zeros(len(langs), dtype=np.int64)
    unseen[which] = rows["unseen"].to_numpy()
    return profiles.sparkSession.sparkContext.broadcast((langs, codes, gains, unseen))


def _predictor(model):
    @F.pandas_udf(T.StringType())
    def predict(lowered: pd.Series) -> pd.Series:
        langs, codes, gains, unseen = model.value
        texts = lowered.dropna()
        best = np.empty(len(texts), dtype=np.int64)
        lengths = texts.str.len().to_numpy(dtype=np.int64)
        chunk_of = np.cumsum(lengths) // _CHUNK_CHARS
        for chunk in np.unique(chunk_of):
            rows = np.flatnonzero(chunk_of == chunk)
            units = np.frombuffer(
                "".join(texts.iloc[rows]).encode("utf-32-le"), dtype="<u4").astype(np.int64)
            owner = np.repeat(np.arange(len(rows)), lengths[rows])
            inside = np.flatnonzero(owner[:-2] == owner[2:])
            grams = units[inside] << 42 | units[inside + 1] << 21 | units[inside + 2]
            owner = owner[inside]
            at = np.minimum(np.searchsorted(codes, grams), len(codes) - 1)
            known = codes[at] == grams
            seen_at, seen_owner = at[known], owner[known]
            total = np.bincount(owner, minlength=len(rows)).astype(np.int64)
            scores = np.stack([
                total * unseen[k]
                + np.bincount(seen_owner, weights=gains[k][seen_at], minlength=len(rows)).astype(np.int64)
                for k in range(len(langs))
            ])
            best[rows] = scores.argmax(axis=0)
        found = pd.Series([langs[i] for i in best], index=texts.index, dtype=object)
        return found.reindex(lowered.index)

    return predict


def _by_join(df: DataFrame, columns: dict[str, str], profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Languages by joining exploded trigrams with the profiles, of any size."""
    totals = profiles.groupBy("lang").agg(F.max("unseen").alias("unseen")).orderBy("lang").collect()
    langs = [r["lang"] for r in totals]
    wide = profiles.groupBy("gram").pivot("lang", langs).agg(F.max(F.col("weight") - F.col("unseen")))
    wide = wide.toDF("gram", *[f"gain_{i}" for i in range(len(langs))])
    sides = F.array(*[
        F.struct(F.lit(out).alias("side"), F.col(src).alias("txt")) for out, src in columns.items()
    ])
    grams = (
        df.select(*keys, F.explode(sides).alias("s"))
        .filter(F.col("s.txt").isNotNull())
        .select(*keys, F.col("s.side").alias("side"), F.explode_outer(trigrams("s.txt")).alias("gram"))
    )
    sums = []
    for out in columns:
        here = F.col("side") == out
        n = F.count(F.when(here, F.col("gram")))
        sums.append(F.max(here).alias(f"has_{out}"))
        for i, row in enumerate(totals):
            gain = F.coalesce(F.sum(F.when(here, F.col(f"gain_{i}"))), F.lit(0))
            sums.append((n * F.lit(row["unseen"]) + gain).alias(f"{out}_{i}"))
    scores = grams.join(wide, "gram", "left").groupBy(*keys).agg(*sums)
    codes = F.array(*[F.lit(l) for l in langs])
    found = scores.select(*keys, *[
        F.when(F.col(f"has_{out}"), F.element_at(codes, F.array_position(
            F.array(*[F.col(f"{out}_{i}") for i in range(len(langs))]),
            F.greatest(*[F.col(f"{out}_{i}") for i in range(len(langs))], F.lit(-(1 << 62))),
        ).cast("int"))).alias(out) for out in columns
    ])
    return df.join(found, keys, "left")


def predict_languages(df: DataFrame, columns: dict[str, str], profiles: DataFrame,
                      keys: list[str], max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Adds, for each `new: text` in `columns`, the language of the text.

    Profiles of a counted, bounded size (languages times trigrams) go to every
    task and the rows stay where they are. Larger ones are joined with the trigrams of the texts; `keys` must
    then name a row. Missing texts get no language.
    """
    langs, grams = profiles.agg(F.countDistinct("lang"), F.countDistinct("gram")).first()
    if not langs:
        raise ValueError("no language profile to compare with")
    # A task holds a weight per language and trigram, whether the profile has it or not.
    if langs * grams <= max_broadcast_rows:
        predict = _predictor(_broadcast_model(profiles))
        return df.withColumns({out: predict(F.lower(src)) for out, src in columns.items()})
    return _by_join(df, columns, profiles, keys)
