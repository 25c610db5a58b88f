"""Sentences by language: abbreviations are learned from the texts, full stops after them end nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duolex.functions.text import ColumnOrName, as_col, let
from duolex.session import small_side, stage

# How sure a full stop follows an abbreviation, and the least score of one, as published for
# the unsupervised method by Kiss and Strunk.
SURE, LEAST_SCORE = 0.99, 0.3

BLANKS = " \\t\\n\\r"
# Marks that end a sentence before a blank, marks that need none, and what may close after a mark.
ENDS, WIDE_ENDS = ".!?؟۔।॥…", "。！？｡"
CLOSERS = "\"')\\]»”’」』）"
TOKEN = f"([^{BLANKS}]+[{BLANKS}]*)"
# A token of letters, with full stops inside or without, and whether one follows.
DOTTED = f"^[^\\p{{L}}\\p{{N}}]*(\\p{{L}}+(?:\\.\\p{{L}}+)*)(\\.?)[{BLANKS}]*$"
END = f"(?:[{ENDS}][{ENDS}{CLOSERS}]*|[{WIDE_ENDS}][{WIDE_ENDS}{CLOSERS}]*)[{BLANKS}]*$"
WIDE_RUN = f"([{WIDE_ENDS}][{WIDE_ENDS}{CLOSERS}]*)"


def _tokens(text: ColumnOrName) -> Column:
    """Runs between blanks, each with those that follow; a wide mark ends a token without one."""
    return F.regexp_extract_all(F.regexp_replace(as_col(text), WIDE_RUN, "$1 "), F.lit(TOKEN), F.lit(1))


def learn_abbreviations(df: DataFrame, text: str = "text", lang: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """lang, token, n, dotted, score: the words that a full stop belongs to, for each language.

    The score is the likelihood ratio of "a stop nearly always follows" against "a stop follows as often as
    after any word", damped by length and by uses without a stop, raised by stops inside. Counts combine in
    each task, a row per distinct word moves. Rows without language have none of their own, but share theirs.
    """
    words = df.select(F.col(lang).alias("lang"), F.explode(_tokens(text)).alias("t")).select(
        "lang", F.lower(F.regexp_extract("t", DOTTED, 1)).alias("token"), F.regexp_extract("t", DOTTED, 2).alias("dot"))
    counts = stage(words.filter("token <> ''").groupBy("lang", "token").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("dot") == ".", 1)).alias("dotted")), "dotted-words")
    # One row per language.
    totals = counts.groupBy(F.col("lang").alias("_lang")).agg((F.sum("dotted") / F.sum("n")).alias("p"))
    k, bare = F.col("dotted"), F.col("n") - F.col("dotted")
    stops = F.length("token") - F.length(F.replace("token", F.lit("."), F.lit("")))
    letters = F.length("token") - stops
    ratio = 2 * (k * (F.log(F.lit(SURE)) - F.log("p")) + bare * (F.log(F.lit(1 - SURE)) - F.log(F.greatest(1 - F.col("p"), F.lit(1e-12)))))
    score = ratio * F.exp(-letters) * (stops + 1) * F.pow(letters.cast("double"), -bare)
    return counts.join(F.broadcast(totals), F.col("lang").eqNullSafe(F.col("_lang"))).filter("dotted > 0").select(
        "lang", "token", "n", "dotted", score.alias("score")).filter(F.col("score") >= least)


def _cut(tokens: Column, known: Column) -> Column:
    """Sentences of a row's tokens, given the abbreviations of its language."""
    def ends(token: Column, place: Column, count: Column) -> Column:
        short = F.array_contains(known, F.lower(F.regexp_extract(token, DOTTED, 1)))
        stop = F.regexp_extract(token, DOTTED, 2) == "."
        return (place == count) | (token.rlike(END) & ~(stop & F.coalesce(short, F.lit(False))))

    def sentences(t: Column) -> Column:
        places = F.filter(F.transform(t, lambda x, i: F.when(ends(x, i + 1, F.size(t)), i + 1)), lambda x: x.isNotNull())
        return let(places, lambda e: F.transform(e, lambda to, i: let(
            F.when(i == 0, 0).otherwise(F.get(e, i - 1)),
            lambda before: F.btrim(F.array_join(F.slice(t, before + 1, to - before), ""), F.lit(" \t\n\r")))))

    return let(tokens, sentences)


def split_by_language(df: DataFrame, abbreviations: DataFrame, text: str = "text", lang: str = "lang",
                      out: str = "sentences") -> DataFrame:
    """Adds `out`, the sentences of each text by the rules of its language; a missing text has none.

    A sentence ends at a mark before a blank, at wide marks anywhere, and at the end of the text; not at the
    full stop of an abbreviation. Abbreviations go to the rows as one list per language, if they fit a broadcast.
    """
    listed = abbreviations.select("lang", "token")
    staged = stage(listed, "abbreviations")
    lists = staged.groupBy(F.col("lang").alias("_lang")).agg(F.collect_set("token").alias("_known"))
    fits = small_side(staged) is not staged
    joined = df.join(F.broadcast(lists) if fits else lists, F.col(lang).eqNullSafe(F.col("_lang")), "left")
    return joined.withColumn(out, _cut(_tokens(text), F.coalesce("_known", F.array().cast("array<string>")))).drop("_lang", "_known")
