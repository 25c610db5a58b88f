"""Row rules of the cleaning steps, as columns that tag and never filter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from duolex.functions.text import ColumnOrName, as_col, blank_parts, missing_as_text, split_sentences

# Fixed values.
SUPPORTED_LANGS = ["en", "lv", "de", "cs", "lt", "hu", "it", "sv", "el", "es", "fi", "fr"]
LONG_TEXT_PARTS = 40
EQUAL_SENTENCE_PARTS = 5
MISSING_TOKEN = "[[[@@@MISSING_TRANSLATION@@@]]]"


def equal_pair(tr1: ColumnOrName, tr2: ColumnOrName) -> Column:
    """Both sides equal without regard to case; a missing side reads `nan`."""
    return F.lower(missing_as_text(tr1)) == F.lower(missing_as_text(tr2))


def equal_sentences_ok(src: ColumnOrName, tgt: ColumnOrName) -> Column:
    """False for equal sides of five parts and more, or of the missing-translation token."""
    s = as_col(src)
    gate = (blank_parts(s) >= EQUAL_SENTENCE_PARTS) | (s == MISSING_TOKEN)
    return ~F.coalesce(gate & (F.lower(s) == F.lower(as_col(tgt))), F.lit(False))


def length_ratio(tr1: ColumnOrName, tr2: ColumnOrName) -> Column:
    """`Delete` from three times the other side's length, `Check` from twice, else `Ok`."""
    a, b = F.length(as_col(tr1)), F.length(as_col(tr2))
    short, long = F.least(a, b), F.greatest(a, b)
    return F.when(short * 3 <= long, "Delete").when(short * 2 <= long, "Check").otherwise("Ok")


def long_text(tr1: ColumnOrName, tr2: ColumnOrName) -> Column:
    return (blank_parts(tr1) >= LONG_TEXT_PARTS) | (blank_parts(tr2) >= LONG_TEXT_PARTS)


def supported(lang: ColumnOrName) -> Column:
    return as_col(lang).isin(SUPPORTED_LANGS)


def aligned_sentences(tr1: ColumnOrName, tr2: ColumnOrName) -> Column:
    """Array of `(s1, s2)`: the pair itself if short, its sentences if as many on
    both sides, NULL if the counts differ or there is no sentence at all."""
    first, second = as_col(tr1), as_col(tr2)

    def zipped(parts: Column) -> Column:
        same = (F.size(parts["a"]) == F.size(parts["b"])) & (F.size(parts["a"]) > 0)
        return F.when(
            same, F.zip_with(parts["a"], parts["b"], lambda x, y: F.struct(x.alias("s1"), y.alias("s2")))
        )

    split = F.element_at(F.transform(
        F.array(F.struct(split_sentences(first).alias("a"), split_sentences(second).alias("b"))), zipped), 1)
    whole = F.array(F.struct(first.alias("s1"), second.alias("s2")))
    return F.when(long_text(first, second), split).otherwise(whole)


def language_verdict(lang1: ColumnOrName, lang2: ColumnOrName,
                     found1: ColumnOrName, found2: ColumnOrName) -> Column:
    """`keep`, `swap` or `delete` by the languages found on the two sides.

    The cases are not symmetric on purpose: see the README.
    """
    l1, l2, p1, p2 = as_col(lang1), as_col(lang2), as_col(found1), as_col(found2)
    in1, in2 = F.coalesce(supported(l1), F.lit(False)), F.coalesce(supported(l2), F.lit(False))
    swap = (
        F.when(in1 & in2, (p1 == l2) & (p2 == l1))
        .when(in1, p1 == l2)
        .when(in2, p2 == l1)
        .otherwise(F.lit(False))
    )
    wrong = (
        F.when(in2, (p1 != l1) | (p2 != l2))
        .when(in1, p1 != l1)
        .otherwise(F.lit(False))
    )
    return (
        F.when(F.coalesce(swap, F.lit(False)), "swap")
        .when(F.coalesce(wrong, F.lit(True)), "delete")
        .otherwise("keep")
    )
