"""Column functions on text: cleaning, normalising, tokens, sentences."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Fixed values.
WHITESPACE = r"\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
FORMALIZER_WORDS = {"thru": "through", "throught": "through", "nite": "night"}
FORMALIZER_DELIMITERS = [" ", ",", ";", ":", ".", "{", "}", "[", "]", "/", "\\", "(", ")", "?", "¡", '"', "'"]
FORMALIZER_MIN_LENGTH = 3
SERIES_GATE = "SERIES TITLE"
SERIES_PREFIX = "SERIES TITLE: "
SUMMARY_GATE = "Original language summary"
SUMMARY_PREFIX = "Original language summary: "
SENTENCE_ENDS = ".!?"
NO_BREAK_SPACE = "\u00a0"


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body`, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


# -- parts and tokens ---------------------------------------------------------

def blank_parts(c: ColumnOrName) -> Column:
    """Number of parts between single blanks; empty parts count."""
    return F.size(F.split(as_col(c), " ", -1))


def whitespace_tokens(c: ColumnOrName) -> Column:
    """Tokens between runs of any whitespace."""
    return F.array_remove(F.split(as_col(c), f"[{WHITESPACE}]+", -1), "")


def word_tokens(c: ColumnOrName) -> Column:
    """Lower-case runs of letters, digits and underscore."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def strip_newlines(c: ColumnOrName) -> Column:
    return F.btrim(as_col(c), F.lit("\n"))


def missing_as_text(c: ColumnOrName) -> Column:
    return F.coalesce(as_col(c), F.lit("nan"))


def label_suffix(c: ColumnOrName) -> Column:
    """Last part of a label such as `__label__en`."""
    return F.element_at(F.split(as_col(c), "__", -1), -1)


# -- cleaning -----------------------------------------------------------------

def remove_newlines(c: ColumnOrName) -> Column:
    return F.replace(missing_as_text(c), F.lit("\n"), F.lit(""))


def clean_pair(tr1: ColumnOrName, tr2: ColumnOrName) -> tuple[Column, Column]:
    """Both sides without newlines and without catalogue prefixes.

    The summary prefix goes only where the first side held no series title.
    """
    first, second = remove_newlines(tr1), remove_newlines(tr2)
    series = first.contains(SERIES_GATE)
    cleaned_first = F.when(series, F.replace(first, F.lit(SERIES_PREFIX), F.lit(""))).otherwise(first)
    cleaned_second = F.when(
        ~series & second.contains(SUMMARY_GATE),
        F.replace(second, F.lit(SUMMARY_PREFIX), F.lit("")),
    ).otherwise(second)
    return cleaned_first, cleaned_second


# -- normalisers --------------------------------------------------------------

def replace_tokens(c: ColumnOrName, lexicon: Mapping[str, str], delimiters: list[str],
                   min_length: int = 1) -> Column:
    """Swap whole tokens for their entry in a small lexicon, delimiters kept.

    Text that holds none of the words is passed on after one pattern test.
    """
    col = as_col(c)
    words = {k: v for k, v in lexicon.items() if len(k) >= min_length}
    if not words:
        return col
    inside = "".join(re.escape(d) for d in delimiters)
    table = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
    tokens = F.regexp_extract_all(col, F.lit(f"([^{inside}]+|[{inside}])"), F.lit(1))
    swapped = F.array_join(
        F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t)), ""
    )
    return F.when(col.rlike("|".join(re.escape(w) for w in words)), swapped).otherwise(col)


def english_formalize(c: ColumnOrName) -> Column:
    return replace_tokens(c, FORMALIZER_WORDS, FORMALIZER_DELIMITERS, FORMALIZER_MIN_LENGTH)


def spanish_plural_abbreviations(c: ColumnOrName, strict: bool = False) -> Column:
    """`EE UU`, `EE.UU.` and the like as `EE.`, no-break space, `UU.`.

    By default the second pair need not be a doubled letter: its last letter is
    doubled. `strict` wants two doubled letters standing as a word of their own.
    """
    gap = f"[.{WHITESPACE}]{{0,2}}"
    if strict:
        pattern = rf"(?<![\p{{L}}\p{{N}}_])([A-Z])\1{gap}([A-Z])\2(?![\p{{L}}\p{{N}}_])\.?"
    else:
        pattern = rf"([A-Z])\1{gap}([A-Z]){{2}}\.?"
    return F.regexp_replace(as_col(c), pattern, f"$1$1.{NO_BREAK_SPACE}$2$2.")


# -- sentences ----------------------------------------------------------------

def split_sentences(c: ColumnOrName) -> Column:
    """Sentences of a text: runs up to and with closing marks, trimmed, none empty.

    The same rule serves every language.
    """
    runs = F.regexp_extract_all(
        as_col(c), F.lit(f"([^{SENTENCE_ENDS}]*[{SENTENCE_ENDS}]+|[^{SENTENCE_ENDS}]+)"), F.lit(1)
    )
    return F.array_remove(F.transform(runs, lambda s: F.trim(s)), "")


# -- characters ---------------------------------------------------------------

def characters(c: ColumnOrName) -> Column:
    """Code points of a text as an array."""
    return F.array_remove(F.split(as_col(c), ""), "")


def character_runs(c: ColumnOrName, length: int) -> Column:
    """Overlapping runs of `length` characters.

    A look-ahead yields one run per character; none starts within a surrogate pair.
    """
    pattern = rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{length}}}))"
    return F.regexp_extract_all(as_col(c), F.lit(pattern), F.lit(1))


def trigrams(c: ColumnOrName) -> Column:
    """Overlapping runs of three characters of the lower-cased text."""
    return character_runs(F.lower(as_col(c)), 3)
