"""Ordered normalisers and validators on segments (`src`, `tgt`), chosen by name.

A normaliser has one function per mode, a validator acts in training only.
Functions take and return frames, so a step may be a projection, a filter or a
join; all steps together are one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from duolex.functions.text import english_formalize, spanish_plural_abbreviations
from duolex.operators.decontaminate import drop_test_lines
from duolex.operators.routing import equal_sentences_ok

MODES = ("train", "decode_src", "decode_tgt")
Step = Callable[..., DataFrame]
_NORMALIZERS: dict[str, Step] = {}
_VALIDATORS: dict[str, Step] = {}


def register_normalizer(name: str, step: Step) -> None:
    """`step(df, src_lang, tgt_lang, mode, **options)` rewrites `src` or `tgt`."""
    _NORMALIZERS[name] = step


def register_validator(name: str, step: Step) -> None:
    """`step(df, src_lang, tgt_lang, **options)` returns the rows that pass."""
    _VALIDATORS[name] = step


def registered() -> list[str]:
    return sorted([*_NORMALIZERS, *_VALIDATORS])


def column_normalizer(rewrite: Callable[[Column], Column], lang: str, both_sides: bool) -> Step:
    """A normaliser that rewrites the sides in `lang`.

    In training with `both_sides` off the target is left alone when the source matches.
    """
    def step(df: DataFrame, src_lang: str, tgt_lang: str, mode: str) -> DataFrame:
        on_src = src_lang == lang and mode in ("train", "decode_src")
        on_tgt = tgt_lang == lang and mode in ("train", "decode_tgt")
        if mode == "train" and on_src and not both_sides:
            on_tgt = False
        changes = {}
        if on_src:
            changes["src"] = rewrite(df["src"])
        if on_tgt and "tgt" in df.columns:
            changes["tgt"] = rewrite(df["tgt"])
        return df.withColumns(changes) if changes else df

    return step


_formalize = column_normalizer(english_formalize, "en", both_sides=False)


def _english_formalizer(df: DataFrame, src_lang: str, tgt_lang: str, mode: str) -> DataFrame:
    if "en" not in (src_lang, tgt_lang):
        raise ValueError("the English formaliser needs English on one side")
    return _formalize(df, src_lang, tgt_lang, mode)


def _equal_sentences(df: DataFrame, src_lang: str, tgt_lang: str) -> DataFrame:
    return df.filter(equal_sentences_ok("src", "tgt"))


def _contains_test(df: DataFrame, src_lang: str, tgt_lang: str, lines: DataFrame, **options) -> DataFrame:
    return drop_test_lines(df, lines, "src", **options)


register_normalizer("english_formalizer_norm", _english_formalizer)
register_normalizer("spanish_plural_abbreviations",
                    column_normalizer(spanish_plural_abbreviations, "es", both_sides=True))
register_validator("equals_sentences_val", _equal_sentences)
register_validator("contains_test_val", _contains_test)


def process(df: DataFrame, steps: Sequence[str | tuple[str, dict]], src_lang: str, tgt_lang: str,
            mode: str = "train") -> DataFrame:
    """Run steps in order; a step is a name or `(name, options)`."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")

    def apply(frame: DataFrame, item) -> DataFrame:
        name, options = (item, {}) if isinstance(item, str) else item
        if name in _NORMALIZERS:
            return _NORMALIZERS[name](frame, src_lang, tgt_lang, mode, **options)
        if name in _VALIDATORS:
            return _VALIDATORS[name](frame, src_lang, tgt_lang, **options) if mode == "train" else frame
        raise KeyError(f"no step named {name!r}; known: {registered()}")

    return reduce(apply, steps, df)
