import re
from collections import Counter, defaultdict

import pytest

from duolex.llm import divergence

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, least, top):
    """Rows of (text, lang, source), as whole numbers of Python."""
    held, uses, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))
        groups.add((lang, source))
        held[lang].update(set(words))
        uses[lang, source].update(words)
    out = []
    for lang, source in groups:
        terms = [t for t, n in held[lang].items() if n >= least]
        v = len(terms)
        mates = [s for g, s in groups if g == lang]
        counts = {s: {t: uses[lang, s][t] for t in terms} for s in mates}
        whole = {t: sum(counts[s][t] for s in mates) for t in terms}

        def share(of, t):
            return 1 + 10 ** 9 * (of[t] + 2) // (sum(of.values()) + 2 * v)

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        pairs = [(s, sum(gap(share(counts[source], t), share(counts[s], t)) for t in terms)) for s in mates if s != source]
        lead = [(t, gap(share(counts[source], t), share(whole, t))) for t in terms
                if counts[source][t] and share(counts[source], t) > share(whole, t)]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", lead, top)):
            ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)]
    return Counter(out)


def _found(df, **options):
    return Counter(tuple(r) for r in divergence.audit(df, **options).collect())


@pytest.mark.parametrize("cells", [None, 7])
def test_against_brute_force(spark, odd, odd_wide, odd_rows, empty, monkeypatch, cells):
    if cells:  # many blocks, and partial counts handed on early
        monkeypatch.setattr(divergence, "CELLS", cells)
        monkeypatch.setattr(divergence, "TEXTS", 2)
        monkeypatch.setattr(divergence, "HELD", 10)
    rows = [(t, lang, s) for _, t, lang, s, _ in odd_rows if len(t or "") < 10_000]
    rows += [("Éa éa word WORD it's x2y 日本 日本", "en", None), ("word x y", "en", "a"), ("word, word; it", None, "b"), ("", "xx", "z"), (None, "xx", "")]
    rows *= 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for least, top in ((1, 3), (4, 10), (1000, 10)):
        assert _found(df, least_docs=least, top=top) == _brute(rows, least, top)
    assert _found(odd, least_docs=2) == _found(odd_wide, least_docs=2) == _brute([r[1:4] for r in odd_rows], 2, 10)
    assert not _found(empty)


def test_one_source_and_many(spark):
    rows = [(f"a b{i % 7} c", "en", f"s{i % 90:02}") for i in range(400)] + [("alone here", "fr", "only")] * 12
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert _found(df, least_docs=10, top=2) == _brute(rows, 10, 2)


def test_shares_are_exact():
    import numpy as np
    for count, total in ((2, 7), (10 ** 9, 3 * 10 ** 9 + 1), (10 ** 15 - 1, 10 ** 15)):
        assert divergence._shares(np.array([count]), total)[0] == 1 + 10 ** 9 * count // total
