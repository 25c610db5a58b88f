import re
import zlib
from collections import Counter

import numpy as np
import pytest

from duolex.llm import spelling

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(words):
    out, forms = {}, {}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words.get(forms[w]))
    return out


def _found(df):
    rows = spelling.group_variants(df).collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def _texts(rng, n):
    letters = list("abcde") + ["é", "Ñ"]
    stems = ["".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(12)] + ["aaaaa", "aaaaaa", "aaaaaaa"]
    texts = []
    for _ in range(n):
        w = str(rng.choice(stems))
        for _ in range(rng.integers(0, 3)):
            i = int(rng.integers(0, len(w)))
            w = [w[:i] + w[i + 1:], w[:i] + str(rng.choice(letters)) + w[i:], w[:i] + str(rng.choice(letters)) + w[i + 1:]][rng.integers(0, 3)]
        texts.append(w if rng.random() < 0.7 else w.upper())
    return texts


@pytest.mark.parametrize("parts", [None, 17])
def test_against_brute_force(spark, monkeypatch, parts):
    if parts:  # several blocks a shard, counts and pairs cut short
        monkeypatch.setattr(spelling, "STORED", parts)
        monkeypatch.setattr(spelling, "ASKING", 2 * parts)
        monkeypatch.setattr(spelling, "PAIRS", 40)
        monkeypatch.setattr(spelling, "MOST", 2)
    rng = np.random.default_rng(4)
    texts = _texts(rng, 6000)
    rows = [(int(rng.integers(0, 400)) if i % 10 else None, " ".join(texts[i:i + 6]) + "!") for i in range(0, 6000, 6)]
    rows += [(1, None), (2, ""), (None, "12 345"), (3, "\n")]
    want = _brute(_brute_words(rows))
    assert len(want) > 150 and any(v[0] for v in want.values())
    assert _found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want


def test_odd_rows(odd, odd_wide, odd_rows, empty, spark):
    want = _brute(_brute_words([r[:2] for r in odd_rows]))
    assert _found(odd) == want and _found(odd_wide) == want
    assert _found(empty) == {}
    long = "ab" * 40_000
    rows = [(1, f"{long} {long} {long} {long}x {long}x {long}x x{long[2:]} x{long[2:]} x{long[2:]} same same same")] * 2
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(_brute_words(rows))


def test_one_letter_apart():
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(1, 7))) for _ in range(200)} | {"abcabc", "bcabca", "xabab", "abab", "ababx"})
    letters, begin, lengths = spelling.flat_letters([w.encode("latin-1") for w in words])
    a, b = map(np.ravel, np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    got = spelling.one_apart(letters, begin, lengths, a, b)
    assert got.tolist() == [_near(words[i], words[j]) for i, j in zip(a, b)]
