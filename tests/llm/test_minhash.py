from collections import Counter

import numpy as np
import pytest

from duolex.llm import minhash


def _brute(rows):
    """(key, n, component, kept) of (key, text) rows, by comparing all pairs of word sets."""
    sets = []
    for _, text in rows:
        words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
        sets.append({tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set())
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((top(i), top(j)))
                label[y] = x
    first, rest = {}, {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            first[top(i)] = min(key, first.get(top(i), key))
    return Counter((key, len(sets[i]), first.get(top(i)), (key == first[top(i)]) if top(i) in first else top(i) == i)
                   for i, (key, _) in enumerate(rows))


def _found(df):
    return Counter(tuple(r) for r in minhash.near_groups(df).select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_odd_rows(odd, odd_wide, odd_rows, empty):
    want = _brute([r[:2] for r in odd_rows])
    assert _found(odd) == want
    assert _found(odd_wide) == want
    assert not _found(empty)


def _family(rng, n, words, most):
    """Copies of one text with up to `most` words replaced, so that some link over others only."""
    base = [f"w{x}" for x in rng.integers(0, 10 ** 6, words)]
    out = []
    for _ in range(n):
        text = list(base)
        for at in rng.integers(0, words, rng.integers(0, most)):
            text[at] = f"x{rng.integers(0, 10 ** 6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block", [None, 3_000])
def test_families_against_brute_force(spark, monkeypatch, block):
    if block:  # buckets in several blocks, shingles counted in parts
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "POSTED", 50)
    rng = np.random.default_rng(11)
    texts = _family(rng, 150, 120, 16) + _family(rng, 40, 40, 6) + _family(rng, 30, 9, 3)
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 30)) for _ in range(60)]
    texts += texts[:20] + ["one", "ONE", "one two", "one two three", None, "", " \t"]
    rows = [(int(i) if i % 9 else None, texts[j]) for i, j in enumerate(rng.permutation(len(texts)))]
    assert _found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == _brute(rows)


def test_rows_of_one_key_are_told_apart(spark):
    texts = ["a b c d e f", "g h i j k l", "a b c d e f", "m n o p q r"]
    rows = [(7, t) for t in texts] + [(3, texts[1]), (7, texts[0])]
    assert _found(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_signature_is_circulant():
    """Coordinate k is the second permutation shifted by k, at the places of the set."""
    sets = [minhash.shingle_set(" ".join(f"w{i % 50} {i}" for i in range(n))) for n in (1, 3, 400, 40_000, 7)]
    got = minhash.signatures(sets, 12)
    for s, row in zip(sets, got):
        places = (s >> np.uint64(32)).astype(np.uint32)
        assert row.tolist() == [int(minhash._permuted(places + np.uint32(k)).min()) for k in range(12)]
    some = np.unique(minhash._permuted(np.arange(200_000, dtype=np.uint32)))
    assert len(some) == 200_000


def test_bands_find_what_links():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(200):
        n = int(rng.integers(20, 300))
        base = rng.integers(0, 2 ** 63, 2 * n, dtype=np.uint64)
        cut = int(np.ceil(n * 0.15 / 1.85 / 2 * 2)) // 2
        a, b = np.unique(base[:n]), np.unique(np.concatenate([base[cut:n], base[n:n + cut]]))
        common = len(np.intersect1d(a, b))
        if minhash.similar(common, len(a), len(b)):
            keys = minhash.band_keys(minhash.signatures([a, b]))
            missed += not (keys[0] == keys[1]).any()
    assert not missed
