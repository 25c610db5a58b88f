import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from duolex.llm import mixing, packing, queries, token_counts, tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.tokenizer_path())


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers_own(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 300)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 2000)
    encoder = tokens.WordEncoder(tokens.tokenizer_path())
    rng = random.Random(5)
    letters = "abcXYZ äÖß.,;!?'\"-_  \n\t0123éèñ’“日本́ \x1d\x85İΣςσ|<>"
    texts = [None, "", " \n", "a" * 5000, "<|endoftext|> x", "it's we'll you're. don't!! what?! (no). A.B.C. e.g., x;y", "b'll; it's."]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(1500)]
    for text, got in zip(texts, encoder.encode(pa.array(texts))):
        assert np.frombuffer(got, "<u4").tolist() == _ids(tokenizer, text), repr(text)


def test_odd_chunks_are_encoded_together(tokenizer):
    """Chunks with digits or signs go to the tokenizer in one text for all, and come back apart."""
    class Counted:
        def __init__(self, inner):
            self.inner, self.inputs = inner, 0

        def encode_batch_fast(self, texts, **options):
            self.inputs += len(texts)
            return self.inner.encode_batch_fast(texts, **options)

    rng = random.Random(3)
    chunks = ["".join(rng.choice("ab\u00e4\u00dfc'-.,0129#<|>\u00bf\u00e9\u0111") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    chunks += ["don't", "x_y", "\u4e2d", "<|endoftext|>", "...", "\u00aa", "a1."]
    texts = [" ".join(chunks[i:i + 50]) for i in range(0, len(chunks), 50)]
    encoder = tokens.WordEncoder(tokens.tokenizer_path())
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    found = list(encoder.encode(pa.array(texts)))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counted.inputs < 100


def test_best_fit_is_best_fit():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(80))]
        bins = packing.best_fit(sizes, 60)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        plain: list[list[int]] = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [b for b in plain if sum(sizes[j] for j in b) + sizes[i] <= 60]
            if fits:
                max(fits, key=lambda b: sum(sizes[j] for j in b)).append(i)
            else:
                plain.append([i])
        used = sorted(sum(sizes[i] for i in b) for b in bins)
        assert used == sorted(sum(sizes[i] for i in b) for b in plain)


def _check(rows, docs, tokenizer, length):
    want = Counter()
    for key, text in docs:
        ids = _ids(tokenizer, text) + [packing.END_ID]
        for n in range(-(-len(ids) // length)):
            cut = ids[n * length:(n + 1) * length]
            want[(key, n, n * length, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences), -(-sum(r["length"] for r in rows) // length)


def test_query_packs_whole_documents(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.all_queries()["op2_packing"](spark, small).collect()
    made, least = _check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, packing.LENGTH)
    assert made <= least * 1.02 + 1


def test_rounds_merge_what_tasks_leave(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(40)
    rows = packing.pack(docs, length=2000, items=30).collect()
    made, least = _check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 2000)
    assert made <= least * 1.1 + 2


def test_odd_documents(odd, odd_wide, empty, odd_rows, tokenizer):
    for df in (odd, odd_wide):
        _check(packing.pack(df).collect(), [r[:2] for r in odd_rows], tokenizer, packing.LENGTH)
    assert packing.pack(empty).collect() == []


def test_counts_of_odd_documents(odd_wide, empty, odd_rows, tokenizer):
    got = token_counts.count_tokens(odd_wide, ["doc_id", "source", "key"]).collect()
    assert Counter(r["tokens"] for r in got) == Counter(len(_ids(tokenizer, r[1])) for r in odd_rows)
    assert token_counts.count_tokens(empty, ["doc_id"]).count() == 0


def test_query_against_brute_force(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    first = {}
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", r)
    want = defaultdict(lambda: [0, 0])
    for text, r in first.items():
        once = "\n".join(dict.fromkeys(text.split("\n")))
        for version, n in (("word_bpe_49k", len(_ids(tokenizer, once))), ("words-1", len(once.encode().split()))):
            total = want[(r["source"], r["lang"], version)]
            total[0] += 1
            total[1] += n
    got = queries.all_queries()["op6_token_counts"](spark, small).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["documents"], r["tokens"]] for r in got} == dict(want)


def test_query_with_repeated_and_missing_ids(spark, tokenizer, tmp_path):
    twice, other = "a line\nnext line\na line\na line", "one\ntwo\none"
    rows = [(1, twice, "s", "en")] * 3 + [(2, twice, "t", "en"), (3, "plain text", "s", "en"), (3, "second text of three", "s", "en")]
    rows += [(None, other, "u", "de")] * 4 + [(None, twice, "u", "de"), (None, None, "u", "de"), (None, "", "u", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    want = defaultdict(lambda: [0, 0])
    for text, key in (("a line\nnext line", ("s", "en")), ("plain text", ("s", "en")), ("second text of three", ("s", "en")),
                      ("one\ntwo", ("u", "de")), ("", ("u", "de"))):
        for version, n in (("word_bpe_49k", len(_ids(tokenizer, text))), ("words-1", len(text.split()))):
            total = want[(*key, version)]
            total[0] += 1
            total[1] += n
    got = queries.all_queries()["op6_token_counts"](spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["documents"], r["tokens"]] for r in got} == dict(want)


def test_batches_commit_once_in_any_order(spark, tmp_path):
    kinds = "source string, lang string, tokenizer string, tokens long"
    rows = spark.createDataFrame([("a", "en", "v1", 10), ("a", "en", "v1", 10), (None, None, "v1", 5), ("b", "en", "v2", 7)], kinds)
    gone = spark.createDataFrame([("a", "en", "v1", 10), ("b", "en", "v2", 7)], kinds)
    changed = spark.createDataFrame([(None, None, "v1", 8, 5)], kinds + ", old_tokens long")
    batches = [("1", token_counts.inserts(rows)), ("2", token_counts.deletes(gone)), ("3", token_counts.revisions(changed)),
               ("4", token_counts.inserts(rows.limit(0)))]
    for order in (batches, batches[::-1]):
        rollup = token_counts.Rollup(spark, str(tmp_path / order[0][0]))
        assert rollup.totals().collect() == []
        assert all(rollup.commit(*b) for b in order)
        assert not any(rollup.commit(*b) for b in order)
        assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v1", 1, 10), (None, None, "v1", 1, 8)}
    with pytest.raises(ValueError):
        rollup.commit("a/b", rows)


def test_words_are_counted_alike(odd, odd_rows):
    got = odd.select(mixing.count_words("text").alias("n")).collect()
    assert [r["n"] for r in got] == [len((r[1] or "").encode().split()) for r in odd_rows]
