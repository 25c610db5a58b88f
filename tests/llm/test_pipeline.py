import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from duolex.llm import exact_dedup, mixing, simhash, toxicity
from duolex.llm.common import repeat_rows, row_mark


def test_stages_one_after_another(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in before}
            break
        assert out.columns == columns
        after = out.collect()
        assert set(after) <= set(before) and after
        if name == "exact dedup":
            shas = [r["text_sha256"] for r in exact_dedup.find_copies(out).collect()]
            assert len(shas) == len(set(shas)) == len({r["text_sha256"] for r in exact_dedup.find_copies(docs).collect()})
        if name == "near dedup":
            groups = [r["component_id"] for r in simhash.near_groups(docs).collect()]
            assert sorted(r["doc_id"] for r in after) == sorted(set(groups))
        if name == "mixing":
            words = sum(len((r["text"] or "").split()) for r in after)
            assert 1.3 < words / sum(len((r["text"] or "").split()) for r in before) < 1.7
        before, docs = after, out


@pytest.mark.parametrize("most", [None, 1])
def test_repeat_rows(odd_wide, most):
    rows = odd_wide.collect()
    marked = odd_wide.select("doc_id", row_mark(odd_wide).alias("_mark"), F.expr("cast(if(doc_id in (1, 7) or text like 'another%', 2, if(doc_id = 9, 0, 1)) as int)").alias("copies"))
    got = repeat_rows(odd_wide, marked, most=most)
    assert got.columns == odd_wide.columns
    found = [(r["doc_id"], r["text"]) for r in got.collect()]
    want = {(r["doc_id"], r["text"]): 0 if r["doc_id"] == 9 else 1 for r in rows}
    want[(1, "the same text here")] = 2 if most is None else 1
    want[(7, "the same text here")] = 4 if most is None else 1
    want[(None, "no id here")] = 2  # two rows of different columns
    want[(None, "another without id")] = 2 if most is None else 1
    assert {k: found.count(k) for k in want} == want and len(found) == sum(want.values())


# Rows that share key and text but not the other columns, and rows that share all.
_TWINS = [(1, "some words of a text that stays", "en", "a", 1), (1, "some words of a text that stays", "fr", "b", 1),
          (2, "another text altogether, with words", "en", None, 2), (2, "another text altogether, with words", None, "en", 2),
          (None, "a text without id is a row too", "en", "a", 3), (None, "a text without id is a row too", "de", "a", 3),
          (3, "told twice in all columns", "en", "a", 4), (3, "told twice in all columns", "en", "a", 4), (4, None, "en", "a", 0), (4, "", "en", "a", 0)]


def test_stages_keep_rows_apart(spark, odd_wide):
    """Every row out is a row that came in, as often at the most (a mix apart), and the right number of them."""
    wide = odd_wide.limit(0).columns[5:]
    rows = [(*r, *[f"c{i % 3}" for _ in wide]) for i, r in enumerate(_TWINS * 2)]
    df = spark.createDataFrame(rows, odd_wide.schema).repartition(3)
    before = Counter(tuple(r) for r in df.collect())
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")

    def after(out):
        assert out.columns == df.columns
        return Counter(tuple(r) for r in out.collect())

    assert after(toxicity.drop_toxic(df, labels)) == before
    texts = {"".join((r[1] or "").split()) for r in rows}
    for drop in (exact_dedup.drop_copies, simhash.drop_near_copies):
        kept = after(drop(df))
        assert kept <= before and Counter("".join((r[1] or "").split()) for r in kept.elements()) == Counter(texts)
    taken = mixing.mix(mixing.sized_rows(df), whole=True).collect()
    want = Counter()
    for r in taken:
        want[r["key"], r["source"], r["size"]] += r["taken"] // r["size"] if r["size"] else 1
    mixed = after(mixing.mix_documents(df))
    assert set(mixed) <= set(before)
    got = Counter()
    for r in mixed.elements():
        got[r[0], r[3], len((r[1] or "").split())] += 1
    assert got == +want


def _targets(sizes, weights=(5.0, 2.0, 1.0)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: fixed.get(s, level * weight[s]) for s in order}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def _mixed(rows):
    """Copies of each row, by sorting each source as a whole."""
    by_source, copies = defaultdict(list), [1] * len(rows)
    for i, r in enumerate(rows):
        by_source[r[3]].append(i)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    targets = _targets({s: sum(size[i] for i in m) for s, m in by_source.items()})
    for source, members in by_source.items():
        whole = sum(size[i] for i in members)
        epochs = int(targets[source] // whole) if whole else 0
        left = round(targets[source] - epochs * whole)

        def draw(i):
            u = (int(hashlib.md5(f"{rows[i][0]}:7".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            mean = (len(rows[i][1] or "") - size[i]) / size[i] if size[i] else 0
            return -math.log(u) / (1.0 if 2 <= mean <= 12 else 0.5)

        for i in sorted((i for i in members if size[i]), key=draw):
            copies[i] = epochs + (left >= size[i] or left > 0 and 2 * left >= size[i])
            left -= size[i]
    return copies


def test_run_against_brute_force(spark, small, tmp_path, odd_rows):
    """All stages by hand on odd rows, given which rows the fitted scorer rejects."""
    table = spark.read.parquet(f"{small}/documents.parquet")
    taken = {r["doc_id"] for r in table.select("doc_id").collect()}
    rng = np.random.default_rng(0)
    rows, new = [tuple(r) for r in table.collect()][:120], 10 ** 6
    rows += [(new + i, t, lang, source, n) for i, (_, t, lang, source, n) in enumerate(odd_rows)]
    for i in rng.integers(0, 120, 25):  # copies, and near ones of long texts
        words = rows[i][1].split()
        if len(words) > 300:
            words[150] = "changed"
        rows.append((new + len(rows), "  ".join(words), "en", rows[i][3], 0))
    assert not taken & {r[0] for r in rows[120:]}
    folder = str(tmp_path)
    spark.createDataFrame(rows, table.schema).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.fit_and_score(docs, labels).filter("predicted = 1").collect()}
    left = [r for r in rows if r[0] not in toxic]
    best = {}
    for r in left:
        text = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        best[text] = min(best.get(text, r), r, key=lambda x: (-len(x[1] or ""), x[0]))
    left = list(best.values())
    fps = [simhash.fingerprint(r[1]) for r in left]
    near = np.bitwise_count(np.array(fps, np.int64).view(np.uint64)[:, None] ^ np.array(fps, np.int64).view(np.uint64)) <= 3
    group = list(range(len(left)))
    for _ in left:
        group = [min(group[j] for j in np.flatnonzero(near[i])) for i in range(len(left))]
    firsts = {g: min(left[i][0] for i in range(len(left)) if group[i] == g) for g in set(group)}
    left = [r for i, r in enumerate(left) if r[0] == firsts[group[i]]]
    assert len(left) < len(best) < len(rows)
    want, copies = Counter(), _mixed(left)
    encode = Tokenizer.from_file(_tokenizer()).encode
    for r, n in zip(left, copies):
        ids = np.array([*encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            want[r[0], piece, start, len(part), zlib.crc32(part.tobytes())] += n
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == +want
    full = defaultdict(list)
    for r in found:
        full[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in full.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def _tokenizer():
    from duolex.llm.tokens import tokenizer_path
    return tokenizer_path()
