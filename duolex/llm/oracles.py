"""SQL counterparts of the queries that SQL can express; DuckDB runs them on the same tables."""

from __future__ import annotations


def _unit(key: str) -> str:
    return f"((('0x' || substr(md5({key}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def _cheapest(n: int) -> str:
    costs = ", ".join(f"{{'cost': -ln({_unit(f"doc_id || ':{i}'")}), 'shard': {i}}}" for i in range(n))
    return f"list_min([{costs}]).shard::INT"


# Checksum of the polynomial 0xEDB88320, byte by byte, with its table from the rule that defines it.
_CRC_TABLE = """
    steps AS (SELECT i, i AS v, 0 AS n FROM range(256) t(i)
        UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM steps WHERE n < 8),
    crc_table AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE n = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(
            list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT),
            lambda acc, b: xor(acc >> 8, tab[xor(acc & 255, b) + 1]), 4294967295), 4294967295)"""


OP1 = f"""
WITH RECURSIVE {_CRC_TABLE},
    sums AS (SELECT doc_id, {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents, crc_table),
    rows AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, text_crc32,
            {_cheapest(8)} AS shard, {_cheapest(9)} AS grown_shard
        FROM documents JOIN sums USING (doc_id))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM rows"""

OP3 = r"""
WITH rows AS (SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
    best AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY text_sha256) AS group_size FROM rows)
SELECT a.doc_id, b.doc_id AS keep_id, a.group_size, a.place = 1 AS kept, a.text_sha256
FROM best a JOIN best b ON a.text_sha256 = b.text_sha256 AND b.place = 1"""

OP7 = rf"""
WITH sized AS (SELECT doc_id, source, text, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    rows AS (SELECT doc_id, source, size, -ln({_unit("doc_id || ':7'")}) /
            CASE WHEN (length(text) - size) / size BETWEEN 2 AND 12 THEN 1.0 ELSE 0.5 END AS k FROM sized),
    per AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM rows GROUP BY source),
    by_level AS (SELECT *, 2.0 * source_size / w AS r, 1.5 * sum(source_size) OVER () AS total FROM per),
    run AS (SELECT *, coalesce(sum(2.0 * source_size) OVER (ORDER BY r, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
        sum(w) OVER (ORDER BY r DESC, source DESC) AS open FROM by_level),
    level AS (SELECT min_by((total - used) / open, r) FILTER ((total - used) / open <= r) AS v FROM run),
    goals AS (SELECT source, source_size, least(2.0 * source_size, v * w) AS target FROM per, level),
    whole AS (SELECT *, floor(target / source_size)::INT AS epochs FROM goals),
    run_rows AS (SELECT r.*, g.source_size, g.target, g.epochs, round(g.target - g.epochs * g.source_size)::BIGINT AS rest,
        sum(size) OVER (PARTITION BY r.source ORDER BY k) - size AS before
        FROM rows r JOIN whole g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken, source, epochs
FROM run_rows"""

OP9 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS key, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    each AS (SELECT key, run, count(*) AS n FROM runs GROUP BY ALL),
    sums AS (SELECT run, n, {_crc32("key || ':' || run")} AS h FROM each, crc_table),
    cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM sums),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
    shorter AS (SELECT DISTINCT p.word AS a, w.word AS b FROM places p JOIN words w ON w.word = substr(p.word, 1, i - 1) || substr(p.word, i + 1)),
    patterns AS (SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pattern FROM places),
    near AS (SELECT a, b FROM shorter UNION SELECT b, a FROM shorter
        UNION SELECT x.word, y.word FROM patterns x JOIN patterns y ON x.pattern = y.pattern AND x.word <> y.word),
    placed AS (SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
        FROM near JOIN words w ON w.word = b),
    formed AS (SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.n >= 2 * w.n THEN p.b END AS form,
            CASE WHEN p.n >= 2 * w.n THEN p.n END AS form_n FROM words w LEFT JOIN placed p ON p.a = w.word AND p.place = 1),
    chain AS (SELECT word, word AS at FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed e ON e.word = c.at AND e.form IS NULL"""

OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
    words AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 10),
    uses AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT lang, source, coalesce(sum(uses.n), 0)::BIGINT AS total
        FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN uses USING (lang, source) GROUP BY ALL),
    langs AS (SELECT lang, sum(n)::BIGINT AS total, count(*) AS v FROM kept GROUP BY lang),
    shares AS (SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
            1 + (1000000000 * (coalesce(u.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
            1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
        FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN uses u USING (lang, source, term)),
    gaps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source),
    parts AS (SELECT * FROM pairs
        UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


OP13 = rf"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
        list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM split),
    sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
    each AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM each a JOIN each b
        ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 85 * (p.n + q.n - c)),
    reach AS (SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n"""


def all_oracles() -> dict[str, str]:
    return {"op1_sharding": OP1, "op3_exact_dedup": OP3, "op7_mixing": OP7, "op9_topk": OP9, "op11_spelling": OP11, "op12_divergence": OP12,
            "op13_minhash": OP13}
