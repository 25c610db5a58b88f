"""SQL counterparts of the queries, for an independent engine on the same tables."""

from __future__ import annotations

from duolex.sources.derived import PLANTED_COEFFICIENTS, PLANTED_INTERCEPT

# Fixed values, written out here so that a wrong one in the engine shows.
WHITESPACE = r"\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MISSING_TOKEN = "[[[@@@MISSING_TRANSLATION@@@]]]"
SUPPORTED_LANGS = ["en", "lv", "de", "cs", "lt", "hu", "it", "sv", "el", "es", "fi", "fr"]

_WS = f"[{WHITESPACE}]+"
_MARK = "chr(9601)"

# -- shared table expressions -------------------------------------------------

_BASE = """
seg AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS s,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
base AS (SELECT a.doc_id, a.pos, a.source AS File, a.s AS t1, CASE WHEN trim(b.s) <> '' THEN b.s END AS t2,
                a.lang AS l1, coalesce(n.lang, a.lang) AS l2, (a.doc_id * 7 + a.pos) % 20 AS m
         FROM seg a LEFT JOIN documents n ON n.doc_id = a.doc_id + 1
         LEFT JOIN seg b ON b.doc_id = a.doc_id + 1 AND b.pos = a.pos WHERE trim(a.s) <> '')"""

_PAIRS = _BASE + """,
pairs AS (SELECT (doc_id * 1048576 + pos) * 2 + c.copy AS row_id, File || '_' || l1 || '_' || l2 AS Filename, File,
                 CASE WHEN m IN (1, 3) THEN 'SERIES TITLE: ' || t1 WHEN m = 4 THEN t2
                      WHEN m = 5 THEN t1 || chr(10) ELSE t1 END AS Tr1,
                 CASE WHEN m IN (0, 4) THEN t1 WHEN m IN (2, 3) THEN 'Original language summary: ' || t2
                      ELSE t2 END AS Tr2, l1 AS Lang1, l2 AS Lang2
          FROM base, (VALUES (0), (1)) c(copy) WHERE c.copy = 0 OR m = 6)"""

_LINES = """
raw_lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM (
                SELECT text FROM benchmark UNION ALL
                SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))),
test_lines AS (SELECT DISTINCT trim(line, ' ') AS line FROM raw_lines WHERE line <> '')"""

_TRANSLATIONS = _BASE + """,
translations AS (SELECT doc_id * 1048576 + pos AS row_id, t1 AS source,
    CASE WHEN doc_id % 2 = 1 THEN t2 ELSE array_to_string(
        list_filter(string_split(t1, ' '), lambda x, i: (i - 1) % 5 <> 4), ' ') END AS translation FROM base)"""


def _tokens(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{_WS}'), lambda x: x <> '')"


def _words(c: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'))"


# Each text keeps the characters of both as one byte each, since the built-in distance counts bytes.
_CER = """
cer_in AS (SELECT row_id, source, translation,
                  list_distinct(string_split(source || translation, '')) AS chars FROM translations),
cer_map AS (SELECT *, array_to_string(chars, '') AS old,
                   array_to_string(list_transform(range(1, len(chars) + 1), lambda i: chr(i::INT)), '') AS new FROM cer_in),
cers AS (SELECT row_id, levenshtein(translate(source, old, new), translate(translation, old, new)) * 100.0
                        / nullif(length(source), 0) AS cer FROM cer_map)"""

# Only shared tokens can match, so few of them fit one byte each; else the table is built row by row.
_WER = f"""
wer_raw AS (SELECT row_id, {_tokens('source')} AS a, {_tokens('translation')} AS b FROM translations),
wer_in AS (SELECT *, list_distinct(list_intersect(a, b)) AS shared FROM wer_raw),
wers AS (SELECT row_id, len(a) AS n, CASE WHEN len(shared) <= 120 THEN levenshtein(
            array_to_string(list_transform(a, lambda x: chr(CASE WHEN list_contains(shared, x)
                            THEN list_position(shared, x)::INT + 2 ELSE 1 END)), ''),
            array_to_string(list_transform(b, lambda x: chr(CASE WHEN list_contains(shared, x)
                            THEN list_position(shared, x)::INT + 2 ELSE 2 END)), ''))
         ELSE list_reduce(a, lambda above, w, i: list_reduce(b,
            lambda acc, v, j: list_append(acc, least(acc[-1] + 1, above[j + 1] + 1,
                                                     above[j] + CASE WHEN v = w THEN 0 ELSE 1 END)),
            [i::BIGINT]), range(0, len(b) + 1)) [-1] END AS edits FROM wer_in)"""

_F_MEASURE = f"""
f_in AS (SELECT row_id, {_words('source')} AS a, {_words('translation')} AS b FROM translations),
fs AS (SELECT row_id, CASE WHEN len(a) > 0 AND len(b) > 0 THEN
              len(list_intersect(a, b)) * 200.0 / (len(a) + len(b)) END AS f_score FROM f_in)"""

_FEATURES = f"{_TRANSLATIONS}, {_CER}, {_WER}, {_F_MEASURE}" + """,
feats AS (SELECT t.row_id, t.source, w.edits * 100.0 / nullif(w.n, 0) AS wer, c.cer, f.f_score
          FROM translations t JOIN wers w USING (row_id) JOIN cers c USING (row_id) JOIN fs f USING (row_id))"""

_TERM_SQL = {
    "wer": "wer", "cer": "cer", "f_score": "f_score", "wer_wer": "wer * wer", "wer_cer": "wer * cer",
    "wer_f_score": "wer * f_score", "cer_cer": "cer * cer", "cer_f_score": "cer * f_score",
    "f_score_f_score": "f_score * f_score",
}
_PLANTED = " + ".join(
    [str(PLANTED_INTERCEPT)] + [f"({k}::DOUBLE) * ({t})" for k, t in zip(PLANTED_COEFFICIENTS, _TERM_SQL.values())])
_SCORED = _FEATURES + f""",
scored AS (SELECT *, {_PLANTED} + (row_id * 37 % 101 - 50) / 25.0 AS planted, (row_id % 7 - 3) / 4.0 AS noise FROM feats)"""

# Two of three documents train the evaluated model; row ids hold the document above 20 bits of place.
_TRAIN = "(row_id >> 20) % 3 <> 0"


def _fit(rows: str) -> str:
    """Least squares by the normal equations: moments about the means, then elimination, one row of it a step."""
    names = list(_TERM_SQL)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ("wer", "cer", "f_score"))
    terms = ", ".join(f"{sql} AS {name}" for name, sql in _TERM_SQL.items())
    matrix = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in [*names, "label"]) + "]" for a in names)
    means = ", ".join(f"avg({n})" for n in names)
    listed = ", ".join(f"'{n}'" for n in names)
    # Features are taken in hundreds, as the moments of their squares are far apart else.
    scales = ", ".join("100.0" if "_" not in n.replace("f_score", "f") else "10000.0" for n in names)
    return f"""
fit_in AS (SELECT wer / 100 AS wer, cer / 100 AS cer, f_score / 100 AS f_score, planted AS label FROM scored WHERE {whole} AND {rows}),
fit_terms AS MATERIALIZED (SELECT {terms}, label FROM fit_in),
moments AS (SELECT [{matrix}] AS m, [{means}] AS means, avg(label) AS mean FROM fit_terms),
steps AS (SELECT 1 AS k, m FROM moments UNION ALL
    SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
        ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM steps WHERE k <= {len(names)}),
solved AS (SELECT list_transform(m, lambda r: r[{len(names) + 1}]) AS w FROM steps WHERE k = {len(names) + 1}),
fitted AS (SELECT unnest([{listed}]) AS term, unnest(list_transform(w, lambda v, i: v / [{scales}][i])) AS weight FROM solved
    UNION ALL SELECT 'intercept', mean - list_inner_product(w, means) FROM solved, moments)"""


_PREDICTED = "predicted AS (SELECT s.*, (SELECT weight FROM fitted WHERE term = 'intercept') + " + " + ".join(
    f"(SELECT weight FROM fitted WHERE term = '{n}') * ({sql})" for n, sql in _TERM_SQL.items()) + " AS prediction FROM scored s)"

_PROFILES = """
grams AS (SELECT lang, substring(t, i::INT, 3) AS gram, count(*) AS n FROM (
            SELECT lang, lower(text) AS t, unnest(range(1, length(text) - 1)) AS i FROM documents) GROUP BY ALL),
masses AS (SELECT lang, sum(n) + (SELECT count(DISTINCT gram) FROM grams) AS mass FROM grams GROUP BY lang),
profiles AS (SELECT lang, gram, n, round(ln((n + 1)::DOUBLE / mass) * 1000000)::BIGINT AS weight,
                    round(ln(1.0::DOUBLE / mass) * 1000000)::BIGINT AS unseen FROM grams JOIN masses USING (lang)),
langs AS (SELECT lang, max(unseen) AS unseen FROM profiles GROUP BY lang)"""


def _found(rows: str) -> str:
    """Languages of the two sides of `rows(id, Tr1, Tr2)` as `found(id, found1, found2)`."""
    return f"""
sides AS (SELECT id, 1 AS side, lower(Tr1) AS t FROM {rows} UNION ALL SELECT id, 2, lower(Tr2) FROM {rows}),
side_grams AS (SELECT id, side, substring(t, i::INT, 3) AS gram FROM (
                 SELECT id, side, t, unnest(range(1, length(t) - 1)) AS i FROM sides)),
gains AS (SELECT id, side, lang, sum(weight - unseen) AS gain FROM side_grams JOIN profiles USING (gram) GROUP BY ALL),
side_n AS (SELECT id, side, CASE WHEN t IS NOT NULL THEN greatest(length(t) - 2, 0) END AS n FROM sides),
totals AS (SELECT s.id, s.side, l.lang, s.n * l.unseen + coalesce(g.gain, 0) AS total
           FROM side_n s CROSS JOIN langs l
           LEFT JOIN gains g ON g.id = s.id AND g.side = s.side AND g.lang = l.lang),
best AS (SELECT id, side, CASE WHEN max(total) IS NOT NULL THEN first(lang ORDER BY total DESC, lang) END AS lang
         FROM totals GROUP BY id, side),
found AS (SELECT a.id, a.lang AS found1, b.lang AS found2 FROM best a JOIN best b ON a.id = b.id
          WHERE a.side = 1 AND b.side = 2)"""


_L = ", ".join(f"'{x}'" for x in SUPPORTED_LANGS)
_VERDICT = f"""CASE
  WHEN Lang1 IN ({_L}) AND Lang2 IN ({_L}) THEN
    CASE WHEN found1 = Lang2 AND found2 = Lang1 THEN 'swap'
         WHEN coalesce(found1 <> Lang1 OR found2 <> Lang2, true) THEN 'delete' ELSE 'keep' END
  WHEN Lang1 IN ({_L}) THEN
    CASE WHEN found1 = Lang2 THEN 'swap' WHEN coalesce(found1 <> Lang1, true) THEN 'delete' ELSE 'keep' END
  WHEN Lang2 IN ({_L}) THEN
    CASE WHEN found2 = Lang1 THEN 'swap' WHEN coalesce(found1 <> Lang1 OR found2 <> Lang2, true) THEN 'delete' ELSE 'keep' END
  ELSE 'keep' END"""


def _clean(side: int, tr1: str = "Tr1", tr2: str = "Tr2") -> str:
    one, two = f"replace(coalesce({tr1}, 'nan'), chr(10), '')", f"replace(coalesce({tr2}, 'nan'), chr(10), '')"
    if side == 1:
        return f"CASE WHEN contains({one}, 'SERIES TITLE') THEN replace({one}, 'SERIES TITLE: ', '') ELSE {one} END"
    return (f"CASE WHEN NOT contains({one}, 'SERIES TITLE') AND contains({two}, 'Original language summary') "
            f"THEN replace({two}, 'Original language summary: ', '') ELSE {two} END")


def _ratio(a: str, b: str) -> str:
    return (f"CASE WHEN length({a}) * 3 <= length({b}) OR length({b}) * 3 <= length({a}) THEN 'Delete' "
            f"WHEN length({a}) * 2 <= length({b}) OR length({b}) * 2 <= length({a}) THEN 'Check' ELSE 'Ok' END")


def _sentences(c: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({c}, '[^.!?]*[.!?]+|[^.!?]+'), "
            f"lambda x: trim(x, ' ')), lambda x: x <> '')")


def _long(a: str, b: str) -> str:
    return f"(len(string_split({a}, ' ')) >= 40 OR len(string_split({b}, ' ')) >= 40)"


_EQUAL = "lower(coalesce(Tr1, 'nan')) = lower(coalesce(Tr2, 'nan'))"

_STEP1 = f"""
s1 AS (SELECT *, {_EQUAL} AS is_equal,
              row_number() OVER (PARTITION BY Filename, Tr1, Tr2, {_EQUAL} ORDER BY row_id) AS rn FROM pairs)"""

_AUDIT = f"{_PAIRS}, {_PROFILES}, {_STEP1}" + f""",
s2 AS (SELECT *, CASE WHEN is_equal THEN 'equal' WHEN rn > 1 THEN 'duplicate' END AS r1,
              {_clean(1)} AS c1, {_clean(2)} AS c2 FROM s1),
s3 AS (SELECT *, CASE WHEN r1 IS NOT NULL THEN r1 WHEN {_ratio('c1', 'c2')} = 'Ok' THEN NULL
                      ELSE 'ratio_' || lower({_ratio('c1', 'c2')}) END AS r3 FROM s2),
first_lang AS (SELECT Filename, arg_min(Lang1, row_id) AS f1, arg_min(Lang2, row_id) AS f2
               FROM s3 WHERE r3 IS NULL GROUP BY Filename),
s4 AS (SELECT s3.*, CASE WHEN r3 IS NULL AND {_long('c1', 'c2')} THEN {_sentences('c1')} ELSE [c1] END AS a,
              CASE WHEN r3 IS NULL AND {_long('c1', 'c2')} THEN {_sentences('c2')} ELSE [c2] END AS b FROM s3),
s5 AS (SELECT *, CASE WHEN r3 IS NULL AND (len(a) <> len(b) OR len(a) = 0) THEN 'sentence_count' ELSE r3 END AS r4
       FROM s4),
s6 AS (SELECT Filename, row_id, 0 AS sent_no, File, CASE WHEN r1 IS NULL THEN c1 ELSE Tr1 END AS Tr1,
              CASE WHEN r1 IS NULL THEN c2 ELSE Tr2 END AS Tr2,
              CASE WHEN r3 IS NULL THEN f1 ELSE Lang1 END AS Lang1, CASE WHEN r3 IS NULL THEN f2 ELSE Lang2 END AS Lang2,
              CASE WHEN r4 = 'sentence_count' THEN 4 WHEN r1 IS NOT NULL THEN 1 ELSE 3 END AS stage, r4 AS reason
       FROM s5 LEFT JOIN first_lang USING (Filename) WHERE r4 IS NOT NULL
       UNION ALL
       SELECT Filename, row_id, sent_no, File, x, y, f1, f2, CASE WHEN label <> 'Ok' THEN 5 END,
              CASE WHEN label <> 'Ok' THEN 'ratio_' || lower(label) END
       FROM (SELECT *, {_ratio('x', 'y')} AS label FROM (
               SELECT Filename, row_id, File, f1, f2, unnest(a) AS x, unnest(b) AS y,
                      generate_subscripts(a, 1) - 1 AS sent_no
               FROM s5 JOIN first_lang USING (Filename) WHERE r4 IS NULL))),
live AS (SELECT row_id * 4096 + sent_no AS id, Tr1, Tr2 FROM s6 WHERE reason IS NULL),
{_found('live')},
s7 AS (SELECT s6.*, CASE WHEN reason IS NULL THEN {_VERDICT} END AS verdict
       FROM s6 LEFT JOIN found ON found.id = s6.row_id * 4096 + s6.sent_no AND s6.reason IS NULL),
s8 AS (SELECT Filename, row_id, sent_no, File, CASE WHEN verdict = 'swap' THEN Tr2 ELSE Tr1 END AS Tr1,
              CASE WHEN verdict = 'swap' THEN Tr1 ELSE Tr2 END AS Tr2,
              CASE WHEN verdict = 'swap' THEN Lang2 ELSE Lang1 END AS Lang1,
              CASE WHEN verdict = 'swap' THEN Lang1 ELSE Lang2 END AS Lang2,
              CASE WHEN verdict = 'delete' THEN 6 ELSE stage END AS drop_stage,
              CASE WHEN verdict = 'delete' THEN 'language' ELSE reason END AS reason,
              CASE WHEN verdict = 'swap' THEN 1 ELSE 0 END AS inverted FROM s7),
audit AS (SELECT *, CASE WHEN drop_stage IS NULL THEN 'final' WHEN reason = 'ratio_check' THEN 'to_check'
                         ELSE 'to_delete' END AS route FROM s8)"""

_DOC_TEXT = f"trim(regexp_replace(text, '{_WS}', ' ', 'g'), ' ')"
_MARKED = f"CASE WHEN {_DOC_TEXT} = '' THEN '' ELSE {_MARK} || replace({_DOC_TEXT}, ' ', ' ' || {_MARK}) END"
_MARKED_WORDS = f"SELECT w FROM (SELECT unnest(string_split({_MARKED}, ' ')) AS w FROM documents) WHERE w <> ''"


def _vocabulary(counts: str, room: int) -> str:
    return f"""WITH counts AS ({counts}), total AS (SELECT sum(n) AS t FROM counts),
kept AS (SELECT piece, ln(n::DOUBLE / (SELECT t FROM total)) AS score FROM counts ORDER BY n DESC, piece LIMIT {room})
SELECT * FROM (VALUES ('<unk>', 0.0::DOUBLE, 0), ('<s>', 0.0::DOUBLE, 1), ('</s>', 0.0::DOUBLE, 2)) v(piece, score, id)
UNION ALL SELECT piece, round(score, 6), (row_number() OVER (ORDER BY score DESC, piece) + 2)::INT FROM kept"""


_DOUBLED = "|".join(f"{c}{c}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _spanish(c: str) -> str:
    return (f"regexp_replace({c}, '({_DOUBLED})[.{WHITESPACE}]{{0,2}}[A-Z]([A-Z])\\.?', "
            f"'\\1.' || chr(160) || '\\2\\2.', 'g')")


def _english(c: str) -> str:
    parts = f"regexp_extract_all({c}, '[^ ,;:.{{}}\\[\\]/\\\\()?¡\"'']+|[ ,;:.{{}}\\[\\]/\\\\()?¡\"'']')"
    return (f"array_to_string(list_transform({parts}, lambda x: CASE x WHEN 'thru' THEN 'through' "
            f"WHEN 'throught' THEN 'through' WHEN 'nite' THEN 'night' ELSE x END), '')")


def _capitals(c: str) -> str:
    return f"translate({c}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _informal(c: str) -> str:
    return f"replace(replace({c}, ' the ', ' thru '), ' of', ' nite')"


_TAGGED = "NULL::INT AS drop_stage, NULL::VARCHAR AS reason"
_SEGMENTS = "(SELECT row_id, Tr1 AS src, Tr2 AS tgt FROM pairs)"
_VALID = (f"NOT coalesce((len(string_split(src, ' ')) >= 5 OR src = '{MISSING_TOKEN}') AND lower(src) = lower(tgt), false)")
_STRIPPED = "trim(src, chr(10))"

_TRAINING = f"""
sized AS (SELECT row_id, greatest(len({_tokens('src')}), len({_tokens('tgt')})) AS n_tokens FROM {_SEGMENTS}),
sharded AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // 1000 AS shard FROM sized),
training AS (SELECT row_id, shard, n_tokens, greatest(sum(n_tokens) OVER (PARTITION BY shard
             ORDER BY n_tokens, row_id ROWS UNBOUNDED PRECEDING) - 1, 0)::BIGINT // 4096 AS batch_id FROM sharded)"""



def _greedy(rows: str, group: str, order: str) -> str:
    """Batches of `rows`(row_id, n_tokens, ...): each begins where the one before would pass 4,096 tokens."""
    return f"""
placed AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS place, coalesce(sum(n_tokens) OVER w, 0)::BIGINT AS upto
           FROM {rows} WINDOW w AS (PARTITION BY {group} ORDER BY {order} ROWS UNBOUNDED PRECEDING)),
reached AS (SELECT {group} AS g, upto, min(place) AS place FROM placed GROUP BY ALL),
follows AS MATERIALIZED (SELECT p.{group} AS g, p.place, greatest(p.place + 1, r.place) AS next
            FROM placed p ASOF JOIN reached r ON r.g = p.{group} AND r.upto >= p.upto - coalesce(p.n_tokens, 0) + 4097),
borders AS (SELECT DISTINCT {group} AS g, 0::BIGINT AS place, 0::BIGINT AS batch_id FROM placed
            UNION ALL SELECT b.g, f.next, b.batch_id + 1 FROM borders b JOIN follows f ON f.g = b.g AND f.place = b.place),
greedy AS (SELECT p.*, b.batch_id FROM placed p ASOF JOIN borders b ON b.g = p.{group} AND p.place >= b.place)"""


# Abbreviations per language and the sentences that they leave whole.
_WIDE = "。！？｡"
_CLOSE = "\"'')\\]»”’」』）"
_STOP = ".!?؟۔।॥…"
_DOTTED = r"'^[^\p{L}\p{N}]*(\p{L}+(?:\.\p{L}+)*)(\.?)[ \t\n\r]*$'"
_ABBREVIATIONS = f"""
toks AS MATERIALIZED (SELECT doc_id, lang, regexp_extract_all(regexp_replace(text, '([{_WIDE}][{_WIDE}{_CLOSE}]*)', '\\1 ', 'g'),
                                                 '[^ \\t\\n\\r]+[ \\t\\n\\r]*') AS t FROM documents),
words AS (SELECT lang, lower(regexp_extract(x, {_DOTTED}, 1)) AS token, regexp_extract(x, {_DOTTED}, 2) AS dot
          FROM (SELECT lang, unnest(t) AS x FROM toks)),
counts AS (SELECT lang, token, count(*) AS n, count(*) FILTER (dot = '.') AS dotted FROM words WHERE token <> '' GROUP BY ALL),
shares AS (SELECT lang, sum(dotted)::DOUBLE / sum(n) AS p FROM counts GROUP BY lang),
parts AS (SELECT c.*, p, n - dotted AS bare, length(token) - length(replace(token, '.', '')) AS stops,
                 length(replace(token, '.', '')) AS letters FROM counts c JOIN shares s ON s.lang IS NOT DISTINCT FROM c.lang),
scored AS (SELECT lang, token, n, dotted, 2 * (dotted * (ln(0.99::DOUBLE) - ln(p)) + bare * (ln(0.01::DOUBLE) - ln(1 - p)))
                  * exp(-letters) * (stops + 1) * power(letters::DOUBLE, -bare) AS score FROM parts WHERE dotted > 0),
abbr AS MATERIALIZED (SELECT * FROM scored WHERE score >= 0.3)"""
_BY_LANGUAGE = f"""
lists AS (SELECT lang, list(token) AS known FROM abbr GROUP BY lang),
split AS (SELECT doc_id, t, coalesce(known, []) AS known FROM toks LEFT JOIN lists ON lists.lang IS NOT DISTINCT FROM toks.lang),
ended AS (SELECT doc_id, t, list_filter(range(1, len(t) + 1), lambda i: i = len(t) OR (
            regexp_matches(t[i], '(?:[{_STOP}][{_STOP}{_CLOSE}]*|[{_WIDE}][{_WIDE}{_CLOSE}]*)[ \\t\\n\\r]*$')
            AND NOT (regexp_extract(t[i], {_DOTTED}, 2) = '.' AND list_contains(known, lower(regexp_extract(t[i], {_DOTTED}, 1)))))) AS e
          FROM split),
sentences AS (SELECT doc_id, list_transform(e, lambda x, i: trim(array_to_string(
            t[CASE WHEN i = 1 THEN 1 ELSE e[i - 1] + 1 END:x], ''), chr(32) || chr(9) || chr(10) || chr(13))) AS s FROM ended)"""

_PHRASES = """
phrases AS (SELECT DISTINCT w AS token, '<' || w || '>' AS replacement FROM (
              SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM benchmark))"""

# One row per output place of each segment; unknown places read the source place they attend to.
# A missing source is an empty one.
_PLACES = """
places AS (SELECT row_id, src, i, string_split(src, ' ')[i + 1] AS own, string_split(src, ' ')[i % 8 + 1] AS seen
           FROM (SELECT row_id, src, unnest(range(0, len(string_split(src, ' ')))) AS i
                 FROM (SELECT row_id, coalesce(Tr1, '') AS src FROM pairs)))"""


def merges_sql(size: int, percent: int = 90, look: int = 4000) -> str:
    """Merge rounds over the distinct words: row 0 of the recursion holds the pieces so far, the others the words."""
    return f"""WITH RECURSIVE counted AS (SELECT w, count(*) AS n FROM ({_MARKED_WORDS}) GROUP BY w),
        words AS (SELECT row_number() OVER () AS id, list_filter(string_split(w, ''), lambda x: x <> '') AS pieces, n FROM counted),
        alphabet AS (SELECT c AS piece, sum(n) AS n FROM (SELECT unnest(pieces) AS c, n FROM words) GROUP BY c),
        rec(id, pieces, n) USING KEY (id) AS (
            SELECT id, pieces, n::BIGINT FROM words
            UNION ALL SELECT 0, []::VARCHAR[], ({size} - 3 - (SELECT count(*) FROM alphabet))::BIGINT
            UNION (
            WITH pairs AS (SELECT p[1] AS a, p[2] AS b, sum(n) AS n FROM (
                    SELECT unnest(list_transform(range(1, len(pieces)), lambda i: [pieces[i], pieces[i + 1]])) AS p, n
                    FROM recurring.rec WHERE id > 0) GROUP BY ALL),
                ranked AS (SELECT a, b, n, row_number() OVER (ORDER BY n DESC, a, b) AS place FROM pairs QUALIFY place <= {look}),
                band AS (SELECT a, b, place FROM ranked WHERE 100 * n >= {percent} * (SELECT max(n) FROM ranked)),
                ended AS (SELECT b AS piece, min(place) AS place FROM band GROUP BY b),
                begun AS (SELECT a AS piece, min(place) AS place FROM band GROUP BY a),
                taken AS (SELECT a, b, band.place FROM band LEFT JOIN ended ON ended.piece = a LEFT JOIN begun ON begun.piece = b
                    WHERE coalesce(ended.place, band.place) >= band.place AND coalesce(begun.place, band.place) >= band.place),
                marks AS (SELECT list(a || ' ' || b) AS marks FROM taken),
                fresh AS (SELECT list(piece ORDER BY place) AS made FROM (SELECT a || b AS piece, min(place) AS place FROM taken GROUP BY ALL)),
                control AS (SELECT pieces AS done, n AS room FROM recurring.rec WHERE id = 0)
            SELECT id, list_transform(list_reduce(list_transform(pieces, lambda x: [x]), lambda acc, x:
                    CASE WHEN list_contains(marks, acc[-1] || ' ' || x[1]) THEN acc[:-2] || [chr(1) || acc[-1] || x[1]] ELSE acc || x END),
                    lambda x: replace(x, chr(1), '')), n
                FROM recurring.rec, marks, control
                WHERE id > 0 AND len(done) < room AND list_has_any(list_transform(range(1, len(pieces)), lambda i: pieces[i] || ' ' || pieces[i + 1]), marks)
            UNION ALL SELECT 0, done || list_filter(made, lambda x: NOT list_contains(done, x)), room
                FROM control, fresh WHERE len(done) < room AND len(made) > 0)),
        merged AS (SELECT unnest(pieces[1:n]) AS piece, -(unnest(range(0, least(n, len(pieces)))))::DOUBLE AS score FROM rec WHERE id = 0),
        singles AS (SELECT piece, -(SELECT count(*) FROM merged)::DOUBLE - row_number() OVER (ORDER BY n DESC, piece) + 1 AS score FROM alphabet),
        fixed AS (SELECT unnest(['<unk>', '<s>', '</s>']) AS piece, unnest([0, 1, 2]) AS id)
        SELECT piece, 0.0::DOUBLE AS score, id::INT AS id FROM fixed
        UNION ALL SELECT piece, score, (row_number() OVER (ORDER BY score DESC, piece) + 2)::INT
            FROM (SELECT * FROM merged UNION ALL SELECT * FROM singles)"""


def all_oracles() -> dict[str, str]:
    """Query name to SQL. Queries without an entry are checked in the tests only."""
    p = f"WITH {_PAIRS}"
    out: dict[str, str] = {}

    out["src_corpus_tsv"] = f"{p} SELECT File, Tr1, Tr2, Lang1, Lang2 FROM pairs"
    out["src_scored_tsv"] = f"""WITH {_TRANSLATIONS} SELECT source, translation,
        (length(source) * 0.5)::DOUBLE AS "evaluator1 scores",
        (length(translation) * 0.25)::DOUBLE AS "evaluator2 scores" FROM translations"""
    out["src_test_lines"] = """SELECT DISTINCT trim(line, ' ') AS line FROM (
        SELECT unnest(string_split(text, chr(10))) AS line FROM (
            SELECT text FROM benchmark UNION ALL SELECT text FROM documents)) WHERE line <> ''"""
    out["sink_routed_layout"] = f"""WITH {_AUDIT},
        routed AS (SELECT route, Filename, Lang1, Lang2, reason FROM audit
                   UNION ALL SELECT 'to_check', Filename, Lang2, Lang1, 'inverted' FROM audit
                   WHERE drop_stage IS NULL AND inverted = 1)
        SELECT route, Filename, Lang1, Lang2, reason, count(*) AS n FROM routed GROUP BY ALL"""
    out["sink_routed_clustered"] = f"""WITH {_AUDIT}
        SELECT route, Filename, Lang1, Lang2, row_id, sent_no, Tr1, Tr2, reason FROM audit WHERE route <> 'to_delete'
        UNION ALL SELECT 'to_check', Filename, Lang2, Lang1, row_id, sent_no, Tr2, Tr1, 'inverted' FROM audit
        WHERE drop_stage IS NULL AND inverted = 1"""
    out["sink_training_shards"] = f"""{p}, {_TRAINING}
        SELECT shard, batch_id, count(*) AS n, sum(n_tokens)::BIGINT AS tokens FROM training GROUP BY ALL"""

    out["filter_equal_pair"] = f"{p} SELECT row_id, Tr1, Tr2 FROM pairs WHERE NOT ({_EQUAL})"
    out["filter_equal_sentences_val"] = f"{p} SELECT row_id, src, tgt FROM {_SEGMENTS} WHERE {_VALID}"
    out["classify_length_ratio"] = f"{p} SELECT row_id, {_ratio('Tr1', 'Tr2')} AS label FROM pairs"
    out["filter_long_text"] = f"{p} SELECT row_id FROM pairs WHERE {_long('Tr1', 'Tr2')}"
    out["filter_sentence_count_match"] = f"""{p}, split AS (
        SELECT row_id, {_sentences('Tr1')} AS a, {_sentences('Tr2')} AS b FROM pairs WHERE {_long('Tr1', 'Tr2')})
        SELECT row_id, generate_subscripts(a, 1) - 1 AS sent_no, unnest(a) AS s1, unnest(b) AS s2
        FROM split WHERE len(a) = len(b) AND len(a) > 0"""
    out["filter_supported_langs"] = f"""{p} SELECT row_id, Lang1, Lang2 FROM pairs
        WHERE Lang1 IN ({_L}) AND Lang2 IN ({_L})"""
    ids = "ids AS (SELECT row_id AS id, Tr1, Tr2 FROM pairs)"
    out["route_language_check"] = f"""{p}, {_PROFILES}, {ids}, {_found('ids')}
        SELECT row_id, {_VERDICT} AS verdict FROM pairs JOIN found ON id = row_id"""

    out["distinct_pairs_keep_first"] = f"""{p} SELECT row_id, Filename, Tr1, Tr2 FROM pairs
        QUALIFY row_number() OVER (PARTITION BY Filename, Tr1, Tr2 ORDER BY row_id) = 1"""
    out["agg_duplicate_count"] = f"""{p} SELECT Filename, sum(n - 1)::BIGINT AS duplicates FROM (
        SELECT Filename, Tr1, Tr2, count(*) AS n FROM pairs GROUP BY ALL) WHERE n > 1 GROUP BY Filename"""
    out["agg_first_row_lang"] = f"""{p} SELECT File, arg_min(Lang1, row_id) AS first1, arg_min(Lang2, row_id) AS first2
        FROM pairs GROUP BY File"""
    out["proj_stamp_lang"] = f"""{p}, f AS (SELECT File, arg_min(Lang1, row_id) AS Lang1, arg_min(Lang2, row_id) AS Lang2
        FROM pairs GROUP BY File) SELECT row_id, File, f.Lang1, f.Lang2 FROM pairs JOIN f USING (File)"""
    alive = lambda no: (
        f"count(*) FILTER (coalesce(drop_stage, 99) > {no}" + (" AND sent_no = 0)" if no < 4 else ")"))
    out["agg_step_table"] = f"""WITH {_AUDIT} SELECT Filename, count(*) FILTER (sent_no = 0) AS Original,
        {alive(1)} AS "Step_1", {alive(2)} AS "Step_2", {alive(3)} AS "Step_3(1)", {alive(4)} AS "Step_4",
        {alive(5)} AS "Step_3(2)", {alive(6)} AS "Step_5" FROM audit GROUP BY Filename"""
    out["agg_route_counts"] = f"""WITH {_AUDIT} SELECT drop_stage, reason, route, count(*) AS n,
        sum(inverted)::BIGINT AS n_inverted FROM audit GROUP BY ALL"""

    out["job_step1_equal_dedupe"] = f"""{p}, {_STEP1} SELECT row_id, CASE WHEN is_equal OR rn > 1 THEN 1 END AS drop_stage,
        CASE WHEN is_equal THEN 'equal' WHEN rn > 1 THEN 'duplicate' END AS reason FROM s1"""
    out["job_step2_clean"] = f"{p} SELECT row_id, {_clean(1)} AS Tr1, {_clean(2)} AS Tr2 FROM pairs"
    out["job_step3_ratio"] = f"""{p} SELECT row_id, CASE WHEN label <> 'Ok' THEN 3 END AS drop_stage,
        CASE WHEN label <> 'Ok' THEN 'ratio_' || lower(label) END AS reason
        FROM (SELECT row_id, {_ratio('Tr1', 'Tr2')} AS label FROM pairs)"""
    out["norm_english_formalizer"] = f"{p} SELECT row_id, {_english(_informal('Tr1'))} AS src FROM pairs"
    out["norm_spanish_plural_abbrev"] = f"{p} SELECT row_id, {_spanish(_capitals('Tr1'))} AS src FROM pairs"
    out["job_segment_process"] = f"""{p}, {_LINES},
        segs AS (SELECT row_id, {_informal('Tr1')} AS src, {_capitals('Tr2')} AS tgt FROM pairs)
        SELECT row_id, {_english('src')} AS src, {_spanish('tgt')} AS tgt FROM segs
        WHERE {_VALID} AND coalesce({_STRIPPED} NOT IN (SELECT line FROM test_lines), true)"""
    segs = f"segs AS (SELECT row_id, {_informal('Tr1')} AS src, {_capitals('Tr2')} AS tgt FROM pairs)"
    out["job_segment_decode_src"] = f"{p}, {segs} SELECT row_id, {_english('src')} AS src, tgt FROM segs"
    out["job_segment_decode_tgt"] = f"{p}, {segs} SELECT row_id, src, {_spanish('tgt')} AS tgt FROM segs"
    out["job_segment_own_steps"] = f"""{p} SELECT row_id, regexp_replace(src, '[0-9]', '', 'g') AS src, tgt
        FROM {_SEGMENTS} WHERE tgt IS NOT NULL"""
    out["lookup_lexicon"] = f"""{p}, words AS (SELECT DISTINCT w FROM (
            SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM benchmark) WHERE w <> ''),
        places AS (SELECT row_id, unnest(string_split(Tr1, ' ')) AS token,
                          generate_subscripts(string_split(Tr1, ' '), 1) AS place FROM pairs)
        SELECT row_id, string_agg(CASE WHEN w IS NULL THEN token ELSE '<' || token || '>' END, ' ' ORDER BY place) AS src
        FROM pairs LEFT JOIN places USING (row_id) LEFT JOIN words ON w = token GROUP BY row_id"""

    out["anti_test_lines"] = f"""{p}, {_LINES} SELECT row_id, src FROM {_SEGMENTS}
        WHERE coalesce({_STRIPPED} NOT IN (SELECT line FROM test_lines), true)"""
    out["semi_test_lines"] = f"""{p}, {_LINES} SELECT row_id, src FROM {_SEGMENTS}
        WHERE {_STRIPPED} IN (SELECT line FROM test_lines)"""
    out["job_decontaminate"] = f"""{p}, {_LINES} SELECT row_id,
        CASE WHEN {_STRIPPED} IN (SELECT line FROM test_lines) THEN 1 ELSE 0 END AS leaked FROM {_SEGMENTS}"""

    out["split_sentences"] = f"""SELECT doc_id, generate_subscripts(a, 1) - 1 AS sent_no, unnest(a) AS sentence
        FROM (SELECT doc_id, {_sentences('text')} AS a FROM documents)"""
    out["job_step4_sentence_split"] = f"""{p},
        f AS (SELECT Filename, arg_min(Lang1, row_id) AS f1, arg_min(Lang2, row_id) AS f2 FROM pairs GROUP BY Filename),
        split AS (SELECT row_id, Filename, Tr1, Tr2,
                         CASE WHEN {_long('Tr1', 'Tr2')} THEN {_sentences('Tr1')} ELSE [Tr1] END AS a,
                         CASE WHEN {_long('Tr1', 'Tr2')} THEN {_sentences('Tr2')} ELSE [Tr2] END AS b FROM pairs),
        parts AS (SELECT row_id, Filename, generate_subscripts(a, 1) - 1 AS sent_no, unnest(a) AS Tr1, unnest(b) AS Tr2,
                         {_TAGGED} FROM split WHERE len(a) = len(b) AND len(a) > 0
                  UNION ALL SELECT row_id, Filename, 0, Tr1, Tr2, 4, 'sentence_count' FROM split
                  WHERE coalesce(len(a) <> len(b) OR len(a) = 0, true))
        SELECT row_id, sent_no, Tr1, Tr2, f1 AS Lang1, f2 AS Lang2, drop_stage, reason FROM parts JOIN f USING (Filename)"""
    out["job_train_langid"] = f"WITH {_PROFILES} SELECT lang, gram, n, weight, unseen FROM profiles"
    out["job_score_langid"] = f"""{p}, {_PROFILES}, {ids}, {_found('ids')}
        SELECT id AS row_id, found1, found2 FROM found"""
    out["job_step5_language"] = f"""{p}, {_PROFILES}, {ids}, {_found('ids')},
        judged AS (SELECT pairs.*, {_VERDICT} AS v FROM pairs JOIN found ON id = row_id)
        SELECT row_id, CASE WHEN v = 'swap' THEN Tr2 ELSE Tr1 END AS Tr1, CASE WHEN v = 'swap' THEN Tr1 ELSE Tr2 END AS Tr2,
               CASE WHEN v = 'swap' THEN Lang2 ELSE Lang1 END AS Lang1,
               CASE WHEN v = 'swap' THEN Lang1 ELSE Lang2 END AS Lang2,
               CASE WHEN v = 'delete' THEN 6 END AS drop_stage, CASE WHEN v = 'delete' THEN 'language' END AS reason,
               CASE WHEN v = 'swap' THEN 1 ELSE 0 END AS inverted FROM judged"""
    out["job_clean_corpus"] = f"WITH {_AUDIT} SELECT * FROM audit"

    out["metric_wer"] = f"""WITH {_TRANSLATIONS}, {_WER}
        SELECT row_id, round(edits * 100.0 / nullif(n, 0), 6) AS wer FROM wers"""
    out["metric_cer"] = f"WITH {_TRANSLATIONS}, {_CER} SELECT row_id, round(cer, 6) AS cer FROM cers"
    out["metric_f_measure"] = f"WITH {_TRANSLATIONS}, {_F_MEASURE} SELECT row_id, round(f_score, 6) AS f_score FROM fs"
    out["job_quality_features"] = f"""WITH {_FEATURES} SELECT row_id, round(wer, 6) AS wer, round(cer, 6) AS cer,
        round(f_score, 6) AS f_score FROM feats"""
    terms = ", ".join(f"round({sql}, 4) AS {name}" for name, sql in _TERM_SQL.items())
    out["feat_poly2"] = f"WITH {_FEATURES} SELECT row_id, {terms} FROM feats"
    names = [*_TERM_SQL, "label"]
    scaled = ", ".join(f"{c} / 100 AS {c}" for c in ("wer", "cer", "f_score"))
    full = ", ".join([*(f"{sql} AS {name}" for name, sql in _TERM_SQL.items()), "label"])
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round(covar_pop({a}, {b}), 5) AS value FROM terms"
        for k, a in enumerate(names) for b in names[k:])
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ("wer", "cer", "f_score"))
    out["stat_gram_matrix"] = f"""WITH {_SCORED},
        scaled AS (SELECT {scaled}, planted AS label FROM scored WHERE {whole}),
        terms AS MATERIALIZED (SELECT {full} FROM scaled) {cells}"""
    out["model_quality_fit"] = f"WITH RECURSIVE {_SCORED}, {_fit('true')} SELECT term, round(weight, 5) AS weight FROM fitted"
    out["model_quality_predict"] = f"""WITH RECURSIVE {_SCORED}, {_fit('true')}, {_PREDICTED}
        SELECT row_id, round(prediction, 3) AS prediction FROM predicted"""
    out["model_quality_evaluate"] = f"""WITH RECURSIVE {_SCORED}, {_fit(_TRAIN)}, {_PREDICTED}
        SELECT round(corr(planted, prediction), 6) AS pearson FROM predicted WHERE NOT ({_TRAIN})"""
    out["stat_pearson"] = f"WITH {_SCORED} SELECT round(corr(planted + noise, wer), 6) AS pearson FROM scored"

    out["job_learn_subwords_char"] = _vocabulary(f"""SELECT c AS piece, count(*) AS n FROM (
        SELECT unnest(string_split(w, '')) AS c FROM ({_MARKED_WORDS})) GROUP BY c""", 7997)
    out["job_learn_subwords_word"] = _vocabulary(f"SELECT w AS piece, count(*) AS n FROM ({_MARKED_WORDS}) GROUP BY w", 7997)
    out["job_apply_subwords_char"] = f"""SELECT doc_id, array_to_string(list_filter(
        string_split(replace({_MARKED}, ' ', ''), ''), lambda x: x <> ''), ' ') AS pieces FROM documents"""
    out["job_learn_subwords_bpe"] = merges_sql(8000)
    for kind in ("round_trip", "bpe"):
        out[f"job_apply_subwords_{kind}"] = f"SELECT doc_id, {_DOC_TEXT} AS text, 0::BIGINT AS unknown FROM documents"
    out["job_undo_subwords"] = f"SELECT doc_id, {_DOC_TEXT} AS text FROM documents"
    out["topk_vocab"] = f"""SELECT token, count(*) AS n FROM (SELECT unnest({_tokens('text')}) AS token FROM documents)
        GROUP BY token ORDER BY n DESC, token LIMIT 8000"""
    side = lambda name, c: f"""(SELECT '{name}' AS side, token, count(*) AS n FROM (
        SELECT unnest({_tokens(c)}) AS token FROM pairs) GROUP BY token ORDER BY n DESC, token LIMIT 8000)"""  # noqa: E731
    out["topk_vocab_sides"] = f"{p} {side('src', 'Tr1')} UNION ALL {side('tgt', 'Tr2')}"
    out["win_token_batches"] = f"""{p}, sized AS (SELECT row_id, len({_tokens('Tr1')}) AS n_tokens FROM pairs)
        SELECT row_id, n_tokens, greatest(sum(n_tokens) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING) - 1, 0)::BIGINT
               // 4096 AS batch_id FROM sized"""
    out["job_build_training_set"] = f"{p}, {_TRAINING} SELECT row_id, shard, n_tokens, batch_id FROM training"

    out["win_token_batches_full"] = f"""{p.replace('WITH', 'WITH RECURSIVE', 1)},
        sized AS (SELECT 0 AS one, row_id, len({_tokens('Tr1')}) AS n_tokens FROM pairs), {_greedy('sized', 'one', 'row_id')}
        SELECT row_id, n_tokens, batch_id FROM greedy"""
    lacking = "".join(f""",
        words_{s} AS (SELECT row_id, unnest({_tokens(s)}) AS w FROM {_SEGMENTS}),
        top_{s} AS (SELECT w, count(*) AS c FROM words_{s} GROUP BY w ORDER BY c DESC, w LIMIT 7997),
        lacking_{s} AS (SELECT row_id, count(*) AS n FROM words_{s} WHERE w NOT IN (SELECT w FROM top_{s}) GROUP BY row_id)"""
                      for s in ("src", "tgt"))
    out["job_build_training_files"] = f"""{p.replace('WITH', 'WITH RECURSIVE', 1)}, {_TRAINING},
        counted AS (SELECT row_id, shard, coalesce(n_tokens, 0) AS n_tokens FROM training),
        {_greedy('counted', 'shard', 'n_tokens, row_id')}{lacking},
        sums AS (SELECT shard, batch_id, count(*) AS n, sum(n_tokens)::BIGINT AS tokens,
                        coalesce(sum(s.n), 0)::BIGINT AS unknown_src, coalesce(sum(t.n), 0)::BIGINT AS unknown_tgt
                 FROM greedy g LEFT JOIN lacking_src s USING (row_id) LEFT JOIN lacking_tgt t USING (row_id)
                 GROUP BY shard, batch_id)
        SELECT *, (sum(n) OVER w)::BIGINT AS examples, count(*) OVER w AS batches, max(tokens) OVER w AS largest_batch
        FROM sums WINDOW w AS (PARTITION BY shard)"""
    chars = _vocabulary(f"""SELECT c AS piece, count(*) AS n FROM (
        SELECT unnest(string_split(w, '')) AS c FROM ({_MARKED_WORDS})) GROUP BY c""", 7997)
    out["src_vocab"] = f"SELECT *, 'char' AS model_type, 1 AS versions FROM ({chars})"
    out["job_clean_folder"] = f"WITH {_AUDIT} SELECT File, Tr1, Tr2, Lang1, Lang2 FROM audit WHERE drop_stage IS NULL"
    out["sink_step_table"] = f"SELECT * REPLACE (Filename || '.tsv' AS Filename) FROM ({out['agg_step_table']})"
    out["src_corpus_tsv_blocks"] = f"""{p} SELECT row_number() OVER (ORDER BY row_id) - 1 AS place, row_id::VARCHAR AS File,
        replace(Tr1, ' ', chr(10)) AS Tr1, '"' || Tr2 AS Tr2, Lang1, Lang2 FROM pairs"""

    out["win_fixed_batches"] = f"""{p} SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 30 AS batch_id FROM pairs"""
    best = """SELECT conv_id, turn, -length(text) AS score, row_number() OVER (
        PARTITION BY conv_id ORDER BY -length(text) DESC, turn) AS rank FROM conversations QUALIFY rank <= 5"""
    out["job_exact_batches"] = f"""{p} SELECT row_id, ((row_number() OVER (ORDER BY row_id) - 1) % 30)::DOUBLE AS place FROM pairs"""
    # A file keeps no difference between an empty field and none, and reading strips nothing else.
    out["job_read_folders"] = f"""{p} SELECT Tr1, Tr2, Lang1, Lang2, count(*) AS n, count(*) AS ids FROM pairs GROUP BY ALL"""
    out["job_translate_folders"] = f"""{p}, {_PHRASES}, {_PLACES},
        done AS (SELECT row_id, string_agg(CASE WHEN length(own) < 5 THEN own ELSE coalesce(replacement, seen, '<unk>') END, ' ' ORDER BY i) AS sent
                 FROM places LEFT JOIN phrases ON token = seen GROUP BY row_id)
        SELECT Tr1 AS src, Tr1 AS asked, count(*) AS n, min(sent) AS least, max(sent) AS most FROM pairs JOIN done USING (row_id) GROUP BY Tr1"""
    out["topk_nbest"] = best
    out["topk_nbest_arrays"] = f"SELECT conv_id, rank - 1 AS place, turn, score FROM ({best})"
    out["lookup_phrase_table"] = f"""{p}, {_PHRASES}, {_PLACES}
        SELECT row_id, string_agg(CASE WHEN i % 3 <> 0 THEN own ELSE coalesce(replacement, seen, '<unk>') END,
                                  ' ' ORDER BY i) AS sent
        FROM places LEFT JOIN phrases ON token = seen GROUP BY row_id"""
    out["job_batch_translate"] = f"""{p}, {_PHRASES}, {_PLACES},
        done AS (SELECT row_id, i, CASE WHEN length(own) < 5 THEN own ELSE coalesce(replacement, seen, '<unk>') END AS w
                 FROM places LEFT JOIN phrases ON token = seen),
        sents AS (SELECT row_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS forth,
                         string_agg(w, ' ' ORDER BY i DESC) AS back FROM done GROUP BY row_id)
        SELECT row_id, 0 AS rank, forth AS sent, -n::DOUBLE AS score FROM sents
        UNION ALL SELECT row_id, 1, back, -n::DOUBLE - 1 FROM sents"""
    out["job_translate_resumed"] = out["job_batch_translate"]
    out["learn_abbreviations"] = f"WITH {_ABBREVIATIONS} SELECT lang, token, n, dotted, round(score, 6) AS score FROM abbr"
    out["split_sentences_lang"] = f"""WITH {_ABBREVIATIONS}, {_BY_LANGUAGE}
        SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_no, unnest(s) AS sentence FROM sentences"""
    return out
