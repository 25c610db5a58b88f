"""Licence notices and SPDX tags: one automaton over all phrases, and a parser for tag expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

# The phrases whose places count as base hits, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
BASE_LABELS = sorted(set(BASE_PHRASES.values()))

# Phrases of notices beyond these, in lower case words.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit-notice",
    "redistribution and use in source and binary forms": "bsd-notice",
    "licensed under the apache license": "apache-notice",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

# Licence identifiers, lower case, that a corpus may keep; the default of `scan_licenses`.
PERMISSIVE = ("0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc-by-4.0", "cc0-1.0", "isc", "mit",
              "unlicense", "zlib")

# A notice is evidence, a tag is a statement.
NOTICE_SCORE = 0.6
TAG_SCORE = 0.95

RESULT = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("words", T.LongType()),
        T.StructField("kind", T.StringType()), T.StructField("label", T.StringType())]))),
    T.StructField("expressions", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("permitted", T.BooleanType()), T.StructField("score", T.DoubleType())])

# Lower-cases A-Z, makes a blank of every other ASCII character but digits and lower-case letters.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_TAG_TEXT = re.compile(r"spdx[^a-z0-9\x80-\U0010FFFF]+license[^a-z0-9\x80-\U0010FFFF]+identifier[ \t]*:?[ \t]*([^\r\n]*)", re.I | re.A)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str] | None:
    """The licence expression that `text` begins with, in postfix order, by the shunting-yard method.

    WITH binds before AND, AND before OR, whatever their case. Reading stops where the text stops being an
    expression. None if there is no identifier or a parenthesis stays open.
    """
    out: list[str] = []
    waiting: list[str] = []
    at, operand = 0, True
    while m := _TOKEN.match(text, at):
        token = m[1]
        word = token.lower()
        if operand and (token == ")" or word in _PRECEDENCE) or not operand and token != ")" and word not in _PRECEDENCE:
            break
        if token == "(":
            waiting.append("(")
        elif token == ")":
            if "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif word in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            out.append(token)
            operand = False
        at = m.end()
    if not out:
        return None
    if operand and waiting and waiting[-1] != "(":
        waiting.pop()  # an operator with nothing after it ends the expression before it
    if "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str], allowed: frozenset[str]) -> tuple[str, bool]:
    """The expression with full parentheses, and whether its terms allow use under `allowed`.

    OR needs one side, AND both; an exception leaves the verdict on its licence as it is.
    """
    stack: list[tuple[str, bool]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (right, r), (left, l) = stack.pop(), stack.pop()
            verdict = l if token == "with" else l and r if token == "and" else l or r
            stack.append((f"({left} {token.upper()} {right})", verdict))
        else:
            stack.append((token, token.lower().rstrip("+") in allowed))
    return stack[0]


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICE_PHRASES), ("tag", {TAG: "spdx"})):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, kind, label))
    found.make_automaton()
    return found


def scan_text(text: str | None, automaton, allowed: frozenset[str]) -> tuple:
    """n_words, hits, expressions, labels, permitted, score of one text. Null counts as empty.

    A word is a run of ASCII letters and digits and of characters beyond ASCII. Hits come by their ends
    and may overlap. `permitted` is null without a readable tag, else whether all of them are permitted.
    """
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    if not words:
        return 0, [], [], [], None, 0.0
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    hits, seen, at = [], 0, 0
    for end, (chars, n, kind, label) in automaton.iter(line):
        seen += line.count(" ", at, end)  # blanks before the one that closes the phrase: its last word's number plus 1
        at = end
        hits.append((seen - n, n, kind, label))
    tags = [h for h in hits if h[2] == "tag"]
    expressions, verdicts = [], []
    for m in _TAG_TEXT.finditer(text) if tags else ():
        if postfix := parse_expression(m[1]):
            expression, ok = evaluate(postfix, allowed)
            expressions.append(expression)
            verdicts.append(ok)
            hits_labels = {f"spdx:{t.lower()}" for t in postfix if t not in _PRECEDENCE}
            hits.extend((-1, 0, "expression", x) for x in sorted(hits_labels))
    labels = sorted({h[3] for h in hits})
    doubt = 1.0
    for kind in {(h[2], h[3]) for h in hits if h[2] != "expression"}:
        doubt *= 1 - (TAG_SCORE if kind[0] == "tag" and expressions else NOTICE_SCORE)
    return (len(words), [h for h in hits if h[0] >= 0], expressions, labels,
            all(verdicts) if verdicts else None, 1 - doubt)


def _scan(allowed: frozenset[str]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = _automaton()
        names = [f.name for f in RESULT.fields]
        hit = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))
        kinds = [pa.int64(), pa.int64(), hit, pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(), pa.float64()]
        fields = ("start", "words", "kind", "label")
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows = [scan_text(t.as_py(), automaton, allowed) for t in texts]
            columns = [keys.cast(pa.int64())] + [
                pa.array([[dict(zip(fields, h)) for h in r[i]] for r in rows] if i == 1 else [r[i] for r in rows], k)
                for i, k in enumerate(kinds[1:])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = PERMISSIVE) -> DataFrame:
    """key, n_words, hits, expressions, labels, permitted, score of every row's whole text.

    `hits` has start (in words, from 0), length, kind and label of each phrase; `expressions` the licence
    expressions of the tags that can be read; `labels` the distinct labels of both, sorted. `score` is the
    chance that the text carries a licence if each distinct sign were independent. One pass, no shuffle:
    rows are scanned where they are, whatever repeats. Null and empty texts have no hit and score 0.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_scan(frozenset(a.lower() for a in allowed)), RESULT).withColumnRenamed("key", key)
