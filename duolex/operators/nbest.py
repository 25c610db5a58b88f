"""Batch translation with a caller's predictor, and work on its candidates."""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from duolex.operators.batches import INFERENCE_BATCH, fixed_batches, position
from duolex.operators.lookup import find_replacements, replaced, small_entries
from duolex.session import delete_staged, stage
from duolex.sources.commits import commit, committed

# Sources whose results are committed together.
RANGE_ROWS = 10_000_000

# Decoding defaults. The lengths bound what a decoder writes; pass them to yours.
N_BEST = 1
MIN_LENGTH = 0
MAX_LENGTH = 300
SEED = 829
UNKNOWN = "<unk>"

CANDIDATES = "array<struct<tokens:array<string>,attn:array<array<double>>,score:double>>"
_SOUGHT = "array<struct<tokens:array<string>,asked:array<string>,attn:array<array<double>>,score:double>>"
_TRANSLATION = "array<struct<src:string,sent:string,attn:array<array<double>>,score:double>>"

# Results leave a task once they hold so many weights of attention or sources.
RESULT_CELLS, RESULT_ROWS = 1 << 20, 10_000

# A predictor maps a list of sources to, per source, a list of (tokens, attention, score).
Predictor = Callable[[list[str]], list[list[tuple[list[str], list[list[float]], float]]]]


def _seeded(predict: Predictor, sources: list[str], seed: int) -> list[list[tuple]]:
    random.seed(seed)
    np.random.seed(seed)
    found = [list(candidates) for candidates in predict(sources)]
    if len(found) != len(sources):
        raise ValueError(f"{len(found)} results for {len(sources)} sources")
    return found


def _offsets(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)


def _cells(attn) -> int:
    return math.prod(attn.shape) if hasattr(attn, "tolist") else sum(len(row) for row in attn or () if row is not None)


def _attention(matrices: list) -> pa.Array:
    """Attention of candidates; arrays of two dimensions are put one after another, number by number."""
    if matrices and all(isinstance(m, np.ndarray) and m.ndim == 2 for m in matrices):
        rows = [len(m) for m in matrices]
        values = np.concatenate([m.ravel() for m in matrices]).astype(np.float64, copy=False)
        inner = pa.ListArray.from_arrays(_offsets(np.repeat([m.shape[1] for m in matrices], rows)), pa.array(values))
        return pa.ListArray.from_arrays(_offsets(rows), inner)
    return pa.array([m.tolist() if hasattr(m, "tolist") else m for m in matrices], pa.list_(pa.list_(pa.float64())))


def _fields(candidates: list[tuple]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Tokens, attention and scores."""
    words = pa.array([t for tokens, _, _ in candidates for t in tokens], pa.string())
    tokens = pa.ListArray.from_arrays(_offsets([len(tokens) for tokens, _, _ in candidates]), words)
    return tokens, _attention([attn for _, attn, _ in candidates]), pa.array([float(s) for *_, s in candidates], pa.float64())


def _per_source(found: list[list[tuple]], **fields: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(
        _offsets([len(candidates) for candidates in found]), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _predicted(df: DataFrame, src: str, order: str, load: Callable[[], Predictor], out: str, kind: str,
               column: Callable[[pa.Array, list[list[tuple]]], pa.Array], batch_size: int, seed: int,
               exact_batches: bool) -> DataFrame:
    """order, src and `out`, which `column` makes of sources and their candidates in the task that found them."""
    names = [order, "src", out]
    schema = f"`{order}` bigint, src string, {out} {kind}"
    rows = df.select(F.col(order).cast("bigint").alias(order), F.col(src).alias("src"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Batches for the predictor; the last one may go on in the next part."""
        held = None
        for part in parts:
            part = pa.Table.from_batches([part])
            held = part if held is None else pa.concat_tables([held, part])
            if exact_batches:
                ids = held.column(2).to_numpy()
                starts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist()]
            else:
                starts = list(range(0, len(held) + 1, batch_size))
            for start, end in zip(starts, starts[1:]):
                yield held.slice(start, end - start)
            held = held.slice(starts[-1])
        if held is not None and len(held):
            yield held

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict, batches, found, cells = load(), [], [], 0

        def result() -> pa.RecordBatch:
            whole = pa.concat_tables(batches)
            ids, sources = whole.column(0).combine_chunks(), whole.column(1).combine_chunks()
            return pa.RecordBatch.from_arrays([ids, sources, column(sources, found)], names)

        for batch in cut(parts):
            some = _seeded(predict, [s or "" for s in batch.column(1).to_pylist()], seed)
            batches.append(batch)
            found += some
            cells += sum(_cells(attn) for candidates in some for _, attn, _ in candidates)
            if cells >= RESULT_CELLS or len(found) >= RESULT_ROWS:
                yield result()
                batches, found, cells = [], [], 0
        if found:
            yield result()

    if exact_batches:
        batched = fixed_batches(stage(rows, "to-predict"), order, batch_size).select(order, "src", "batch_id")
        return batched.repartition("batch_id").sortWithinPartitions("batch_id", order).mapInArrow(stream, schema)
    return rows.mapInArrow(stream, schema)


def predict_candidates(df: DataFrame, src: str, order: str, load: Callable[[], Predictor],
                       batch_size: int = INFERENCE_BATCH, seed: int = SEED, exact_batches: bool = False) -> DataFrame:
    """order, src, candidates: the predictor's raw output per row.

    `load` runs once per task, in either mode. Rows reach the predictor in batches of
    `batch_size` with the seed set anew for each. By default a batch is made of
    rows that lie together; with `exact_batches` it is the run of rows in global
    order, at the price of a shuffle, for predictors whose result depends on
    their batch mates.
    """
    def column(_: pa.Array, found: list[list[tuple]]) -> pa.Array:
        tokens, attn, scores = _fields([c for candidates in found for c in candidates])
        return _per_source(found, tokens=tokens, attn=attn, score=scores)

    return _predicted(df, src, order, load, "candidates", CANDIDATES, column, batch_size, seed, exact_batches)


def output_length_ok(tokens: Column, min_length: int = MIN_LENGTH, max_length: int = MAX_LENGTH) -> Column:
    """Whether a candidate's length is within bounds, for callers who want to drop those that are not."""
    return F.size(tokens).between(min_length, max_length)


def most_attended(attn: Column, position: Column) -> Column:
    """Zero-based source position with the highest attention for an output position."""
    weights = F.get(attn, position)
    return F.array_position(weights, F.array_max(weights)).cast("int") - 1


def replace_unknown(tokens: Column, attn: Column, source_tokens: Column) -> Column:
    """Unknown output tokens become the source token they attend to most."""
    return F.transform(
        tokens,
        lambda t, i: F.when(
            t == UNKNOWN, F.coalesce(F.get(source_tokens, most_attended(attn, i)), t)).otherwise(t),
    )


def _sought(tokens: Column, attn: Column, source_tokens: Column) -> Column:
    """At each unknown output token the source token it attends to most, null elsewhere."""
    found = F.transform(
        tokens, lambda t, i: F.when(t == UNKNOWN, F.get(source_tokens, most_attended(attn, i))))
    return F.coalesce(found, F.array().cast("array<string>"))


def _filled(tokens: Column, replacements: Column, sought: Column) -> Column:
    better = F.zip_with(replacements, sought, lambda r, s: F.coalesce(r, s))
    return F.zip_with(tokens, better, lambda t, b: F.coalesce(b, t))


def lookup_phrase_table(df: DataFrame, keys: list[str], tokens: str, attn: str, source_tokens: str,
                        table: DataFrame, **limits) -> DataFrame:
    """Unknown output tokens through a phrase table (token, replacement).

    Tokens without an entry become the source token itself. Attention is read once, and only the source
    tokens sought are looked up. See `find_replacements` for how a table of any size is read; `keys` must
    name a row.
    """
    asked = df.withColumn("_asked", F.array(_sought(F.col(tokens), F.col(attn), F.col(source_tokens))))
    found = find_replacements(asked, keys, "_asked", table, "_found", **limits)
    filled = _filled(F.col(tokens), F.col("_found")[0], F.col("_asked")[0])
    return found.withColumn(tokens, filled).drop("_asked", "_found")


def top_nbest(candidates: DataFrame, source_id: str, score: str, cand_id: str, n: int = N_BEST) -> DataFrame:
    """Adds `rank` and keeps the best `n` candidates of each source.

    Each task drops what cannot be among the best before the shuffle.
    """
    best_first = W.partitionBy(source_id).orderBy(F.desc(score), F.asc(cand_id))
    return candidates.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)


def collect_nbest(ranked: DataFrame, source_id: str, fields: list[str]) -> DataFrame:
    """One array per source, best first. Use after `top_nbest`, which bounds it."""
    return ranked.groupBy(source_id).agg(
        F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("_all")
    ).select(source_id, F.transform("_all", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("translation"))


def _loss(candidate: tuple) -> tuple[bool, float]:
    score = float(candidate[2])
    return score != score, -score


def _unknown(words: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.equal(words, UNKNOWN), False).to_numpy(zero_copy_only=False)


def _attended(tokens: pa.Array, attn: pa.Array, places: np.ndarray, sources: pa.Array, owner: np.ndarray) -> pa.Array:
    """The source token that each of some output tokens attends to most, null where there is none.

    `places` are places in all tokens, one after another; `owner` names the source of each candidate.
    """
    begins, lines = tokens.offsets.to_numpy(), attn.offsets.to_numpy()
    candidate = np.searchsorted(begins, places, side="right") - 1
    line = lines[candidate] + places - begins[candidate]
    there = np.flatnonzero(line < lines[candidate + 1])
    weights = attn.values
    edges = weights.offsets.to_numpy()
    start, width = edges[line[there]], np.diff(edges)[line[there]]
    most = np.full(len(places), -1, np.int64)
    if weights.values.null_count:
        for at, row in zip(there, line[there].tolist()):
            known = [(w != w, 0.0 if w != w else w, -i) for i, w in enumerate(weights[row].as_py() or ()) if w is not None]
            most[at] = -max(known)[2] if known else -1
    else:
        values = weights.values.to_numpy()
        for size in np.unique(width[width > 0]).tolist():
            same = np.flatnonzero(width == size)
            most[there[same]] = values[start[same][:, None] + np.arange(size)].argmax(axis=1)
    firsts = sources.offsets.to_numpy()
    source = owner[candidate]
    found = (most >= 0) & (firsts[source] + most < firsts[source + 1])
    return sources.values.take(pa.array(firsts[source] + most, mask=~found))


def _joined(offsets: pa.Array, words: pa.Array) -> pa.Array:
    """Tokens with blanks between them; missing ones are left out."""
    if words.null_count:
        before = np.concatenate([[0], np.cumsum(words.is_valid().to_numpy(zero_copy_only=False))])
        offsets, words = pa.array(before[offsets.to_numpy()].astype(np.int32)), words.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")


def translate(df: DataFrame, load: Callable[[], Predictor], src: str = "src", order: str = "row_id",
              n_best: int = N_BEST, batch_size: int = INFERENCE_BATCH, seed: int = SEED,
              replace_unk: bool = True, phrase_table: DataFrame | None = None,
              exact_batches: bool = False, **limits) -> DataFrame:
    """order, src, translation: the `n_best` candidates per row as an array of
    `(src, sent, attn, score)`, best first. Sort by `order` where it matters.

    Every row gives a result with all that its predictor found, however long; a
    missing source reaches it as an empty one and stays missing in the result.
    Limits on length are the predictor's: bind them in `load`.

    Candidates are ranked and filled in by the task that found them. So are they through a phrase table of up to the
    sizes in `limits`; see `find_replacements` for a larger one.
    """
    held, entries = small_entries(phrase_table, **limits) if replace_unk and phrase_table is not None else (None, None)

    def best(sources: pa.Array, found: list[list[tuple]]):
        """The best candidates per source, the source of each, its fields, and where and what unknown tokens ask for."""
        found = [sorted(candidates, key=_loss)[:n_best] for candidates in found]
        owner = np.repeat(np.arange(len(found)), [len(candidates) for candidates in found])
        tokens, attn, scores = _fields([c for candidates in found for c in candidates])
        unknown = _unknown(tokens.values) if replace_unk else np.zeros(len(tokens.values), bool)
        asked = _attended(tokens, attn, np.flatnonzero(unknown), pc.split_pattern(pc.fill_null(sources, ""), " "), owner)
        return found, owner, tokens, attn, scores, unknown, asked

    def finished(sources: pa.Array, found: list[list[tuple]]) -> pa.Array:
        found, owner, tokens, attn, scores, unknown, asked = best(sources, found)
        if held is not None:
            asked = pc.coalesce(replaced(asked, held.value), asked)
        words = pc.replace_with_mask(tokens.values, pa.array(unknown), pc.fill_null(asked, UNKNOWN))
        return _per_source(found, src=sources.take(pa.array(owner)), sent=_joined(tokens.offsets, words), attn=attn, score=scores)

    def open_ones(sources: pa.Array, found: list[list[tuple]]) -> pa.Array:
        found, _, tokens, attn, scores, unknown, asked = best(sources, found)
        asked = pc.replace_with_mask(pa.nulls(len(unknown), pa.string()), pa.array(unknown), asked)
        return _per_source(found, tokens=tokens, asked=pa.ListArray.from_arrays(tokens.offsets, asked), attn=attn, score=scores)

    if entries is None:
        return _predicted(df, src, order, load, "translation", _TRANSLATION, finished, batch_size, seed, exact_batches)
    asked = _predicted(df, src, order, load, "candidates", _SOUGHT, open_ones, batch_size, seed, exact_batches).withColumn(
        "_asked", F.transform("candidates", lambda c: c["asked"]))
    found = find_replacements(asked, [order], "_asked", entries, "_found", **limits)
    delete_staged(entries)
    return found.select(order, "src", F.transform(F.arrays_zip("candidates", "_found"), lambda z: F.struct(
        F.col("src").alias("src"),
        F.array_join(_filled(z["candidates"]["tokens"], z["_found"], z["candidates"]["asked"]), " ").alias("sent"),
        z["candidates"]["attn"].alias("attn"), z["candidates"]["score"].alias("score"))).alias("translation"))


def _asked(df: DataFrame, src: str, order: str) -> str:
    """A number that changes with any source, its place or their count."""
    mark = F.xxhash64(F.col(order).cast("bigint"), F.col(src).isNull(), F.col(src)).cast("decimal(38,0)")
    rows, total = df.agg(F.count(F.lit(1)), F.sum(mark)).first()
    return f"{rows}:{total}"


def translate_into(df: DataFrame, load: Callable[[], Predictor], path: str, src: str = "src", order: str = "row_id",
                   range_rows: int = RANGE_ROWS, **options) -> DataFrame:
    """`translate`, whose results are kept below `path` range by range; returns all of them.

    A range is a run of `range_rows` sources in order. Its results go to a folder of their own, and a commit
    that names the folder counts them in, once: a job that died goes on with the ranges that have none, and of
    two jobs at work on one range one has its results read. `path` belongs to one table of sources; another
    one is an error, as its ranges would be taken for done. Work of an executor that is lost is done again
    within its range only. Commits are one small file a range.
    """
    spark = df.sparkSession
    asked = stage(df.select(F.col(order).cast("bigint").alias(order), F.col(src).alias("src")), "sources")
    placed = stage(position(asked, order, "_place").withColumn("_range", F.floor(F.col("_place") / range_rows)), "placed")
    key = f"{_asked(asked, 'src', order)}:{range_rows}"
    commit(spark, f"{path}/job", "sources", key)
    if committed(spark, f"{path}/job")["sources"] != key:
        raise ValueError(f"{path} holds results for other sources")
    ranges = (placed.agg(F.max("_range")).first()[0] or 0) + 1
    done = committed(spark, path)
    for number in range(ranges):
        name = f"{number:08d}"
        if name not in done:
            folder = f"results/{name}-{uuid.uuid4().hex[:8]}"
            part = placed.filter(F.col("_range") == number).select(order, "src")
            translate(part, load, "src", order, **options).write.parquet(f"{path}/{folder}")
            commit(spark, path, name, folder)
    for staged in (asked, placed):
        delete_staged(staged)
    return spark.read.parquet(*[f"{path}/{folder}" for folder in committed(spark, path).values()])
