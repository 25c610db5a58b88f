"""Best-fit packing of tokenized documents into sequences, by rounds over what is left."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F, types as T

from duolex.llm.common import fresh_path
from duolex.llm.tokens import encoder, tokenizer_path

LENGTH = 4096
END_ID = 1
# A sequence with no more room than SLACK is done. A task packs at most ITEMS pieces or sequences at once.
SLACK = 4
ITEMS = 100_000
MAX_PIECES = 5 * ITEMS
# Rounds go on while one takes away at least this share of the sequences left over.
GAIN = 0.02

ITEM = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("offset", T.LongType())])
BINS = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("used", T.LongType()), T.StructField("done", T.BooleanType()),
    T.StructField("items", T.ArrayType(ITEM))])


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places per bin, by falling size: each item goes where least room stays, or opens a bin.

    Open bins are kept by their room; bit `r` of a number says that one has room r, so the smallest room
    that is enough is found at once.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def cut_pieces(key, ids: bytes, length: int) -> list[tuple]:
    """(key, piece, start, length, crc32) of a document; only one longer than `length` has several."""
    return [(key, n, at // 4, (min(at + 4 * length, len(ids)) - at) // 4, zlib.crc32(ids[at:at + 4 * length]))
            for n, at in enumerate(range(0, len(ids), 4 * length))]


def _table(rows: list[tuple[int, int, bool, list[tuple]]]):
    """Bins as one Arrow batch; the offset of an item is what stands before it in its bin."""
    import numpy as np
    import pyarrow as pa

    flat = [x[:5] + (at,) for *_, items in rows for x, at in zip(items, accumulate((y[3] for y in items), initial=0))]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*flat) if flat else [[]] * 6
    struct = pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], [f.name for f in ITEM.fields])
    offsets = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows], dtype=np.int64)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.bool_()), pa.ListArray.from_arrays(offsets, struct)],
        [f.name for f in BINS.fields])


def _task_number(round_no: int) -> int:
    from pyspark import TaskContext

    return (round_no << 56) | (TaskContext.get().partitionId() << 32)


def _pack(groups: list[list[tuple]], first_id: int, length: int, slack: int, last: bool):
    """One best-fit run over groups of items that stay together. Yields bins in Arrow batches."""
    sizes = [sum(x[3] for x in g) for g in groups]
    rows = []
    for n, members in enumerate(best_fit(sizes, length)):
        used = sum(sizes[m] for m in members)
        rows.append((first_id + n, used, last or length - used <= slack, [x for m in members for x in groups[m]]))
    for at in range(0, len(rows), 5000):
        yield _table(rows[at:at + 5000])


def _pack_texts(path: str, length: int, end_id: int, slack: int, items: int):
    """Tokenizes and packs the documents of a task, `items` pieces at a time."""
    def run(batches: Iterator) -> Iterator:
        encode, base, made, waiting = encoder(path).encode, _task_number(0), 0, []
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                waiting.extend([x] for x in cut_pieces(key, ids + end, length))
            if len(waiting) >= items:
                yield from _pack(waiting, base + made, length, slack, False)
                made, waiting = made + len(waiting), []
        yield from _pack(waiting, base + made, length, slack, False)

    return run


def _pack_bins(round_no: int, length: int, slack: int, items: int, last: bool):
    """Packs the sequences left over in a task, each as one item; `last` ends the rounds."""
    def run(batches: Iterator) -> Iterator:
        base, made, waiting, pieces = _task_number(round_no), 0, [], 0
        for batch in batches:
            for row in batch.column(0).to_pylist():
                waiting.append([tuple(x.values()) for x in row])
                pieces += len(row)
                if len(waiting) >= items or pieces >= MAX_PIECES:
                    yield from _pack(waiting, base + made, length, slack, last)
                    made, waiting, pieces = made + len(waiting), [], 0
        yield from _pack(waiting, base + made, length, slack, last)

    return run


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH,
         end_id: int = END_ID, slack: int = SLACK, items: int = ITEMS) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A document is its token ids and `end_id`; only one longer than `length` is cut. Each task packs its
    own documents best-fit and lets nearly full sequences go. The others are items of the next round,
    which packs them in fewer tasks, and so on while rounds pay; a task never holds more than `items`
    items, and no document moves before the first round is over. Null texts are empty: the end id alone.
    Rows that repeat, and null keys, are documents like others. An empty table gives no rows. Tables
    between rounds lie in the shared folder.
    """
    spark = df.sparkSession
    path = tokenizer or tokenizer_path()
    folder = fresh_path(spark, "packed")
    source = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    bins = source.mapInArrow(_pack_texts(path, length, end_id, slack, items), BINS)
    finished, before, round_no, last = [], None, 0, False
    while True:
        at = f"{folder}/round-{round_no}"
        bins.write.parquet(at)
        packed = spark.read.schema(BINS).parquet(at)
        finished.append(packed.filter("done"))
        left = packed.filter("not done").count()
        if not left:
            break
        tasks = -(-left // items)
        last = tasks == 1 or before is not None and left > before * (1 - GAIN)
        before, round_no = left, round_no + 1
        bins = packed.filter("not done").select("items").repartition(tasks).mapInArrow(
            _pack_bins(round_no, length, slack, items, last), BINS)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select("sequence_id", F.explode("items").alias("x")).select(
        F.col("x.key").alias(key), "x.piece", "x.start", "x.length", "x.ids_crc32", "sequence_id", "x.offset")
