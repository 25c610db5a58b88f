"""Readers for the file formats the jobs take."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from duolex.session import delete_staged, small_side, stage

# Column names of the input files.
CORPUS_COLUMNS = ["File", "Tr1", "Tr2", "Lang1", "Lang2"]
SCORED_COLUMNS = ["source", "translation", "evaluator1 scores", "evaluator2 scores"]

CORPUS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CORPUS_COLUMNS])

# Rows of one file that an id has room for; the number of the file stands above them.
FILE_BITS = 38
# Bytes of small blocks that one task reads.
TASK_BYTES = 32 << 20


_CSV = {"sep": "\t", "quote": '"', "escape": '"'}


def _block_shifts(staged: DataFrame) -> DataFrame:
    """path, _block, _shift: what makes an `_ordinal` of a block the number of its file and the place in it.

    A block's rows lie together in the order read, so its size and first ordinal are enough.
    """
    blocks = staged.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_ordinal").alias("first"))
    before = W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # As many rows as files, whose names Spark's own listing holds in the driver already.
    files = blocks.select("path").distinct().withColumn("file", F.row_number().over(W.orderBy("path")) - 1)
    return stage(starts.join(files, "path").select(
        "path", "_block", (F.shiftleft(F.col("file").cast("bigint"), FILE_BITS) + F.col("start") - F.col("first")).alias("_shift")),
        "blocks")


def number_rows(staged: DataFrame) -> DataFrame:
    """Turns path, _block, _ordinal into `row_id`: number of the file by path, then place in the file.

    Unique over all files and in their order. One row per block is summed up, and the texts do not move
    while that table fits a broadcast.
    """
    return staged.join(small_side(_block_shifts(staged)), ["path", "_block"]).withColumn(
        "row_id", F.col("_ordinal") + F.col("_shift")).drop("_block", "_ordinal", "_shift")


def _inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after the line, given whether one is before it.

    A field is quoted if it begins with a quote; within one, doubled quotes cancel out. Quotes elsewhere
    in a field are text.
    """
    for part in line.split("\t"):
        if inside or part.startswith('"'):
            inside ^= part.count('"') % 2 == 1
    return inside


# Bytes of lines that are handled together, as long as they lie in one block of a file.
CHUNK_BYTES = 1 << 20

_CHUNKS = "path string, _block long, _chunk long, _first long, lines long, value string, end0 boolean, end1 boolean, head0 long, head1 long"
_PARTS = "path string, row_id long, first long, value string"


def _line_ways(lines, ways: tuple) -> Iterator[list]:
    """For each way that a run of lines may be entered, the lines that begin a record, and whether a field is open after all.

    A line begins a record if no field is open before it. Only lines with quotes are looked at one by one.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    texts = lines.take(pa.array(quoted)).to_pylist()
    for inside in ways:
        begins = np.ones(len(lines), bool)
        since = 0 if inside else -1
        for at, text in zip(quoted.tolist(), texts):
            after = _inside_after(text, inside)
            if after != inside:
                if after:
                    since = at + 1
                else:
                    begins[since:at + 1] = False
                inside = after
        if inside:
            begins[since:] = False
        yield [begins, inside]


def _chunked(batches: Iterator) -> Iterator:
    """Lines of a block of a file, many to a row, and what they leave open: entered outside of a quoted field, and inside of one.

    `head` is the line, counted from the first of the row, that begins the record that is open or last; null if it lies before.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [f.split()[0] for f in _CHUNKS.split(", ")]
    here, chunk, first = None, 0, 0
    for batch in batches:
        paths, blocks = batch.column("path"), batch.column("_block").to_numpy()
        n = batch.num_rows
        codes = paths.dictionary_encode().indices.to_numpy()
        turns = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1 if n else []
        sizes = np.cumsum(pc.binary_length(batch.column("value")).to_numpy() + 1)
        stops = {0, *map(int, turns), *map(int, np.searchsorted(sizes, np.arange(CHUNK_BYTES, sizes[-1] if n else 0, CHUNK_BYTES)))}
        stops = [*sorted(s for s in stops if s < n), n]
        for lo, hi in zip(stops, stops[1:]):
            place = paths[lo].as_py(), int(blocks[lo])
            chunk, first = (chunk + 1, first) if place == here else (0, 0)
            here = place
            lines = batch.column("value").slice(lo, hi - lo)
            text = pc.binary_join(pa.ListArray.from_arrays([0, hi - lo], lines.cast(pa.string())), "\n")[0].as_py()
            ends, heads = [], []
            for begins, inside in _line_ways(lines, (False, True)):
                last = np.flatnonzero(begins)
                ends.append(inside)
                heads.append(int(last[-1]) + first if len(last) else None)
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*place, chunk, first, hi - lo, text, *ends, *heads)))],
                                             schema=_chunk_schema())
            first += hi - lo


def _chunk_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _CHUNKS.split(", "))])


def _chunk_entries(chunks: DataFrame) -> DataFrame:
    """path, _block, _chunk, _shift, _open, _head: the line number before a chunk, whether a quoted field is open there,
    and the line that its record began in.

    A chunk leaves either state as it is, turns both, or ends in one of them however it began. The last
    one of that kind settles the state; an odd number of turns since then reverses it.
    """
    ends = chunks.select("path", "_block", "_chunk", "lines", "_first", "end0", "end1", "head0", "head1")
    earlier = W.partitionBy("path").orderBy("_block", "_chunk").rowsBetween(W.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(F.col("end0") & ~F.col("end1"), 1).otherwise(0)).over(earlier), F.lit(0))
    # As many rows as files, whose names Spark's own listing holds in the driver already.
    files = ends.select("path").distinct().withColumn("file", F.row_number().over(W.orderBy("path")) - 1)
    start = F.shiftleft(F.col("file").cast("bigint"), FILE_BITS) + F.coalesce(F.sum("lines").over(earlier), F.lit(0))
    fixed = ends.join(files, "path").withColumns({"_turns": turns, "_shift": start})
    # What the state would be had nothing turned since the first chunk.
    settled = F.when(F.col("end0") == F.col("end1"), F.col("end0").cast("int") + F.col("_turns"))
    state = F.coalesce(F.last("_settled", ignorenulls=True).over(earlier), F.lit(0)) + F.col("_turns")
    opened = fixed.withColumn("_settled", settled).withColumn("_open", state % 2 == 1)
    end = F.when(F.col("_open"), F.col("end1")).otherwise(F.col("end0"))
    head = F.when(F.col("_open"), F.col("head1")).otherwise(F.col("head0")) - F.col("_first") + F.col("_shift")
    # An open chunk whose record began in it names the line; one that a record runs through names none.
    named = opened.withColumn("_named", F.when(end, head))
    return named.select("path", "_block", "_chunk", "_shift", "_open", F.last("_named", ignorenulls=True).over(earlier).alias("_head"))


def _records(batches: Iterator) -> Iterator:
    """The records of chunks whose entry is known. `first` is null, or the line that a record over several chunks began in."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for path, shift, opened, head, text, end0, end1 in zip(*(batch.column(c).to_pylist() for c in (
                "path", "_shift", "_open", "_head", "value", "end0", "end1"))):
            lines = pa.array(text.split("\n"), pa.string())
            [[begins, inside]] = _line_ways(lines, (opened,))
            starts = np.flatnonzero(begins)
            if not len(starts) or starts[0]:
                starts = np.concatenate([[0], starts])
            offsets = pa.array(np.append(starts, len(lines)), pa.int32())
            values = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
            firsts = np.full(len(starts), -1)
            if inside:
                firsts[-1] = starts[-1] + shift
            if opened:
                firsts[0] = head
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(starts), pa.string()), pa.array(starts + shift, pa.int64()),
                 pa.array(firsts, pa.int64(), mask=firsts < 0), values], ["path", "row_id", "first", "value"])


def _in_tasks(blocks: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Blocks far smaller than a task is worth share one; each keeps its own rows and ordinals together."""
    spark = blocks.sparkSession
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-blocks.rdd.getNumPartitions() * size // task_bytes))
    return blocks.coalesce(tasks)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """path, Filename, row_id, value: the records of text files whose quoted fields may hold line ends.

    Files are read in blocks by many tasks. Whether a block begins inside a quoted field is not known while
    it is read, so its lines are put together as they are, with what they leave open in both cases; one row per chunk
    of lines then tells which one holds, and each task cuts its own into records. Only the records that go over
    several chunks are brought together. `row_id` is the number of the file and of the record's first line; a
    carriage return before a line end outside of quotes, and empty lines, are left out.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), "value")
    chunks = stage(_in_tasks(raw).mapInArrow(_chunked, _CHUNKS), "corpus-lines")
    entries = stage(_chunk_entries(chunks), "block-entries")
    parts = _in_tasks(chunks).join(small_side(entries), ["path", "_block", "_chunk"]).mapInArrow(_records, _PARTS)
    joined = parts.filter("first IS NOT NULL").groupBy("path", "first").agg(
        F.min("row_id").alias("row_id"),
        F.array_sort(F.collect_list(F.struct("row_id", "value"))).alias("lines"))
    whole = joined.select("path", "row_id", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"))
    return parts.filter("first IS NULL").select("path", "row_id", "value").unionByName(whole).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("Filename"), "row_id",
        F.regexp_replace("value", "\r$", "").alias("value")).filter("value <> ''")


def read_corpus(spark: SparkSession, path: str, multiline: bool = True, staged: bool = True) -> DataFrame:
    """Every header-less TSV file in a folder, or several, as one frame.

    Adds `path`, `Filename` (the bare name, which files of two folders may share) and `row_id`, unique
    over all files and in their order. An empty field is a missing value. With `multiline` a quoted field
    may hold newlines; files are read in blocks either way. The rows are staged, as how files are packed
    into tasks may change from scan to scan; without `staged` only what their numbers come from is, for a
    caller that stages them itself.
    """
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in CORPUS_COLUMNS]
    if multiline:
        parsed = quoted_records(spark, path).withColumn("_r", F.from_csv("value", CORPUS_SCHEMA.simpleString()[7:-1].replace(":", " "), _CSV))
        rows = parsed.select("path", "Filename", "row_id", "_r.*")
        found = rows.select("path", "Filename", "row_id", *fields)
        if not staged:
            return found
        kept = stage(found, "corpus-rows")
        delete_staged(found)
        return kept
    raw = spark.read.schema(CORPUS_SCHEMA).options(**_CSV).csv(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("Filename"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_ordinal"), *fields)
    return number_rows(stage(rows, "corpus-rows")).select("path", "Filename", "row_id", *CORPUS_COLUMNS)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored translations from headed TSV files; further columns are left unread."""
    raw = (
        spark.read.option("header", True).option("sep", "\t")
        .option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(path)
    )
    return raw.select(
        *[F.col(f"`{c}`") for c in SCORED_COLUMNS[:2]],
        *[F.col(f"`{c}`").cast("double").alias(c) for c in SCORED_COLUMNS[2:]],
    )


def test_line_set(lines: DataFrame, col: str = "value") -> DataFrame:
    """Distinct held-out lines, outer blanks off; empty lines are skipped first."""
    return (
        lines.filter(F.col(col) != "")
        .select(F.btrim(F.col(col), F.lit(" ")).alias("line"))
        .distinct()
    )


def read_test_lines(spark: SparkSession, path: str) -> DataFrame:
    return test_line_set(spark.read.text(path))


def read_training_text(spark: SparkSession, path: str) -> DataFrame:
    """One text per line, in column `value`."""
    return spark.read.text(path)
