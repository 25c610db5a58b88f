"""Near duplicates by MinHash: circulant signatures, bands, exact Jaccard similarity of whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from duolex.llm.common import small_or_shuffled, text_mark
from duolex.llm.components import connected_components
from duolex.session import stage

SHINGLE = 3
# Links have 100 * common >= PERCENT * all shingles of both.
PERCENT = 85
# A pair at 0.85 shares no band of five of these 150 coordinates once in 40 million cases.
BANDS, BAND_ROWS = 30, 5
# Shingles of texts hashed at once, of a row's coordinates worked out at once, and of one side of a comparison.
AT_ONCE, SPAN, BLOCK = 400_000, 32_768, 2_000_000
# Most pairs of a row and a comparison that are counted at once.
POSTED = 4_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text: str | None, shingle: int = SHINGLE):
    """Sorted distinct 64-bit hashes of the runs of `shingle` words; the whole sequence if there are fewer, none without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(each) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ each[i:n + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _permuted(x):
    """A permutation of the 32-bit numbers, in place."""
    import numpy as np

    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list, coordinates: int = BANDS * BAND_ROWS):
    """A row of `coordinates` 32-bit numbers for each of some non-empty shingle sets.

    The upper half of a shingle's hash is its place after the first permutation. Coordinate k is the least
    value of the second permutation, shifted by k places around the circle of 2^32, at the places of a set.
    """
    import numpy as np

    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    places = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(places), SPAN):  # parts of the places that fit a processor's cache
        part = places[lo:lo + SPAN]
        first = np.searchsorted(starts, lo, side="right") - 1
        last = np.searchsorted(starts, lo + len(part), side="left")
        cuts = np.maximum(starts[first:last] - lo, 0)
        for k in range(coordinates):
            least = np.minimum.reduceat(_permuted(part + np.uint32(k)), cuts)
            np.minimum(out[first:last, k], least, out=out[first:last, k])
    return out


def band_keys(signature, rows: int = BAND_ROWS):
    """One 64-bit key for each band of `rows` coordinates; the number of the band is part of it."""
    import numpy as np

    bands = signature.astype(np.uint64).reshape(len(signature), -1, rows)
    out = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(rows):
        out = (out ^ bands[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _read_rows(batches: Iterator) -> Iterator:
    """Number of shingles, digest of the set and band keys of each text; texts without shingles have neither."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_128_digest

    def flush(keys, marks, sets):
        some = [s for s in sets if len(s)]
        found = iter(band_keys(signatures(some)).view(np.int64)) if some else iter(())
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), pa.array(marks, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([next(found) if len(s) else None for s in sets], pa.list_(pa.int64()))],
            ["key", "_mark", "n", "digest", "bands"])

    for batch in batches:
        keys, marks, sets, held = [], [], [], 0
        for key, mark, text in zip(*batch.columns):
            found = shingle_set(text.as_py())
            keys.append(key.as_py())
            marks.append(mark.as_py())
            sets.append(found)
            held += len(found)
            if held > AT_ONCE:
                yield flush(keys, marks, sets)
                keys, marks, sets, held = [], [], [], 0
        if keys:
            yield flush(keys, marks, sets)


def _read_sets(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(0, len(batch), 256):
            sets = [shingle_set(t.as_py()).tobytes() for t in batch.column(1)[at:at + 256]]
            yield pa.RecordBatch.from_arrays([batch.column(0)[at:at + 256], pa.array(sets, pa.binary())], ["row", "shingles"])


def similar(common, a, b):
    """Whether sets of sizes `a` and `b` with `common` shingles in common link."""
    return 100 * common >= PERCENT * (a + b - common)


def _verify(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        a, b = [], []
        for row, other, mine, theirs in zip(*batch.columns):
            x, y = np.frombuffer(mine.as_buffer(), np.uint64), np.frombuffer(theirs.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            if similar(int((y[at] == x).sum()), len(x), len(y)):
                a.append(row.as_py())
                b.append(other.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links_between(sets: list, labels, left, right):
    """(place, place) of linked sets of different labels, one in `left` and one in `right` (places, may overlap).

    Shingles of the right side are posted with the sets that hold them; each set of the left side counts
    what it meets. Once a set has met a label, its other links to that label change no component.
    """
    import numpy as np

    if not len(left) or not len(right):
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([sets[i] for i in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    found = []
    for i in left:
        lo, hi = np.searchsorted(flat, sets[i], side="left"), np.searchsorted(flat, sets[i], side="right")
        lengths = hi - lo
        common = np.zeros(len(right), np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):  # a very common shingle is counted in parts of bounded size
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTED, side="right")))
            n = lengths[at:to]
            places = np.repeat(lo[at:to] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            common += np.bincount(owner[places], minlength=len(right))
            at = to
        near = np.flatnonzero(similar(common, sizes[i], sizes[right]) & (labels[right] != labels[i]))
        if len(near):
            _, first = np.unique(labels[right[near]], return_index=True)
            found += [(i, right[near[j]]) for j in first]
    return found


def _compare(table):
    """Links of one block of a bucket, between the rows of its two parts whose labels differ."""
    import numpy as np
    import pyarrow as pa

    table = table.combine_chunks()
    rows, labels = table.column("row").to_numpy(), table.column("label").to_numpy()
    second = table.column("second").to_numpy(zero_copy_only=False)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
    left, right = np.flatnonzero(~second), np.flatnonzero(second)
    if not len(right):
        right = left
    values, counts = np.unique(labels[right], return_counts=True)
    if len(values) == 1 or right is left:  # rows of the only, or the largest, label need not ask for each other
        left = left[labels[left] != values[counts.argmax()]]
    found = links_between(sets, labels, left, right)
    return pa.table({"a": pa.array([rows[i] for i, _ in found], pa.int64()), "b": pa.array([rows[j] for _, j in found], pa.int64())})


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """band, row, label, n of the buckets where rows of different components have not been compared yet.

    All rows of a bucket have been compared with its first row, so only the others count. Buckets with
    the same rows are one.
    """
    rest = members.filter("row <> other")
    labelled = rest.join(small_or_shuffled(roots), F.col("row") == F.col("node"), "left").select(
        "band", "row", "n", F.coalesce("root", "row").alias("label"))
    labelled = stage(labelled, "labelled")
    open_buckets = labelled.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("shingles")).filter("low < high")
    once = open_buckets.groupBy("rows", "sum").agg(F.min(F.struct("band", "shingles")).alias("b"))
    parts = F.ceil(F.col("b.shingles") / BLOCK).cast("int")
    chosen = small_or_shuffled(stage(once.select(F.col("b.band").alias("_band"), parts.alias("parts")), "open-buckets"))
    return labelled.join(chosen, F.col("band") == F.col("_band")).drop("_band")


def _links_in_buckets(open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within buckets; large ones are dealt to blocks, each of two parts of the bucket."""
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = open_rows.withColumn("part", part).withColumn("with", other).select(
        "row", "label", F.struct("band", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j")).alias("block"),
        (F.col("part") > F.col("with")).alias("second"))
    held = dealt.hint("shuffle_merge").join(sets.hint("shuffle_merge"), "row")
    return held.groupBy("block").applyInArrow(_compare, "a long, b long")


def _sets_of(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """row, shingles of the rows wanted (row, key, _mark), read again from their texts."""
    k, m = "_wanted_key", "_wanted_mark"
    asked = small_or_shuffled(stage(wanted.select("row", F.col("key").alias(k), F.col("_mark").alias(m)), "wanted"))
    rows = df.select(F.col(key).cast("bigint").alias("key"), text_mark(text).alias("_mark"), F.col(text).alias("text"))
    found = rows.join(asked, (F.col("_mark") == F.col(m)) & F.col("key").eqNullSafe(F.col(k)))
    read = found.select("row", "text").mapInArrow(_read_sets, "row long, shingles binary")
    return stage(read.groupBy("row").agg(F.first("shingles").alias("shingles")), "sets")


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, kept of every row.

    A row's set are the distinct runs of SHINGLE words, A-Z in lower case, words parted by ASCII white space;
    a text of fewer words is one shingle, and one without words, or null, links with nothing. Rows link
    where PERCENT per cent of all shingles of both are common, counted on the whole sets. `component_id` is
    the least key reachable, one's own included; rows without key belong to their component but never name
    it (null where no row of it has one). `kept` marks the rows whose key is that, or the first row read
    where it is null. Rows that repeat a key are told apart; an empty table gives no rows.

    Rows of one set are one node. Signatures come from two permutations, the second shifted around; a band
    of equal coordinates is a bucket. Each node is compared with the first one of each of its buckets, one
    candidate per bucket. Where that leaves rows of a bucket in different components they are compared with
    each other, in blocks of bounded size; pairs are never emitted, and rows of one component not compared.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), text_mark(text).alias("_mark"), F.col(text).alias("text"))
    read = rows.mapInArrow(_read_rows, "key long, _mark long, n long, digest binary, bands array<long>")
    docs = stage(read.withColumn("row", F.monotonically_increasing_id()), "signatures")
    copies = docs.filter("digest is not null").groupBy(F.col("digest").alias("_digest")).agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    copies = small_or_shuffled(stage(copies, "copies"), 500_000)
    facts = docs.select("row", "key", "_mark", "n", "digest")
    nodes = stage(facts.join(copies, F.col("digest") == F.col("_digest"), "left").select(
        "row", "key", "_mark", "n", F.coalesce("first", "row").alias("node")), "nodes")
    later = small_or_shuffled(stage(nodes.filter("row <> node").select(F.col("row").alias("_row")), "later-copies"))
    bands = docs.select("row", "n", "bands").join(later, F.col("row") == F.col("_row"), "left_anti").select(
        "row", "n", F.explode("bands").alias("band"))
    shared = bands.groupBy(F.col("band").alias("_band")).agg(
        F.min("row").alias("other"), F.max("row").alias("last")).filter("other < last").drop("last")
    shared = small_or_shuffled(stage(shared, "shared-bands"), 500_000)
    members = stage(bands.join(shared, F.col("band") == F.col("_band")).select("band", "row", "n", "other"), "members")
    wanted = members.select(F.col("row").alias("_row")).distinct()
    wanted = nodes.join(wanted, F.col("row") == F.col("_row"), "left_semi")
    sets = _sets_of(df, wanted, key, text)
    pairs = members.filter("row <> other").select("row", "other").distinct()
    theirs = sets.select(F.col("row").alias("_other"), F.col("shingles").alias("theirs"))
    both = pairs.hint("shuffle_merge").join(sets.hint("shuffle_merge"), "row").hint("shuffle_merge").join(
        theirs.hint("shuffle_merge"), F.col("other") == F.col("_other")).select("row", "other", "shingles", "theirs")
    links = stage(both.mapInArrow(_verify, "a long, b long"), "links")
    open_rows = stage(_unsettled(members, stage(connected_components(links, "a", "b"), "roots")), "open-rows")
    if not open_rows.isEmpty():
        links = stage(links.unionByName(_links_in_buckets(open_rows, sets)), "all-links")
    roots = small_or_shuffled(stage(connected_components(links, "a", "b"), "roots").select(F.col("node").alias("_node"), "root"))
    rooted = stage(nodes.join(roots, F.col("node") == F.col("_node"), "left").select(
        "row", "key", "n", F.coalesce("root", "node").alias("root")), "rooted")
    first = rooted.groupBy(F.col("root").alias("_root")).agg(
        F.min("key").alias("component_id"), F.min("row").alias("first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    first = small_or_shuffled(stage(first.drop("_n"), "first-rows"), 500_000)
    named = rooted.join(first, F.col("root") == F.col("_root"), "left")
    name, row = F.coalesce("component_id", "key"), F.coalesce("first", "row")
    return named.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), name.alias("component_id"),
        F.coalesce(F.col("key") == name, name.isNull() & (F.col("row") == row)).alias("kept"))
