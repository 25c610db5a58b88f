"""Near duplicates by SimHash: fingerprints, vantage-point shards, exact pairs within a few bits."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from duolex.llm.common import repeat_rows, row_mark, small_or_shuffled
from duolex.llm.components import connected_components
from duolex.session import stage

SHINGLE = 3
SEED = 42
BITS = 3
# Fingerprints that call a shard their home; shards are a power of two between LEAST and MOST.
HOME = 8192
LEAST_SHARDS, MOST_SHARDS = 32, 4096
# Fingerprints per shard in the sample that lays out the tree; never more than an eighth of all.
SAMPLE_PER_SHARD = 64
# What one comparison task holds: home fingerprints times visiting ones.
HOME_BLOCK, VISIT_BLOCK = 65_536, 262_144
# Pairs held before they are folded into one link per fingerprint.
PAIRS = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set where over half of the shingles' hashes have it, as a signed number.

    Words are runs without ASCII white space, A-Z in lower case; shingles count as often as they occur. A
    text of fewer words is one shingle; null and empty texts have no shingle and get zero.
    """
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        hashes = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        some = np.array(hashes[at:at + 100_000], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprint_rows(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [fingerprint(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["key", "_mark", "fp"])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, _mark, fp of every row; texts are read once and left behind."""
    rows = df.select(F.col(key).cast("bigint").alias("key"), row_mark(df).alias("_mark"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprint_rows, "key long, _mark long, fp long")


def build_tree(sample, depth: int):
    """A vantage-point tree as nested (point, radius, inside, outside); a leaf is None.

    The point is the one of a few whose distances to the others vary most, the radius their median.
    """
    import numpy as np

    if not depth:
        return None
    if len(sample) < 2:  # nothing to learn from: cut the space where it is cut evenly
        point, radius = np.uint64((0x9E3779B97F4A7C15 * (depth + 1)) & (2 ** 64 - 1)), 32
        return point, radius, build_tree(sample, depth - 1), build_tree(sample, depth - 1)
    tried = sample[:: max(1, len(sample) // 8)][:8]
    away = np.bitwise_count(tried[:, None] ^ sample[None, :]).astype(np.int64)
    best = int(away.var(axis=1).argmax())
    radius = int(np.median(away[best]))
    inside = away[best] <= radius
    return tried[best], radius, build_tree(sample[inside], depth - 1), build_tree(sample[~inside], depth - 1)


def visits(tree, depth: int, fps, bits: int) -> list[tuple]:
    """(shard, places in `fps`, whether it is their home) for every shard within `bits` of a fingerprint.

    By the triangle inequality, what lies within `bits` of x and inside the radius is at most radius + bits
    from the point if x is; a branch is left out where no such fingerprint can be.
    """
    import numpy as np

    out = []

    def down(node, level: int, shard: int, places, home):
        if not len(places):
            return
        if node is None:
            out.append((shard, places, home))
            return
        point, radius, inside, outside = node
        away = np.bitwise_count(fps[places] ^ point)
        near, far = away <= radius + bits, away.astype(np.int64) > radius - bits
        down(inside, level - 1, shard, places[near], home[near] & (away[near] <= radius))
        down(outside, level - 1, shard | 1 << (level - 1), places[far], home[far] & (away[far] > radius))

    down(tree, depth, 0, np.arange(len(fps)), np.ones(len(fps), bool))
    return out


def _route(tree, depth: int, bits: int, home_parts: int, visit_parts: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            part = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            blocks, found, homes = [], [], []
            for shard, places, home in visits(tree, depth, fps, bits):
                own = places[home]
                for v in range(visit_parts):
                    blocks.append((shard * home_parts + (part[own] % np.uint64(home_parts)).astype(np.int64)) * visit_parts + v)
                    found.append(fps[own])
                    homes.append(np.ones(len(own), bool))
                for h in range(home_parts):
                    blocks.append((shard * home_parts + h) * visit_parts + (part[places] % np.uint64(visit_parts)).astype(np.int64))
                    found.append(fps[places])
                    homes.append(np.zeros(len(places), bool))
            if blocks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(blocks)), pa.array(np.concatenate(found).view(np.int64)),
                     pa.array(np.concatenate(homes))], ["block", "fp", "home"])

    return run


def merge_pairs(n: int, a, b):
    """The least place that each of `n` places reaches over the pairs (a, b)."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def link_block(home, visiting, bits: int):
    """Fingerprints with a partner within `bits`, and the least one that each reaches in this block.

    Every home fingerprint meets the visiting ones whose distance to a vantage point differs from its own
    by at most `bits`. Pairs are folded into one link per fingerprint whenever many have come up, so a
    dense group needs no more room than a sparse one.
    """
    import numpy as np

    nodes = np.unique(np.concatenate([home, visiting]))
    point = home[0]
    away = np.bitwise_count(visiting ^ point).astype(np.int64)
    order = np.argsort(away, kind="stable")
    visiting, away = visiting[order], away[order]
    of_home = np.bitwise_count(home ^ point).astype(np.int64)
    left, right, held = [], [], 0

    def fold():
        label = merge_pairs(len(nodes), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return [moved], [label[moved]]

    for distance in np.unique(of_home):
        own = home[of_home == distance]
        lo, hi = np.searchsorted(away, [distance - bits, distance + bits + 1])
        others = visiting[lo:hi]
        step = max(1, 2_000_000 // max(1, len(others)))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            i, j = np.nonzero(np.bitwise_count(some[:, None] ^ others[None, :]) <= bits)
            differ = some[i] != others[j]
            i, j = i[differ], j[differ]
            if len(i):
                left.append(np.searchsorted(nodes, some[i]))
                right.append(np.searchsorted(nodes, others[j]))
                held += len(i)
                if held > PAIRS:
                    left, right = fold()
                    held = len(left[0])
    if not left:
        return nodes[:0], nodes[:0]
    left, right = fold()
    return nodes[left[0]], nodes[right[0]]


def _link(bits: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        fps = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        own, rest = np.unique(fps[home]), np.unique(fps[~home])
        a, b = link_block(own, rest, bits) if len(own) else (own, own)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return run


def near_links(fps: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """a, b: links over which all fingerprints within `bits` of each other are connected.

    `fps` has `n` distinct, non-null fingerprints in column `fp`. A tree of vantage points, laid out on a
    bounded sample, deals them to shards; each goes to its home and to every shard that its ball of radius
    `bits` touches, so a pair meets at the home of either. A shard gives one link per fingerprint, never
    all pairs. Blocks of a shard bound what a task holds when shards outgrow the sample.
    """
    import numpy as np

    depth = (LEAST_SHARDS - 1).bit_length()
    while 2 ** depth * HOME < n and 2 ** depth < MOST_SHARDS:
        depth += 1
    every = max(8, n // (SAMPLE_PER_SHARD * 2 ** depth))
    seen = fps.filter(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(every)) == 0).toPandas()["fp"]
    sample = np.sort(seen.to_numpy(np.int64)).view(np.uint64)
    tree = build_tree(sample, depth)
    per_shard = n / 2 ** depth
    touched = sum(len(p) for _, p, _ in visits(tree, depth, sample, bits)) / max(1, len(sample))
    home_parts = max(1, round(per_shard / HOME_BLOCK))
    visit_parts = max(1, round(per_shard * max(1.0, touched) / VISIT_BLOCK))
    routed = fps.select("fp").mapInArrow(
        _route(tree, depth, bits, home_parts, visit_parts), "block long, fp long, home boolean")
    return routed.groupBy("block").applyInArrow(_link(bits), "a long, b long")


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """key, fingerprint, component_id, _mark, _root of every row.

    Fingerprints link at `bits` or fewer differing bits; `component_id` is the least key reachable, one's
    own included. Copies share a fingerprint and so count once until the end. Rows without key belong to
    their component but never name it. Keys may repeat; `_root`, the least fingerprint reachable, is what
    tells components apart. An empty table gives no rows.
    """
    docs = stage(fingerprints(df, key, text), "fingerprints")
    fps = stage(docs.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fp")
    n = fps.count()
    if not n:
        return docs.select(F.col("key").alias(key), F.lit("").alias("fingerprint"), F.col("key").alias("component_id"), "_mark",
                           F.col("fp").alias("_root"))
    roots = connected_components(stage(near_links(fps, n, bits), "near-links"), "a", "b")
    rooted = fps.join(small_or_shuffled(roots), F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first", "n", F.col("root").isNotNull().alias("linked"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("_n")).filter("_n > 1")
    firsts = small_or_shuffled(stage(firsts, "first-of-group").select(F.col("root").alias("_root"), "component_id"))
    shared = stage(rooted.join(firsts, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "_root", "component_id"), "groups")
    return docs.join(small_or_shuffled(shared), F.col("fp") == F.col("_fp"), "left").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "key").alias("component_id"), "_mark", F.coalesce("_root", "fp").alias("_root"))


def drop_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """`df` with one row of each group: that of the least key (null last); columns as they were."""
    groups = stage(near_groups(df, key, text, bits), "near-groups")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("_mark"))
    first = groups.groupBy("_root").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    first = small_or_shuffled(stage(first.select(F.col("_root").alias("_g"), "_first"), "first-rows"))
    kept = groups.join(first, F.col("_root") == F.col("_g"), "left").select(
        key, "_mark", F.coalesce(order == F.col("_first"), F.lit(True)).cast("int").alias("copies"))
    return repeat_rows(df, kept, key, most=1)
