"""Exact top-k by inner product, without random access: sorted lists, score bounds, early stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from duolex.session import stage

K = 20
# Rows and queries that meet in one task.
ROWS, QUERIES = 8192, 4096
# Queries that read the lists together, and the shares of the lists after which bounds are compared.
TOGETHER = 256
DEPTHS = (0.25, 0.5, 0.75, 0.875, 0.9375)
PAIRS = 200_000


def whole_numbers(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component as doubles; null where the vector or a component is null or not finite."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda v: F.lit(float(scale)) * v)
    # Beyond 2^53 a double has no fraction, so that its floor is itself; floor() would leave the range of a long.
    return F.when(finite, F.transform(
        scaled, lambda v: F.when(F.abs(v) < F.lit(2.0 ** 53), F.floor(v).cast("double")).otherwise(v)))


def _matrix(column, width: int):
    """The rows of a list column; shorter ones are filled up with zeros."""
    import numpy as np

    ends = column.offsets.to_numpy().astype(np.int64)
    lengths, values = np.diff(ends), column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], lengths)] = values[ends[0]:ends[-1]]
    return out


def _exact_kind(queries, rows):
    """The cheapest number type in which no sum of products is rounded."""
    import numpy as np

    most = float(abs(queries).max(initial=0)) * float(abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2 ** 24:
        return queries.astype(np.float32), rows.astype(np.float32)
    if most < 2 ** 53:
        return queries, rows
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries), whole(rows)


def bounds(queries, rows, lists, depth: int):
    """Lower and upper bounds of all scores once `depth` entries of each list are read.

    Each component has a list in falling order for positive query components and one in rising order for
    negative ones; `lists` holds both as one sorted matrix. An entry not yet read is at best as good as the
    last one read and at worst as bad as the end of its list.
    """
    import numpy as np

    n = len(lists)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    falling, rising = lists[n - depth], lists[depth - 1]
    lower = up @ np.where(rows >= falling, rows, lists[0]).T + down @ np.where(rows <= rising, rows, lists[-1]).T
    upper = up @ np.maximum(rows, falling).T + down @ np.minimum(rows, rising).T
    return lower, upper


def search_block(queries, query_place, rows, row_ids, k: int = K):
    """(query, row, score) of the `k` best rows of each query; ties go to the smaller id.

    `query_place` is the place of a query's own row, or -1. Lists are read in step; a row stays while its
    upper bound reaches the k-th best lower bound. When few stay, or the lists end, final scores are
    resolved for those alone.
    """
    import numpy as np

    queries, rows = _exact_kind(queries, rows)
    n = len(rows)
    lists = np.sort(rows, axis=0)
    ladder = [d for d in sorted({max(1, int(n * s)) for s in DEPTHS} | {n})]
    found = []
    for at in range(0, len(queries), TOGETHER):
        some, own = queries[at:at + TOGETHER], query_place[at:at + TOGETHER]
        mine = np.flatnonzero(own >= 0)
        alive = np.ones((len(some), n), bool)
        alive[mine, own[mine]] = False
        for depth in ladder if n > k + 1 else ():
            kept = np.flatnonzero(alive.any(axis=0))  # columns that any of these queries still asks for
            lower, upper = bounds(some, rows[kept], lists, depth) if depth < n else (
                (exact := some @ rows[kept].T), exact)
            lower = np.where(alive[:, kept], lower, -np.inf)
            if lower.shape[1] > k:
                level = np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
                alive[:, kept] &= upper >= level[:, None]
            if alive.sum() <= 3 * k * len(some):
                break
        q, r = np.nonzero(alive)
        scores = np.concatenate([(some[q[i:i + PAIRS]] * rows[r[i:i + PAIRS]]).sum(axis=1) for i in range(0, len(q), PAIRS)]
                                or [np.zeros(0)])
        order = np.lexsort((row_ids[r], (-scores).astype(float), q))
        q, r, scores = q[order], r[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < k
        found.append((q[best] + at, r[best], scores[best]))
    return [np.concatenate(x) for x in zip(*found)]


def _search(k: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        asked = table.column("asked").to_numpy(zero_copy_only=False)
        vectors = table.column("vector").combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        width = int(np.diff(vectors.offsets.to_numpy()).max(initial=0))
        matrix = _matrix(vectors, width)
        rows = table.column("row").to_numpy()
        ids = table.column("id")
        known = ids.fill_null(0).to_numpy()
        here = np.flatnonzero(~asked)
        here = here[np.argsort(rows[here], kind="stable")]
        ask = np.flatnonzero(asked)
        names = ["query_row", "query_id", "vec_id", "score"]
        kinds = [pa.int64()] * 4
        if not len(here) or not len(ask):
            return pa.table([pa.array([], t) for t in kinds], names)
        place = np.searchsorted(rows[here], rows[ask])
        place = np.where(rows[here][np.minimum(place, len(here) - 1)] == rows[ask], place, -1)
        nulls = ids.is_null().to_numpy()[here]
        q, r, scores = search_block(matrix[ask], place, matrix[here], np.where(nulls, np.iinfo(np.int64).max, known[here]), k)
        most = np.iinfo(np.int64)
        scores = [min(max(int(s), most.min), most.max) for s in scores]
        return pa.table([pa.array(rows[ask][q]), pa.array(known[ask][q]),
                         pa.array(known[here][r], mask=nulls[r]), pa.array(scores, pa.int64())], names)

    return run


def top_k(df: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` best other rows of each row for which `asked` holds.

    Scores are integer inner products of floor(scale * x), at the limits of a long where they pass them.
    Ties go to the smaller id, null last. Vectors that are null or hold null or non-finite components take
    no part; a vector shorter than others counts as filled up with zeros. Rows that repeat an id are rows
    of their own, and each that is asked gets its ranks.

    Rows and queries meet in blocks of bounded size, each of which runs the search on its own sorted lists;
    the blocks' best are then ranked. No table is broadcast or gathered.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), whole_numbers(vector, scale).alias("vector"),
                     F.coalesce(asked, F.lit(False)).alias("asked")).filter("vector is not null")
    staged = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_asked = staged.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    shards, groups = max(1, -(-n // ROWS)), max(1, -(-n_asked // QUERIES))
    shard, group = F.pmod(F.xxhash64("row"), F.lit(shards)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups))
    to_groups = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: shard * groups + g)
    to_shards = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s * groups + group)
    fields = ["id", "vector", "row"]
    dealt = staged.select(F.explode(to_groups).alias("block"), *fields, F.lit(False).alias("asked")).unionByName(
        staged.filter("asked").select(F.explode(to_shards).alias("block"), *fields, F.lit(True).alias("asked")))
    best = dealt.groupBy("block").applyInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
