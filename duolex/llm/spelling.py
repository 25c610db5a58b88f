"""Spelling variants: words one letter apart, found in a trie of letter-group counts, grouped under their commonest form."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from duolex.llm.common import small_or_shuffled
from duolex.session import delete_staged, stage

# Runs of letters; only A-Z are lower-cased. All of them are one byte in Latin-1.
LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One occurrence in DAMAGE loses a letter.
DAMAGE = 97
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 5, 3, 2
# Levels of the trie, counts told apart on a level, and the first levels, which deal words to shards.
GROUPS, MOST, ROUTED = 24, 15, 3
# Words of a shard that one task stores and asks for; node or word pairs held at once.
STORED, ASKING, PAIRS = 40_000, 160_000, 1_000_000


def damaged_words(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n of all runs of letters, each as written or, by a checksum of key and run, without one letter.

    Runs shorter than LEAST_LENGTH cannot come to be words and go before anything is counted; counts combine
    in each task, so a word that makes up much of the table costs one row per task.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0)))
    each = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), runs.alias("run")).filter(
        F.length("run") >= LEAST_LENGTH).withColumn("run", F.translate("run", _UPPER, _SMALL))
    each = each.withColumn("hash", F.crc32(F.concat("key", F.lit(":"), F.col("run")).cast("binary")))
    at = (F.col("hash") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("hash") % DAMAGE == 0, cut).otherwise(F.col("run"))
    counts = each.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def letter_groups(words: DataFrame):
    """The group of each Latin-1 code: the commonest letters have one of their own, the rest share them in turn."""
    import numpy as np

    each = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    ranked = each.groupBy("letter").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "letter").collect()  # an alphabet
    groups = np.zeros(256, np.uint8)
    for rank, row in enumerate(ranked):
        groups[ord(row["letter"])] = rank % GROUPS
    return groups


def flat_letters(words: list[bytes]):
    """All letters, where each word begins, and the lengths."""
    import numpy as np

    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths


def frequency_vectors(letters, lengths, groups):
    """How often each letter group stands in each word, MOST at the most.

    An edit changes a count by one, in two groups at the most, up in one and down in the other; that holds
    for bounded counts as well.
    """
    import numpy as np

    word = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(word * GROUPS + groups[letters], minlength=len(lengths) * GROUPS)
    return np.minimum(counts, MOST).astype(np.uint8).reshape(-1, GROUPS)


class Trie:
    """Words by their counts, group by group: the nodes of a level are the distinct beginnings of the vectors.

    `child[l][node, count]` is the node below on level l + 1, or -1; `first[l]` where a node's children begin
    and `count[l]` the count of each node on the level above. Leaves have the words of equal vectors.
    """

    def __init__(self, vectors):
        import numpy as np

        self.order = np.lexsort(vectors.T[::-1])
        rows = vectors[self.order]
        self.child, self.first, self.count = [], [], []
        above = np.zeros(len(rows), np.int64)
        fresh = np.zeros(len(rows), bool)
        fresh[0] = True
        for level in range(GROUPS):
            fresh[1:] |= rows[1:, level] != rows[:-1, level]
            node = np.cumsum(fresh) - 1
            heads = np.flatnonzero(fresh)
            table = np.full((above[-1] + 1, MOST + 1), -1, np.int32)
            table[above[heads], rows[heads, level]] = node[heads]
            self.child.append(table)
            self.first.append(np.searchsorted(above[heads], np.arange(above[-1] + 2)))
            self.count.append(rows[heads, level].astype(np.int64))
            above = node
        self.start = np.append(np.flatnonzero(fresh), len(rows))


def _spread(lengths):
    """For runs of these lengths: the run of each member and its place in it."""
    import numpy as np

    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def leaf_pairs(stored: Trie, asking: Trie) -> Iterator:
    """Pairs of leaves (stored, asking) that one surplus and one deficit lead to, by depth-first search of both at once.

    A step goes from a pair of nodes to their children: of equal counts, or of counts one apart if the
    budget of that direction is not spent. Pairs wait on a stack in parts of at most PAIRS, the deepest
    go first, so what waits grows with the depth and not with the number of pairs.
    """
    import numpy as np

    root = np.zeros(1, np.int64)
    stack = [(0, root, root, np.zeros(1, bool), np.zeros(1, bool))]
    while stack:
        level, u, v, more, less = stack.pop()
        if level == GROUPS:
            yield u, v
            continue
        first = asking.first[level]
        owner, place = _spread(first[v + 1] - first[v])
        below = first[v[owner]] + place
        count = asking.count[level][below]
        parts = []
        for step in (0, 1, -1):
            ok = np.ones(len(owner), bool) if not step else ~more[owner] & (count > 0) if step > 0 else ~less[owner] & (count < MOST)
            o, b, c = owner[ok], below[ok], count[ok] - step
            node = stored.child[level][u[o], c]
            there = node >= 0
            o = o[there]
            parts.append((node[there].astype(np.int64), b[there], more[o] | (step > 0), less[o] | (step < 0)))
        new = [np.concatenate(x) for x in zip(*parts)]
        for at in range(0, len(new[0]), PAIRS // 4):
            stack.append((level + 1, *[x[at:at + PAIRS // 4] for x in new]))


def one_apart(letters, begin, lengths, a, b):
    """Whether the words at places `a` and `b` differ by exactly one letter put in, left out or replaced."""
    import numpy as np

    la, lb = lengths[a], lengths[b]
    short, need = np.minimum(la, lb), np.maximum(la, lb) - 1
    alike = np.zeros(len(a), np.int64)
    for sign in (1, -1):
        x, y = (begin[a], begin[b]) if sign > 0 else (begin[a] + la - 1, begin[b] + lb - 1)
        limit = short if sign > 0 else np.minimum(short, need - alike)
        run = np.zeros(len(a), np.int64)
        on = np.flatnonzero(limit > 0)
        k = 0
        while len(on):
            on = on[letters[x[on] + sign * k] == letters[y[on] + sign * k]]
            k += 1
            run[on] = k
            on = on[limit[on] > k]
        alike += run
        if sign > 0:
            same = (la == lb) & (run == la)
    return (np.abs(la - lb) <= 1) & ~same & (alike >= need)


def _cells(shape: tuple) -> tuple:
    """Steps between shards, one coordinate up and one down at the most, whose first coordinate that moves goes up."""
    import itertools

    steps = itertools.product((-1, 0, 1), repeat=len(shape))
    return tuple(s for s in steps if s.count(1) <= 1 and s.count(-1) <= 1 and next((x for x in s if x), 0) > 0)


def _deal(groups, homes: dict):
    """Rows of the blocks that a word is stored in or asks in, with roles: 1 stored, 2 asking, 3 both.

    Of two words whose shards differ, the one whose shard comes first asks in the other's shard; in their
    own shard words are stored and ask.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        size = (MOST + 1) ** ROUTED
        place = (MOST + 1) ** np.arange(ROUTED - 1, -1, -1)
        stored_parts, asking_parts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for shard, (s, a) in homes.items():
            stored_parts[shard], asking_parts[shard] = s, a
        for batch in batches:
            ids = batch.column(0).to_numpy()
            words = [w.as_py().encode("latin-1") for w in batch.column(2)]
            letters, _, lengths = flat_letters(words)
            cells = frequency_vectors(letters, lengths, groups)[:, :ROUTED].astype(np.int64)
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            out = []
            for step in ((0,) * ROUTED, *_cells((0,) * ROUTED)):
                there = cells + np.array(step)
                rows = np.flatnonzero(((there >= 0) & (there <= MOST)).all(axis=1))
                shard = there[rows] @ place
                real = stored_parts[shard] > 0
                rows, shard = rows[real], shard[real]
                s, a, home = stored_parts[shard], asking_parts[shard], not any(step)
                mine_s, mine_a = mixed[rows] % np.maximum(s, 1), mixed[rows] % np.maximum(a, 1)
                owner, part = _spread(s)  # asks in every part of what the shard stores
                both = (part == mine_s[owner]) if home else np.zeros(len(owner), bool)
                out.append((rows[owner], shard[owner], part, mine_a[owner], np.where(both, 3, 2), home))
                if home:  # is stored for every part of what asks
                    owner, part = _spread(a)
                    keep = part != mine_a[owner]
                    owner, part = owner[keep], part[keep]
                    out.append((rows[owner], shard[owner], mine_s[owner], part, np.full(len(owner), 1), home))
            rows = np.concatenate([o[0] for o in out])
            columns = [np.concatenate([o[i] for o in out]) for i in range(1, 5)]
            home = np.concatenate([np.full(len(o[0]), o[5]) for o in out])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.int32()), pa.array(home), *taken.columns],
                ["shard", "stored", "asking", "role", "home", "id", "n", "word"])

    return run


def near_in_block(words: list[bytes], ids, counts, role, home, groups):
    """(near words, place of the best or -1) of each word of a block, over pairs of a stored and an asking one."""
    import numpy as np

    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    order = np.lexsort((ids, -counts))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    letters, begin, lengths = flat_letters(words)
    vectors = frequency_vectors(letters, lengths, groups)
    kept, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    if len(kept) and len(asks):
        stored, asking = Trie(vectors[kept]), Trie(vectors[asks])
        kept, asks = kept[stored.order], asks[asking.order]
        for u, v in leaf_pairs(stored, asking):
            n_u, n_v = stored.start[u + 1] - stored.start[u], asking.start[v + 1] - asking.start[v]
            ends = np.cumsum(n_u * n_v)
            at = 0
            while at < len(ends):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
                owner, place = _spread((n_u * n_v)[at:to])
                owner += at
                a, b = kept[stored.start[u[owner]] + place // n_v[owner]], asks[asking.start[v[owner]] + place % n_v[owner]]
                once = ~home[b] | (ids[a] < ids[b])  # words of one shard meet twice
                a, b = a[once], b[once]
                real = one_apart(letters, begin, lengths, a, b)
                a, b = a[real], b[real]
                near += np.bincount(a, minlength=len(words)) + np.bincount(b, minlength=len(words))
                np.minimum.at(best, a, rank[b])
                np.minimum.at(best, b, rank[a])
                at = to
    return near, np.where(best < len(words), order[np.minimum(best, len(words) - 1)], -1)


def _near(groups):
    def run(table):
        import pyarrow as pa

        ids, counts = table.column("id").to_numpy(), table.column("n").to_numpy()
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        near, best = near_in_block(words, ids, counts, table.column("role").to_numpy(),
                                   table.column("home").to_numpy(zero_copy_only=False), groups)
        some = near.nonzero()[0]
        return pa.table({"id": pa.array(ids[some]), "n_near": pa.array(near[some]), "best_n": pa.array(counts[best[some]]),
                         "best": pa.array(ids[best[some]])})

    return run


def near_words(words: DataFrame) -> DataFrame:
    """id, n_near, best_n, best of the words (id, n, word; letters of LETTERS) that have near ones.

    `best` is the near word of largest n, the smallest id among equals. The first levels of the trie deal
    words to shards; a word asks in the shards that one surplus and one deficit lead to, and the sizes of
    the shards, at most 4,096 numbers, say which there are and into how many blocks each is cut.
    """
    groups = letter_groups(words)

    def shards(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        place = (MOST + 1) ** np.arange(ROUTED - 1, -1, -1)
        for batch in batches:
            letters, _, lengths = flat_letters([w.as_py().encode("latin-1") for w in batch.column(0)])
            found, n = np.unique(frequency_vectors(letters, lengths, groups)[:, :ROUTED].astype(np.int64) @ place, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["shard", "n"])

    sizes = words.select("word").mapInArrow(shards, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    homes = {r["shard"]: (-(-r["n"] // STORED), -(-r["n"] // ASKING)) for r in sizes.collect()}
    dealt = words.select("id", "n", "word").mapInArrow(
        _deal(groups, homes), "shard long, stored long, asking long, role int, home boolean, id long, n long, word string")
    found = dealt.groupBy("shard", "stored", "asking").applyInArrow(_near(groups), "id long, n_near long, best_n long, best long")
    return found.groupBy("id").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")).select(
        "id", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root of the words that have a form: each round follows twice as many forms as the one before."""
    now = stage(forms.select("id", F.col("form").alias("root")), "form-ends")
    while True:
        ahead = now.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        new = stage(now.join(small_or_shuffled(ahead), F.col("root") == F.col("_id"), "left").select(
            "id", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "form-ends")
        delete_staged(now)
        now = new.select("id", "root")
        if new.filter("moved").isEmpty():
            return now


def group_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Words come from `damaged_words`: letters of LETTERS, at least LEAST_LENGTH of them and LEAST_COUNT uses; a null text has none, a
    null key counts as an empty one, rows count as often as they repeat. Words are near if one letter put in,
    left out or replaced makes one the other. `form` is the near word with most uses, the first by code point
    among equals, if it has FORM_TIMES as many as the word, else null; `root` the end of the chain of forms, the
    word itself without one. Uses at least double along a chain, so it ends. `n_near` counts near words,
    `form_n` the form's uses. An empty table gives no rows.
    """
    counted = damaged_words(df, key, text).select("word", "n")
    ordered = counted.repartitionByRange("word").sortWithinPartitions("word")
    words = stage(ordered.withColumn("id", F.monotonically_increasing_id()), "words")  # ids in order of code points
    near = stage(words.select("id", "n").join(near_words(words).hint("shuffle_merge"), "id", "left").select(
        "id", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= FORM_TIMES * F.col("n"), F.col("best")).alias("form")), "near-words")
    roots = _roots(near.filter("form is not null"))
    ends = near.join(small_or_shuffled(roots), "id", "left")
    names = words.select(F.col("id").alias("_id"), F.col("word").alias("name"), F.col("n").alias("uses"))
    named = stage(ends.filter("form is not null").join(names.hint("shuffle_merge"), F.col("form") == F.col("_id")).select(
        "id", F.col("name").alias("form"), F.col("uses").alias("form_n"), F.col("root").alias("end")), "forms")
    named = named.join(names.select("_id", F.col("name").alias("root")).hint("shuffle_merge"), F.col("end") == F.col("_id")).select(
        "id", "form", "form_n", "root")
    whole = words.join(near.select("id", "n_near").hint("shuffle_merge"), "id").join(named.hint("shuffle_merge"), "id", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
