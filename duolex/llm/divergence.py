"""How far the sources of a language differ in their words: term counts in Arrow, divergences over merged shards."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from duolex.session import small_side, stage

# ASCII characters that end a term; A-Z, a-z and all others are part of one.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
# Documents of a language that must hold a term; terms that a group's report names.
LEAST_DOCS, TOP = 10, 10
# Shares are whole parts of 1000 ^ UNIT_STEPS of counts raised by RAISED.
UNIT_STEPS, RAISED = 3, 2
# Texts counted at once, and rows of partial counts that a task holds before it hands them on.
TEXTS, HELD = 1_000, 600_000
# Numbers of a divergence block that a task holds at once.
CELLS = 4_000_000


def count_terms(batches: Iterator) -> Iterator:
    """lang, source, term, n, docs of batches of (lang, source, text): counts of each group's terms, in Arrow alone.

    Each group that occurs has a row without term as well, of no counts, so that one without words is known.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["lang", "source", "term"]
    schema = pa.schema([*((n, pa.string()) for n in names), ("n", pa.int64()), ("docs", pa.int64())])

    def counted(part) -> pa.Table:
        lang, source = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
        lists = pc.split_pattern_regex(pc.ascii_lower(part.column(2).cast(pa.large_string())), pattern=BREAKS)
        terms = pc.list_flatten(lists)
        doc = pc.list_parent_indices(lists)
        real = pc.not_equal(pc.binary_length(terms), 0)
        term, doc = terms.filter(real).dictionary_encode(), doc.filter(real)
        each = pa.table({"doc": doc, "term": term.indices}).group_by(["doc", "term"]).aggregate([([], "count_all")])
        sums = pa.table({"lang": lang.indices.take(each["doc"]), "source": source.indices.take(each["doc"]), "term": each["term"],
                         "n": each["count_all"]}).group_by(names).aggregate([("n", "sum"), ("n", "count")])
        seen = pa.table({"lang": lang.indices, "source": source.indices}).group_by(names[:2]).aggregate([])
        zeros = pa.array([0] * len(seen), pa.int64())
        return pa.concat_tables([
            pa.table([pc.take(lang.dictionary, sums["lang"]), pc.take(source.dictionary, sums["source"]),
                      pc.take(term.dictionary, sums["term"]).cast(pa.string()), sums["n_sum"], sums["n_count"]], schema=schema),
            pa.table([pc.take(lang.dictionary, seen["lang"]), pc.take(source.dictionary, seen["source"]),
                      pa.nulls(len(seen), pa.string()), zeros, zeros], schema=schema)])

    def merged(tables: list) -> pa.Table:
        sums = pa.concat_tables(tables).group_by(names).aggregate([("n", "sum"), ("docs", "sum")])
        return pa.table([sums[c] for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=schema)

    held, rows = [], 0
    for batch in batches:
        for at in range(0, len(batch), TEXTS):
            # A copy: kernels that write texts go wrong on a part of an array in some versions of Arrow.
            held.append(counted(batch.take(pa.array(range(at, min(at + TEXTS, len(batch)))))))
            rows += len(held[-1])
            if rows > HELD:
                held = [merged(held)]
                rows = len(held[0])
                if rows > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=100_000)
                    held, rows = [], 0
    if held:
        yield from merged(held).to_batches(max_chunksize=100_000)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * count / total), exact for counts below 9 * 10^15: three digits at a time."""
    out, rest = F.lit(0).cast("bigint"), count
    for _ in range(UNIT_STEPS):
        out = out * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _shares(counts, total: int):
    """The same for an array of counts."""
    out, rest = 0, counts
    for _ in range(UNIT_STEPS):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return out + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_table(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, n, sources, counts of each kept term, and a row without term with all sources of each language.

    Partial counts of tasks meet once, dealt by language and term; what a key gathers is a row per source. The
    result is staged, a row per term, its counts in arrays.
    """
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = rows.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    merged = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    shards = merged.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("each"))
    kept = shards.filter(F.col("term").isNull() | (F.col("docs") >= least_docs))
    return stage(kept.select("lang", "term", "n", F.col("each.source").alias("sources"), F.col("each.n").alias("counts")), "terms")


def _groups(terms: DataFrame) -> DataFrame:
    """lang, source, total, lang_total, v of every group: words of kept terms in it and in its language, kept terms."""
    entries = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    totals = entries.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("term").alias("v"))
    return stage(totals.join(langs, "lang").select("lang", "source", "total", "lang_total", "v"), "groups")


def _summed(facts: dict):
    """Sums, over the terms of its rows, of what each pair of sources differs beyond two that lack a term.

    `facts` has the sources of each language, their totals and the number of terms. Terms that few sources
    hold cost little: only rows of sources that hold one are worked out.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sums: dict = {}

        def add(lang: str, part):
            sources, totals, v = facts[lang]
            size = len(sources)
            total = totals + RAISED * v
            none = _shares(np.full(size, RAISED, np.int64), total)
            empty = (none[:, None] - none) ** 2 // (none[:, None] + none)
            if lang not in sums:
                sums[lang] = np.zeros((size, size), np.int64)
            lists = part.column("sources")
            term = pc.list_parent_indices(lists).to_numpy()
            at = pc.index_in(pc.list_flatten(lists), value_set=pa.array(sources, pa.string())).to_numpy()
            counts = pc.list_flatten(part.column("counts")).to_numpy()
            dense = np.zeros((len(part), size), np.int64)
            dense[term, at] = counts
            share = _shares(dense + RAISED, total)
            step = max(1, CELLS // size)
            for lo in range(0, len(term), step):
                t, s = term[lo:lo + step], at[lo:lo + step]
                mine, others = share[t, s][:, None], share[t]
                more = (mine - others) ** 2 // (mine + others) - empty[s]
                lacking = np.where(dense[t] == 0, more, 0)
                np.add.at(sums[lang], s, more)
                back = np.zeros((size, size), np.int64)
                np.add.at(back, s, lacking)
                sums[lang] += back.T

        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                part = batch.filter(pc.equal(batch.column("lang"), lang))
                step = max(1, CELLS // len(facts[lang][0]))
                for lo in range(0, len(part), step):
                    add(lang, part.slice(lo, step))
        for lang, found in sums.items():
            names = pa.array(facts[lang][0], pa.string())
            for i in range(len(names)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names)), pa.array([names[i].as_py()] * len(names)), names, pa.array(found[i])],
                    ["lang", "source", "item", "more"])

    return run


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of each source with every other one of its language.

    What goes to the tasks is a number per group; the result has one per pair of groups.
    """
    import numpy as np

    facts: dict = {}
    for r in groups.toLocalIterator():
        facts.setdefault(r["lang"], ([], [], r["v"]))[0].append(r["source"])
        facts[r["lang"]][1].append(r["total"])
    facts = {lang: (sources, np.array(totals, np.int64), v) for lang, (sources, totals, v) in facts.items()}
    found = terms.filter("term is not null").select("lang", "sources", "counts").mapInArrow(
        _summed(facts), "lang string, source string, item string, more long")
    sums = found.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    none = groups.filter("v > 0").withColumn("none", _share(F.lit(RAISED).cast("bigint"), F.col("total") + RAISED * F.col("v")))
    none = groups.join(none.select("lang", "source", "none"), ["lang", "source"], "left").select("lang", "source", "v", "none")
    other = none.select("lang", F.col("source").alias("item"), F.col("none").alias("other"))
    pairs = none.join(other, "lang").filter("source <> item").withColumn(
        "base", F.coalesce(F.col("v") * _gap(F.col("none"), F.col("other")), F.lit(0)))
    return pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.col("base") + F.coalesce("more", F.lit(0))).alias("value"))


def _leading(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the terms that a source has more of than its language, the `top` first."""
    each = terms.filter("term is not null").select(
        "lang", "term", F.col("n").alias("in_lang"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    each = each.select("lang", F.col("e.sources").alias("source"), "term", "in_lang", F.col("e.counts").alias("n"))
    raised = each.join(small_side(groups), ["lang", "source"])
    p = _share(F.col("n") + RAISED, F.col("total") + RAISED * F.col("v"))
    q = _share(F.col("in_lang") + RAISED, F.col("lang_total") + RAISED * F.col("v"))
    more = raised.filter("n > 0").withColumns({"p": p, "q": q}).filter("p > q").withColumn("value", _gap(F.col("p"), F.col("q")))
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return more.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS,
          top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far apart the sources of each language are, and by which terms.

    A group is a language and a source that occur together; null languages, sources and texts are empty ones.
    Terms are runs of letters and non-ASCII characters, A-Z in lower case; a language keeps those that
    `least_docs` of its rows hold. A group's share of a term is 1 + floor(10^9 * (n + 2) / (N + 2 V)), n its
    uses there, N those of all kept terms, V their number; the gap of shares p and q is
    floor((p - q)^2 / (p + q)). Part `pair` has each other source of the language and the sum of the gaps over all
    kept terms (0 without any); part `term` the terms of which the group's share is above the language's,
    the `top` first. Ranks are from 1 by falling value, ties by the item's bytes. All numbers are whole, so
    no order of adding changes them. Rows count as often as they repeat; an empty table gives no rows.

    Texts are read once and stay where they are: tasks hand on sums per group and term. Every term's row of
    counts stays in its shard as well; what leaves one is a sum per pair of groups, as many as the result
    has, and the leading terms of each group.
    """
    terms = term_table(df, text, lang, source, least_docs)
    groups = _groups(terms)
    pairs = _pairs(terms, groups)
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.unionByName(_leading(terms, groups, top)).select(
        F.col("lang").alias(lang), F.col("source").alias(source), "part", "item", "value", "rank")
