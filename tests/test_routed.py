"""The clustered layout: what is read back, which files are opened, how many there are."""

import random

import pytest
from pyspark.errors import AnalysisException

from duolex.sources import routed

SCHEMA = ("Filename string, row_id long, sent_no int, File string, Tr1 string, Tr2 string, Lang1 string, Lang2 string, "
          "drop_stage int, reason string, route string, inverted boolean")


def _audit(n, corpora):
    """A third of the rows belongs to one corpus, some to none."""
    rng, rows = random.Random(3), []
    for i in range(n):
        name = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"c{rng.randrange(corpora):04d}"
        stage = rng.choice([None, None, 3, 6])
        route = "final" if stage is None else "to_check" if stage == 3 else "to_delete"
        rows.append((name, i, 0, "f", f"a\t{i}\n", None if i % 7 == 0 else f"b{i}", "en", "fr", stage, None, route,
                     stage is None and i % 11 == 0))
    return rows


def _expected(rows):
    out = []
    for r in rows:
        out.append(("final" if r[10] == "final" else r[10], r[0], r[1], r[4], r[5], r[6], r[7]))
        if r[10] == "final" and r[11]:
            out.append(("to_check", r[0], r[1], r[5], r[4], r[7], r[6]))
    return out


def _read(df):
    found = df.select("route", "Filename", "row_id", "Tr1", "Tr2", "Lang1", "Lang2").collect()
    return sorted(map(repr, map(tuple, found)))


def test_clustered(spark, tmp_path):
    rows, path = _audit(1000, 300), str(tmp_path / "c")
    files = routed.write_clustered(spark.createDataFrame(rows, SCHEMA).repartition(4), path, rows_per_file=100).collect()
    want = _expected(rows)
    assert sum(f["n"] for f in files) == len(want)
    # Over 300 corpora and three routes: a file per hundred rows, and one more where routes meet.
    assert len(files) <= -(-len(want) // 100) + 2
    assert max(f["n"] for f in files) < 300
    assert _read(routed.read_clustered(spark, path)) == sorted(map(repr, want))
    for routes, corpora in ((["final"], None), (["to_check", "final"], ["c0007", "c0250"]), (None, ["hot"]),
                            (None, [None]), (["final"], [None, "c0001"]), (["none"], None), (None, []), ([], ["hot"])):
        part = routed.read_clustered(spark, path, routes, corpora)
        assert _read(part) == sorted(repr(w) for w in want if (routes is None or w[0] in routes)
                                     and (corpora is None or w[1] in corpora))
    one = routed.read_clustered(spark, path, ["final"], ["c0100"])
    assert len(one.inputFiles()) <= 2 < len(files)
    with pytest.raises(AnalysisException):
        routed.write_clustered(spark.createDataFrame(rows, SCHEMA), path)


def test_clustered_nothing(spark, tmp_path):
    path = str(tmp_path / "c")
    assert routed.write_clustered(spark.createDataFrame([], SCHEMA), path).count() == 0
    empty = routed.read_clustered(spark, path, ["final"], ["x"])
    assert empty.count() == 0 and routed.read_clustered(spark, path).columns == empty.columns
