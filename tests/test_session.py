import pytest

from duolex import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class _Context:
    def __init__(self, master, folder):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, value, master="local[2]", folder=None):
        self.conf, self.sparkContext = _Conf(value), _Context(master, folder)


def test_folder_is_the_shared_one():
    assert session.work_dir(_Session("hdfs:///shared/cp/")).startswith("hdfs:///shared/cp/duolex-")
    assert session.work_dir(_Session(None, "yarn", "s3a://bucket/cp")).startswith("s3a://bucket/cp/duolex-")


def test_own_folder_only_in_a_local_session():
    first, again = session.work_dir(_Session(None)), session.work_dir(_Session(None))
    assert first == again and "duolex-" in first
    for master in ("yarn", "local-cluster[2,1,512]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            session.work_dir(_Session(None, master))


def test_broadcast_needs_few_bytes(spark):
    df = session.stage(spark.range(100).selectExpr("id", "repeat('x', 1000) s"), "wide")
    assert session.broadcast_bytes(df) == 100 * (1000 + 32)
    assert session.small_side(df, max_bytes=50_000) is df
    assert session.small_side(df) is not df


def test_staged_files_go(spark):
    df, other = session.stage(spark.range(10), "gone"), session.stage(spark.range(10), "kept")
    session.delete_staged(df)
    assert other.count() == 10
    with pytest.raises(Exception):
        spark.read.parquet(*df.inputFiles()).count()


def test_stage_and_size_check(spark):
    df = session.stage(spark.range(10), "ten")
    assert df.count() == 10 and df.inputFiles()[0].find(session.work_dir(spark).split("/")[-1]) > 0
    assert "Broadcast" in spark.range(5).join(session.small_side(df), "id")._jdf.queryExecution().toString()
    assert session.small_side(df, max_rows=9) is df
