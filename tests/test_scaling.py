import pytest
from pyspark.sql import functions as F

from roadspan.operators import scaling


def test_dense_ids_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(scaling, "SMALL_ROWS", -1)
    frame = spark.range(0, 1000, 1, 16).select((F.col("id") * 7919 % 1000).alias("k"))
    got = scaling.dense_ids(frame, "n", [F.col("k")], 100).collect()
    assert sorted((r.k, r.n) for r in got) == [(k, 101 + k) for k in range(1000)]


def test_dense_ids_small(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",)], "k STRING")
    got = scaling.dense_ids(frame, "n", [F.col("k")], 5).collect()
    assert sorted((r.k, r.n) for r in got) == [("a", 6), ("b", 7), ("c", 8)]


def test_broadcast_only_behind_size_check(spark, monkeypatch):
    monkeypatch.setattr(scaling, "BROADCAST_BYTES", -1)
    frame = spark.range(10)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(scaling.broadcast_if_small(frame, max_rows=10))
    assert not hinted(scaling.broadcast_if_small(frame, max_rows=9))


class FakeConf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class FakeContext:
    master = "spark://somewhere:7077"

    def getConf(self):
        return FakeConf()

    def getCheckpointDir(self):
        return None


class FakeSession:
    sparkContext = FakeContext()

    def __init__(self, **values):
        self.conf = FakeConf(**values)


def test_checkpoint_folder_is_the_named_one():
    session = FakeSession(**{"spark.checkpoint.dir": "hdfs://shared/folder"})
    assert scaling.shared_folder(session) == "hdfs://shared/folder"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scaling.shared_folder(FakeSession())
