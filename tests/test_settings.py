"""Session settings and the shared work folder."""

import pytest

from logweir.settings import configure, materialize, work_folder


class Session:
    """As much of a session as the work folder looks at."""

    def __init__(self, setting=None, context_folder=None, warehouse=None):
        self.settings = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": warehouse}
        self.context_folder = context_folder
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.settings[name] or default

    def getCheckpointDir(self):
        return self.context_folder


def test_shared_folder_comes_from_the_session():
    first = work_folder(Session("hdfs://shared/work/"), "x")
    assert first.startswith("hdfs://shared/work/x-")
    assert first != work_folder(Session("hdfs://shared/work/"), "x")
    assert work_folder(Session(None, "hdfs://other"), "x").startswith("hdfs://other/x-")


def test_warehouse_is_the_last_resort():
    assert work_folder(Session(warehouse="hdfs://house"), "x").startswith("hdfs://house/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(), "x")


def test_materialized_table_is_read_back(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    df = spark.range(10).selectExpr("id", "struct(id as a) as s")
    stored = materialize(df, "check")
    assert all(f.startswith(f"file:{shared}") or f.startswith(f"file://{shared}") for f in stored.inputFiles())
    assert sorted(stored.collect()) == sorted(df.collect())


def test_configure(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider)
    try:
        configure(spark, shuffle_partitions=3, rocksdb=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get(provider).endswith("RocksDBStateStoreProvider")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(provider, old)
