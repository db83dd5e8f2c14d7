"""Stores of many small files before, during and after their compaction."""

import os
import shutil
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logweir.sources import compaction, store
from logweir.streaming import sinks

DAY = datetime(2024, 1, 15, tzinfo=timezone.utc)
SCHEMA = "id long, timestamp timestamp, text string"


def logs(spark, ids, hour=0):
    rows = [(i, DAY + timedelta(hours=hour + i % 3, seconds=i), f"log {i}") for i in ids]
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def live_files(spark, path):
    found = compaction._live(spark, path, compaction.manifest(spark, path)[1])
    return found.select(compaction.FILE).distinct().count()


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("written") / "store")
    for n in range(5):
        store.write_logs(logs(spark, range(30 * n, 30 * n + 30)), path)
    return path


@pytest.fixture
def small(written, tmp_path):
    """Three hours in five appends; the last hour is still open."""
    return shutil.copytree(written, str(tmp_path / "store"))


BEFORE = DAY + timedelta(hours=2)


def test_packed_rows_are_the_same_in_fewer_files(spark, small):
    assert live_files(spark, small) == 15
    done = store.compact_logs(spark, small, BEFORE)
    assert (done.version, done.files_before, done.files_after, done.rows) == (1, 10, 2, 100)
    assert live_files(spark, small) == 2 + 5
    found = store.read_logs(spark, small)
    assert ids(found) == list(range(150))
    assert found.filter("hour = 1").count() == 50
    assert set(found.columns) == {"id", "timestamp", "text", "year", "month", "day", "hour"}
    # Nothing is left to do; a plain read still sees what was appended.
    assert store.compact_logs(spark, small, BEFORE).version is None
    assert ids(spark.read.parquet(small)) == list(range(150))


def test_a_run_that_fails_before_the_switch_changes_nothing(spark, small, monkeypatch):
    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "_publish", fail)
    with pytest.raises(RuntimeError, match="lost"):
        store.compact_logs(spark, small, BEFORE)
    assert len(os.listdir(f"{small}/_compact")) == 1
    assert compaction.manifest(spark, small) == (0, [])
    assert live_files(spark, small) == 15 and ids(store.read_logs(spark, small)) == list(range(150))
    monkeypatch.undo()
    assert store.compact_logs(spark, small, BEFORE).files_after == 2
    assert ids(store.read_logs(spark, small)) == list(range(150))


def test_two_runs_at_once_do_not_both_switch(spark, small):
    store.compact_logs(spark, small, BEFORE)
    with pytest.raises(Exception, match="already exists"):
        compaction._publish(spark, small, 1, [])
    assert ids(store.read_logs(spark, small)) == list(range(150))


def test_late_rows_are_seen_and_packed_later(spark, small):
    store.compact_logs(spark, small, BEFORE)
    store.write_logs(logs(spark, range(150, 160)), small)
    assert ids(store.read_logs(spark, small)) == list(range(160))
    done = store.compact_logs(spark, small, BEFORE)
    assert (done.version, done.files_before, done.files_after) == (2, 4, 2)
    assert ids(store.read_logs(spark, small)) == list(range(160))


def test_cleaning_removes_what_was_replaced(spark, small):
    store.compact_logs(spark, small, BEFORE)
    assert compaction.clean(spark, small) == 0  # within the grace
    assert compaction.clean(spark, small, 0) == 10
    assert spark.read.parquet(small).count() == 50
    assert ids(store.read_logs(spark, small)) == list(range(150))
    store.write_logs(logs(spark, range(150, 160)), small)
    store.compact_logs(spark, small, BEFORE + timedelta(days=1))
    assert compaction.clean(spark, small, 0) == 2 + 2 + 6
    assert live_files(spark, small) == 3
    assert ids(store.read_logs(spark, small)) == list(range(160))


def test_bins_have_the_target_size_and_parts_are_taken_in_turn(spark, small):
    sizes = [r[0] for r in spark.read.parquet(small).select("_metadata.file_size").distinct().collect()]
    done = store.compact_logs(spark, small, BEFORE, target_bytes=2 * max(sizes))
    # Of the five files of an hour two or three fill a bin.
    assert done.files_before == 10 and 4 <= done.files_after <= 6
    assert ids(store.read_logs(spark, small)) == list(range(150))


def test_most_files_of_a_run(spark, small):
    for version in (1, 2):
        done = store.compact_logs(spark, small, BEFORE, most_files=5)
        assert (done.version, done.files_before, done.files_after) == (version, 5, 1)
    assert store.compact_logs(spark, small, BEFORE, most_files=5).version is None
    assert ids(store.read_logs(spark, small)) == list(range(150))


def test_no_store(spark, tmp_path):
    path = str(tmp_path / "none")
    assert store.read_logs(spark, path) is None
    assert store.compact_logs(spark, path, BEFORE) == compaction.Result(None)
    assert store.compact_alerts(spark, path, DAY.date()) == compaction.Result(None)
    assert compaction.clean(spark, path) == 0


def test_alert_store(spark, tmp_path):
    """Closed days of all batches but the last; the last state of each alert stays the same."""
    out = str(tmp_path / "out")
    write = sinks.alert_writer(out, mode="update")
    schema = "alert_id string, window_start timestamp, window_end timestamp, log_count bigint, anomaly_level string, is_anomaly boolean"
    for n in range(4):
        rows = [
            (f"{day}-{k}", DAY + timedelta(days=day), DAY + timedelta(days=day, minutes=5), n, "HIGH", (k + n) % 3 > 0)
            for day in (0, 1)
            for k in range(6)
        ]
        write(spark.createDataFrame(rows, schema), n)

    def state():
        rows = sinks.latest_alerts(spark, out).select("alert_id", "log_count", "batch_id", "day").collect()
        return sorted(map(tuple, rows))

    before, files = state(), live_files(spark, f"{out}/alerts")
    history = sinks.stored_alerts(spark, out).count()
    done = store.compact_alerts(spark, out, date(2024, 1, 16))
    assert done.files_after == 1 and done.files_before >= 3
    assert live_files(spark, f"{out}/alerts") == files - done.files_before + 1
    assert state() == before and sinks.stored_alerts(spark, out).count() == history
    assert compaction.clean(spark, f"{out}/alerts", 0) == done.files_before
    assert state() == before and sinks.stored_alerts(spark, out).count() == history
    since = sinks.latest_alerts(spark, out, F.lit(DAY + timedelta(days=1)))
    assert {r["day"] for r in since.collect()} == {date(2024, 1, 16)}
    # The store goes on.
    write(spark.createDataFrame([("0-0", DAY, DAY + timedelta(minutes=5), 9, "HIGH", True)], schema), 4)
    assert sinks.stored_alerts(spark, out).filter("log_count = 9").count() == 1
