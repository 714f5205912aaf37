"""Compaction of stream folders (A12): the same rows before, during and after; fewer files; a stop changes nothing."""
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakepipe.streaming.compaction import BatchFolders

SCHEMA = "event_id string, institution_id string, event_ts timestamp_ntz"


def day():
    return F.date_format("event_ts", "yyyy-MM-dd")


def batch(spark, path, n, run="r", size=6):
    df = spark.range(size).select(
        F.concat(F.lit(f"{run}-{n}-"), "id").alias("event_id"), F.when(F.col("id") > 0, F.concat(F.lit("i"), F.col("id") % 2)).alias("institution_id"),
        F.expr(f"timestamp_ntz'2024-01-01 23:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT) % 2, {n})").alias("event_ts"))
    df.write.mode("overwrite").partitionBy("institution_id").parquet(f"{path}/run={run}/batch_id={n}")


@pytest.fixture
def folders(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for run, batches in (("r", 4), ("s", 1)):
        for n in range(batches):
            batch(spark, path, n, run)
    return BatchFolders(spark, path, spark.createDataFrame([], SCHEMA).schema)


def seen(folders, state=None):
    return sorted((tuple(r) for r in folders.read(state).collect()), key=str)


def files(folders):
    return [p for p in Path(folders.path).rglob("*.parquet")]


def test_rows_stay_and_files_fall(spark, folders):
    rows, before, state = seen(folders), files(folders), folders.store.state()
    reader = folders.read(state)
    assert len(rows) == 30 and folders.compact(day()) == 3          # the newest of each run may be written again
    assert seen(folders) == rows and seen(folders, state) == rows and reader.count() == 30
    assert folders.clean(state) == 0                               # readers of the earlier pointer need them
    assert folders.clean(folders.store.state()) == 3 and seen(folders) == rows
    assert len(files(folders)) < len(before)
    merged = {p.parent.name for p in files(folders) if "_compacted" in str(p)}
    assert merged == {"day=2024-01-01", "day=2024-01-02"}
    assert folders.compact(day()) == 0                               # nothing new


def test_later_batches_and_a_replay_of_the_newest(spark, folders):
    folders.compact(day())
    batch(spark, folders.path, 3)                                  # the newest batch is written again
    batch(spark, folders.path, 4)
    batch(spark, folders.path, 5)
    rows = seen(folders)
    assert len(rows) == 18 + 6 + 6 + 6 + 6
    assert folders.compact(day()) == 2 and seen(folders) == rows
    folders.clean(folders.store.state())
    assert seen(folders) == rows


def test_a_compaction_that_stops_changes_nothing(folders, monkeypatch):
    rows = seen(folders)
    merge = BatchFolders.merge

    def stop(self, batches, by):
        merge(self, batches, by)
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(BatchFolders, "merge", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            folders.compact(day())
    assert seen(folders) == rows and folders.clean(folders.store.state()) == 0
    assert folders.compact(day()) == 3 and seen(folders) == rows


def test_one_batch_and_an_empty_sink(spark, folders, tmp_path):
    one = BatchFolders(spark, f"{tmp_path}/one", folders.schema)
    batch(spark, one.path, 0)
    assert one.compact(day()) == 0 and one.read().count() == 6
    empty = BatchFolders(spark, str(tmp_path / "none"), folders.schema)
    assert empty.compact(day()) == 0 and empty.read().count() == 0
