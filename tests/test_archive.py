"""Retention with an archive copy (L8): nothing leaves the live table that the archive does not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakepipe.operators.archive import Retention, expired, fingerprints
from lakepipe.sources.versioned import PERIOD, Store

DAY, NOW = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6)
ROWS = [("a", "2010-01", 1.5), ("a", "2010-01", 1.5), (None, "2010-02", None), ("b", "2010-02", 2.0),
        ("c", "2020-01", 3.0), ("d", "2010-13", 4.0), ("e", None, 5.0)]
SCHEMA = "id string, reporting_period string, amount double"


@pytest.fixture
def retention(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    live, kept = Store(spark, f"{tmp_path}/live"), Store(spark, f"{tmp_path}/archive")
    live.commit({"t": live.written(df, "t", by_period=True)})
    return Retention(live, kept, "t", df.schema)


def held(r):
    def of(store):
        return sorted((tuple(x) for x in store.read("t", r.schema).collect()), key=str)
    return of(r.live), of(r.archive)


def split(*periods):
    return (sorted((x for x in ROWS if x[1] not in periods), key=str), sorted((x for x in ROWS if x[1] in periods), key=str))


def test_expired_months_move_and_the_rest_stays(retention):
    assert retention.run(7, DAY, NOW) == {"moved": ["2010-01", "2010-02"], "different": []}
    assert held(retention) == split("2010-01", "2010-02")
    assert rows(retention.receipts(), PERIOD, "row_count") == [("2010-01", 2), ("2010-02", 2)]
    assert retention.run(7, DAY, NOW) == {"moved": [], "different": []}


def test_a_run_that_stops_after_writing_or_after_the_copy_is_taken_up(retention, monkeypatch):
    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop
    for step in ("verified", "remove"):
        with monkeypatch.context() as m:
            m.setattr(Retention, step, stop)
            with pytest.raises(Stop):
                retention.run(7, DAY, NOW)
        assert held(retention)[0] == split()[0]                     # nothing is gone
    assert retention.run(7, DAY, NOW)["moved"] == ["2010-01", "2010-02"]
    assert held(retention) == split("2010-01", "2010-02")           # and nothing is there twice


@pytest.mark.parametrize("spoil", [
    lambda df: df.where("id IS NOT NULL"), lambda df: df.union(df.where("id IS NULL")),
    lambda df: df.withColumn("id", F.coalesce("id", F.lit(""))),
    lambda df: df.withColumn("amount", F.when(F.col("id") == "b", 2.5).otherwise(F.col("amount")))])
def test_an_altered_copy_deletes_nothing_of_its_period(retention, monkeypatch, spoil):
    def altered(self, periods, state):
        return self.archive.written(spoil(self.live.read(self.table, self.schema, periods=periods, state=state)),
                                    self.table, append=True, by_period=True)
    monkeypatch.setattr(Retention, "copied", altered)
    assert retention.run(7, DAY, NOW) == {"moved": ["2010-01"], "different": ["2010-02"]}
    assert held(retention) == split("2010-01")


def test_rows_that_come_after_the_copy_stay(retention, monkeypatch):
    more = retention.live.spark.createDataFrame([("late", "2010-01", 9.0)], SCHEMA)
    verified = Retention.verified

    def delivery(self, change, marks):
        out = verified(self, change, marks)
        self.live.commit({"t": self.live.written(more, "t", by_period=True, append=True)})
        return out
    with monkeypatch.context() as m:
        m.setattr(Retention, "verified", delivery)
        assert retention.run(7, DAY, NOW)["moved"] == ["2010-02"]
    assert ("late", "2010-01", 9.0) in held(retention)[0]
    retention.run(7, DAY, NOW)
    assert ("late", "2010-01", 9.0) in held(retention)[1] and held(retention)[0] == split("2010-01", "2010-02")[0]


def test_empty_table_and_months(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    r = Retention(Store(spark, f"{tmp_path}/a"), Store(spark, f"{tmp_path}/b"), "t", schema)
    assert r.run(7, DAY, NOW) == {"moved": [], "different": []}
    assert expired(["2016-12", "2017-01", "invalid", ""], 7, dt.date(2024, 1, 1)) == ["2016-12"]
    assert expired(["2016-12"], 7, dt.date(2023, 12, 31)) == []


def test_fingerprints_tell_places_of_nulls_and_ignore_order(spark):
    def mark(data):
        return fingerprints(spark.createDataFrame(data, "a string, b string"), F.lit(1), "g").first()
    assert mark([("x", None), ("y", "z")]) == mark([("y", "z"), ("x", None)])
    assert mark([("x", None)]) != mark([(None, "x")])
    assert mark([("x", "x")]) != mark([("x", "x"), ("x", "x")])
