"""Steps that shuffled or wrote their rows more often than needed (r03): the same rows from less."""
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from conftest import SF, rows
from lakepipe.operators import bronze
from lakepipe.plans import catalog
from lakepipe.schemas import BRONZE_HISTORY, BRONZE_LCR, LOADS
from lakepipe.session import ensure_checkpoint_dir
from lakepipe.sources import testdata as td
from lakepipe.sources import versioned
from lakepipe.sources.versioned import Store
from lakepipe.streaming import payments


def kept_folders(spark, name):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {p.name for p in Path(root).iterdir() if p.name.startswith(f"lakepipe-{name}-")}


def test_derived_bronze_is_shuffled_by_return(spark):
    """No partial sum before the shuffle, which holds all lines and spills; a task has whole submissions."""
    df = td.lcr_bronze(spark, SF)
    split = df.withColumn("task", F.spark_partition_id()).groupBy("submission_id").agg(F.countDistinct("task").alias("n"))
    assert split.where("n > 1").count() == 0
    lines = td.lcr_lines(spark, SF, td.N_GOLD)
    summed = lines.groupBy("submission_id", "line_code", "currency").agg(F.sum("amount").cast("decimal(20,2)").alias("amount"))
    cols = ["submission_id", "line_code", "currency", "amount"]
    assert df.select(cols).exceptAll(summed.select(cols)).count() == 0 and df.count() == summed.count()


def test_presum_adds_up_null_keys_and_repeated_lines(spark):
    lines = spark.createDataFrame([("FI001", "2024-01", None, "MYR", 1, 1), ("FI001", "2024-01", None, "MYR", 1, 2), ("FI001", "2024-01", "HQLA_L1", "MYR", 1, 4),
                                   (None, None, "HQLA_L1", "MYR", 1, 8), (None, None, "HQLA_L1", "MYR", 1, 8)],
                                  "institution_id string, reporting_period string, line_code string, currency string, submission_version int, amount int")
    got = td._presum(lines.withColumn("amount", F.col("amount").cast("decimal(20,2)"))).select("institution_id", "line_code", F.col("amount").cast("int"))
    assert {tuple(r) for r in got.collect()} == {("FI001", None, 3), ("FI001", "HQLA_L1", 4), (None, "HQLA_L1", 16)} and got.count() == 3


def test_minute_stats_of_a_table_have_no_partial_sum(spark):
    """The events are shuffled before they are summed: a sum of a task's events held nearly all of them and spilled."""
    made = [("2024-01-01 00:00:01", "FI001", "RTGS", 1.5, "FAILED"), ("2024-01-01 00:00:59", "FI001", "RTGS", 2.0, "SETTLED"),
            ("2024-01-01 00:00:59", "FI001", "RTGS", 2.0, "SETTLED"), ("2024-01-01 00:01:00", "FI001", "RTGS", None, None),
            ("2024-01-01 00:00:01", None, None, 4.0, "FAILED"), ("2024-01-01 00:00:02", None, None, 4.0, "PENDING"), (None, "FI001", "RTGS", 8.0, "FAILED")]
    events = spark.createDataFrame(made, "at string, institution_id string, payment_system string, amount double, status string")
    events = events.withColumn("ts", F.col("at").cast("timestamp"))
    stats = payments.minute_stats(events)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[1]
    got = {tuple(r) for r in stats.select("institution_id", "payment_system", "event_count", "total_amount", "failed_count").collect()}
    assert got == {("FI001", "RTGS", 3, 5.5, 1), ("FI001", "RTGS", 1, None, 0), (None, None, 2, 8.0, 1)} and stats.count() == 3


def test_served_bronze_is_written_once(spark, tmp_path):
    for t in ("lineitem", "orders", "supplier", "nation"):
        (tmp_path / f"{t}.parquet").write_bytes(Path(f"{SF}/{t}.parquet").read_bytes())
    before = kept_folders(spark, "lcr-bronze")
    served, _ = catalog.served_tables(spark, str(tmp_path))
    assert kept_folders(spark, "lcr-bronze") == before
    assert served.exceptAll(td.lcr_bronze(spark, str(tmp_path))).count() == 0


def delivery(spark, made):
    return spark.createDataFrame([("FI001", p, "HQLA_L1", "MYR", None, s, 1, "u", "h", None) for s, p in made], BRONZE_LCR)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def at(day):
    return F.lit(f"2024-02-{day:02d} 00:00:00").cast("timestamp_ntz")


def files(path, period):
    return [p for p in Path(path).rglob("*.parquet") if p.parent.name == f"period={period}" and p.parent.parent.parent.name == "bronze"]


def test_replaced_rows_are_copied_without_a_shuffle(spark, path, monkeypatch):
    bronze.replace_submissions(spark, path, delivery(spark, [("a", "2024-01"), ("b", "2024-01"), ("c", "2024-02")]), at=at(1))
    staged, clustered = kept_folders(spark, "bronze-new"), []
    cluster = versioned._clustered
    monkeypatch.setattr(versioned, "_clustered", lambda df, by: clustered.append(df) or cluster(df, by))
    again = delivery(spark, [("a", "2024-03"), ("d", "2024-02")])
    touched = bronze.replace_submissions(spark, path, again, again.select("submission_id").union(spark.sql("select 'b'")), at=at(2))
    assert touched == ["2024-01", "2024-02", "2024-03"]
    assert len(clustered) == 1 and kept_folders(spark, "bronze-new") == staged           # the new rows only, written once
    history = Store(spark, path).read("bronze", BRONZE_HISTORY)
    assert rows(bronze.current(history), "submission_id", "reporting_period") == [("a", "2024-03"), ("c", "2024-02"), ("d", "2024-02")]
    assert rows(history.where("replaced_at is not null"), "submission_id", "reporting_period") == [("a", "2024-01"), ("b", "2024-01")]
    parts = Store(spark, path).state()["tables"]["bronze"]["parts"]
    assert all(len(loads) == 1 for loads in parts.values())                              # a period is one folder


@pytest.mark.parametrize("most", [32, 1])
def test_copied_rows_are_not_sorted(spark, path, monkeypatch, most):
    """A sort of whole rows by period spilled; a task of more periods than it may have files open still writes all its rows."""
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(versioned, "MOST_OPEN_PARTS", most, raising=False)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, to: (seen.append((to.split("/")[-2], spark.conf.get(key))), write(w, to))[1])
    months = [f"2024-{m:02d}" for m in range(1, 8)]
    bronze.replace_submissions(spark, path, delivery(spark, [(s, p) for p in months for s in ("a", "b")]), at=at(1))
    seen.clear()
    bronze.replace_submissions(spark, path, delivery(spark, [("a", months[0])]), at=at(2))
    assert [conf for table, conf in seen if table == "bronze"] == ["0", str(most)] and spark.conf.get(key) == "0"
    history = Store(spark, path).read("bronze", BRONZE_HISTORY)
    assert rows(history.where("replaced_at is not null"), "submission_id", "reporting_period") == [("a", p) for p in months]
    assert rows(bronze.current(history), "submission_id", "reporting_period") == [("a", months[0])] + [("b", p) for p in months]
    assert all(history.where(F.col("reporting_period") == p).count() == len(Store(spark, path).read("bronze", BRONZE_HISTORY, [p]).collect()) for p in months)


def test_moved_rows_of_bronze_are_not_shuffled(spark, monkeypatch):
    clustered, cluster = [], versioned._clustered
    monkeypatch.setattr(versioned, "_clustered", lambda df, by: clustered.append(df) or cluster(df, by))
    history = catalog._redelivered(spark, SF)
    assert len(clustered) == 1                                                           # the first delivery only
    assert history.where("replaced_at is null and submission_version = 3").count() > 0


def test_submission_of_several_periods_is_listed_once(spark, path, monkeypatch):
    """Sets are collected from a row a period, not from all rows: they are collected from sorted rows."""
    sets, collect_set = [], F.collect_set
    monkeypatch.setattr(F, "collect_set", lambda c: sets.append(c) or collect_set(c))
    made = [("a", "2024-01"), ("a", "2024-01"), ("a", "2024-02"), ("a", "x"), ("a", "y"), ("b", "2024-02"), (None, "2024-02")]
    bronze.replace_submissions(spark, path, delivery(spark, made), delivery(spark, made).select("submission_id").union(spark.sql("select 'c'")), at=at(1))
    loads = Store(spark, path).read("loads", LOADS).selectExpr("submission_id", "rows", "sort_array(periods)").collect()
    assert {tuple(r) for r in map(lambda r: (r[0], r[1], tuple(r[2])), loads)} == {
        ("a", 5, ("2024-01", "2024-02", "invalid")), ("b", 1, ("2024-02",)), ("c", 0, ()), (None, 0, ())}
    assert sets == ["p"]


def test_periods_of_many_files_are_merged(spark, path, monkeypatch):
    monkeypatch.setattr(bronze, "MOST_PERIOD_FILES", 2)
    for n in range(5):
        bronze.replace_submissions(spark, path, delivery(spark, [(f"s{n}", "2024-01")]), at=at(n + 1))
    load = Store(spark, path).state()["tables"]["bronze"]["parts"]["2024-01"][-1]
    assert len([p for p in files(path, "2024-01") if f"load={load}" in str(p)]) <= 3
    assert Store(spark, path).read("bronze", BRONZE_HISTORY).count() == 5


def test_derived_columns_come_after_the_shuffle(spark, path):
    narrow = delivery(spark, [("a", "2024-01"), ("b", "2024-02")]).drop("submission_id", "source_uri", "source_sha256", "loaded_at")
    bronze.replace_submissions(spark, path, narrow, at=at(1), derive=td.with_audit)
    got = Store(spark, path).read("bronze", BRONZE_HISTORY)
    assert rows(got, "submission_id", "reporting_period") == [("FI001-LCR-2024-01-v1", "2024-01"), ("FI001-LCR-2024-02-v1", "2024-02")]
    assert got.where(F.col("source_sha256") != F.sha2("submission_id", 256)).count() == 0
