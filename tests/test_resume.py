"""A batch that is stopped anywhere is taken up again; tables change by one commit; old versions stay readable."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import submission_rows, write_submission
from lakepipe.operators import bronze, checks
from lakepipe.plans.lcr_flow import SCHEMAS, read_table, run_lcr_batch
from lakepipe.schemas import BRONZE_HISTORY, LOADS, columns
from lakepipe.sources import tables
from lakepipe.sources.versioned import CommitConflict, Store


class Stopped(RuntimeError):
    pass


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="lakepipe-resume-")


@pytest.fixture(scope="module")
def institutions(spark):
    return spark.createDataFrame([(f"FI{i:03d}", f"Bank {i}", "COMMERCIAL_BANK", "PG-CB") for i in range(1, 9)],
                                 "institution_id string, institution_name string, institution_type string, peer_group string")


def deliver(land):
    t = 1_700_000_000
    for i, (inst, fault) in enumerate({"FI001": None, "FI002": "negative_amount", "FI003": "manifest_mismatch", "FI004": None}.items()):
        os.utime(write_submission(land, inst, "2024-01", 1, fault), (t + i, t + i))
    v2 = submission_rows("FI004", "2024-01")
    v2[0][4] = "7000.00"
    os.utime(write_submission(land, "FI004", "2024-01", 2, rows=v2), (t + 9, t + 9))


TIMES = {"created_at", "loaded_at", "checked_at", "replaced_at", "bronze_loaded_at", "silver_built_at", "gold_built_at", "event_id",
         "received_at", "modified_at", "path", "source_uri", "file_path", "receipt"}


def content(spark, wh):
    """All tables without times and folders (a resumed run ends later, in another folder)."""
    out = {}
    for name in SCHEMAS:
        if name not in ("open", "bodies"):
            df = read_table(spark, wh, name)
            out[name] = rows(df.select(*[F.col(c).cast("string") for c in df.columns if c not in TIMES]))
    out["open"] = read_table(spark, wh, "open").count()
    out["receipts"] = read_table(spark, wh, "receipts").select(F.get_json_object("receipt", "$.sha256").alias("s")).orderBy("s").collect()
    return out


@pytest.fixture(scope="module")
def unbroken(spark, institutions):
    root = tempfile.mkdtemp(prefix="lakepipe-unbroken-")
    deliver(f"{root}/land")
    run_lcr_batch(spark, f"{root}/land", f"{root}/wh", institutions)
    return content(spark, f"{root}/wh")


def stop_at(monkeypatch, note, before):
    commit = Store.commit

    def stopping(self, changes, why="", *more, **named):
        if why == note and before:
            raise Stopped(note)
        out = commit(self, changes, why, *more, **named)
        if why == note:
            raise Stopped(note)
        return out
    monkeypatch.setattr(Store, "commit", stopping)


STEPS = ["receive", "validate", "load", "judge", "silver tests", "gold tests", "build", "publish"]


@pytest.mark.parametrize("note,before,large_bytes", [(n, False, None) for n in STEPS] + [(n, True, None) for n in ("load", "build")]
                         + [(n, False, 0) for n in ("receive", "validate")])
def test_a_stopped_batch_is_taken_up(spark, folder, institutions, unbroken, monkeypatch, note, before, large_bytes):
    land, wh, more = f"{folder}/land", f"{folder}/wh", {} if large_bytes is None else {"large_bytes": 0}
    deliver(land)
    with monkeypatch.context() as m:
        stop_at(m, note, before)
        with pytest.raises(Stopped):
            run_lcr_batch(spark, land, wh, institutions, **more)
    run_lcr_batch(spark, land, wh, institutions, **more)
    got = content(spark, wh)
    # model tests are repeated for the rebuild, and their results are kept, each time
    tests_of = lambda c: [r for r in c["dq_results"] if "bronze" not in r]
    assert set(tests_of(got)) == set(tests_of(unbroken))
    got["dq_results"] = [r for r in got["dq_results"] if "bronze" in r]
    assert got == unbroken | {"dq_results": [r for r in unbroken["dq_results"] if "bronze" in r]}


def test_new_files_join_what_was_left(spark, folder, institutions, monkeypatch):
    land, wh = f"{folder}/land", f"{folder}/wh"
    deliver(land)
    with monkeypatch.context() as m:
        stop_at(m, "validate", False)
        with pytest.raises(Stopped):
            run_lcr_batch(spark, land, wh, institutions)
    write_submission(land, "FI005", "2024-02", 1)
    for f in os.listdir(land):                               # what was received is in the store: the landing zone may be cleared
        if f.startswith("FI001"):
            os.remove(f"{land}/{f}")
    status = dict(rows(run_lcr_batch(spark, land, wh, institutions)["status"], "submission_id", "status"))
    assert status == {"FI001-LCR-2024-01-v1": "PUBLISHED", "FI002-LCR-2024-01-v1": "QUARANTINED", "FI003-LCR-2024-01-v1": "REJECTED",
                      "FI004-LCR-2024-01-v1": "ACCEPTED", "FI004-LCR-2024-01-v2": "PUBLISHED", "FI005-LCR-2024-02-v1": "PUBLISHED"}


def test_a_failed_gold_test_leaves_both_models_and_waits(spark, folder, institutions):
    land, wh = f"{folder}/land", f"{folder}/wh"
    write_submission(land, "FI001", "2024-01", 1)
    run_lcr_batch(spark, land, wh, institutions)
    before = [rows(read_table(spark, wh, n)) for n in ("silver", "gold")]
    write_submission(land, "FI002", "2024-01", 1, "zero_amounts")
    write_submission(land, "FI003", "2024-01", 1)
    for _ in range(2):
        with pytest.raises(checks.BuildTestError):
            run_lcr_batch(spark, land, wh, institutions)
        assert [rows(read_table(spark, wh, n)) for n in ("silver", "gold")] == before
    write_submission(land, "FI002", "2024-01", 2)             # the corrected return lets the build go on
    status = dict(rows(run_lcr_batch(spark, land, wh, institutions)["status"], "submission_id", "status"))
    assert status == {"FI001-LCR-2024-01-v1": "PUBLISHED", "FI002-LCR-2024-01-v1": "ACCEPTED",
                      "FI002-LCR-2024-01-v2": "PUBLISHED", "FI003-LCR-2024-01-v1": "PUBLISHED"}
    assert read_table(spark, wh, "gold").count() == 3


def test_a_reader_sees_one_version(spark, folder, institutions):
    """A table read before a commit goes on with its files; one read after it has all of the commit."""
    land, wh = f"{folder}/land", f"{folder}/wh"
    deliver(land)
    run_lcr_batch(spark, land, wh, institutions)
    held, was = read_table(spark, wh, "gold"), rows(read_table(spark, wh, "gold"))
    v3 = submission_rows("FI004", "2024-01")
    v3[0][4] = "1.00"
    write_submission(land, "FI004", "2024-01", 3, rows=v3)
    run_lcr_batch(spark, land, wh, institutions)
    assert rows(held) == was != rows(read_table(spark, wh, "gold"))
    store = Store(spark, wh)
    built = [r["version"] for r in store.snapshots().where("note = 'build'").orderBy("version").collect()]
    assert len(built) == 2 and rows(read_table(spark, wh, "gold", version=built[0])) == was
    together = [r["changed"] for r in store.snapshots().where("note = 'build'").collect()]
    assert all({"silver", "gold"} <= set(c) for c in together)
    assert store.clean(keep=1) > 0 and store.versions() == [store.state()["version"]]
    assert read_table(spark, wh, "gold").count() == 2


def test_rows_as_of_a_time_before_they_were_replaced(spark, folder):
    at = lambda day: F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")
    row = lambda sid, p, a, day: (("FI001", p, "HQLA_L1", "MYR", None, sid, a, "u", "h"), day)

    def load(delivered, sids, day):
        data = spark.createDataFrame([x for x, _ in delivered], "institution_id string, reporting_period string, line_code string, currency string, "
                                     "amount decimal(20,2), submission_id string, submission_version int, source_uri string, source_sha256 string")
        ids = spark.createDataFrame([(s,) for s in sids], "submission_id string")
        return bronze.replace_submissions(spark, folder, data.withColumn("loaded_at", at(day)), ids, at(day))
    assert load([row("a", "2024-01", 1, 1), row("b", "2024-02", 1, 1), row("c", "no month", 1, 1)], "abc", 1) == ["2024-01", "2024-02", "invalid"]
    assert load([row("a", "2024-03", 2, 5)], "a", 5) == ["2024-01", "2024-03"]         # moved
    assert load([], "c", 9) == ["invalid"]                                             # emptied
    history = Store(spark, folder).read("bronze", BRONZE_HISTORY)
    seen = lambda **w: rows(tables.as_of(history, **w), "submission_id", "reporting_period")
    assert seen(loaded_before="2024-01-03") == [("a", "2024-01"), ("b", "2024-02"), ("c", "no month")]
    assert seen(loaded_before="2024-01-06") == [("a", "2024-03"), ("b", "2024-02"), ("c", "no month")]
    assert seen(loaded_before="2024-01-10") == [("a", "2024-03"), ("b", "2024-02")] == rows(bronze.current(history), "submission_id", "reporting_period")
    loads = Store(spark, folder).read("loads", LOADS)
    assert rows(loads, "submission_id", "rows") == [("a", 1), ("a", 1), ("b", 1), ("c", 0), ("c", 1)]


def test_two_writers_cannot_publish_one_version(spark, folder, monkeypatch):
    store, other = Store(spark, folder), Store(spark, folder)
    one = store.written(spark.range(1), "t")
    seen = store.state()
    monkeypatch.setattr(store, "state", lambda version=None: seen)
    other.commit({"t": other.written(spark.range(2), "t")})
    with pytest.raises(CommitConflict):
        store.commit({"t": one})
    assert other.read("t", columns("id long")).count() == 2


def test_an_appended_table_is_compacted(spark, folder, monkeypatch):
    monkeypatch.setattr("lakepipe.sources.versioned.MOST_LOADS", 3)
    store = Store(spark, folder)
    for i in range(5):
        store.commit({"t": store.written(spark.range(i, i + 1), "t", append=True)})
    store.compact("t", columns("id long"))
    assert len(store.state()["tables"]["t"]["parts"][""]) == 1
    assert rows(store.read("t", columns("id long"))) == [(i,) for i in range(5)]
    assert rows(store.read("t", columns("id long"), version=2)) == [(0,), (1,)]
