"""Cases that went wrong once: file forms, replacements, failing batches, streams, contract capabilities."""
import csv
import datetime as dt
import io
import json
import os
import tempfile

import pytest
from fixtures import HEADER, write_submission
from pyspark.sql import functions as F

from lakepipe.contracts import Rule, load_contract
from lakepipe.functions import joins
from lakepipe.operators import bronze, checks, governance, intake, quality, structure, structure_large
from lakepipe.operators.tokens import Tokens
from lakepipe.plans.lcr_flow import read_table, run_lcr_batch
from lakepipe.schemas import BRONZE_HISTORY, BRONZE_LCR
from lakepipe.sources import raw, tables
from lakepipe.sources.versioned import Store
from lakepipe.streaming import payments

INSTITUTIONS = "institution_id string, institution_name string, institution_type string, peer_group string"


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="lakepipe-mended-")


def institutions(spark):
    return spark.createDataFrame([(f"FI{i:03d}", f"Bank {i}", "COMMERCIAL_BANK", "PG-CB") for i in range(1, 30)], INSTITUTIONS)


# --------------------------------------------------------- structural checks

@pytest.mark.parametrize("line", [',"x",b', 'a,"b ""c"", d",e', '"a"', '""', ',', 'a,"x"y,b', '"x",', 'a,b', '"",""', ' "a",b'])
def test_fields_are_split_as_a_csv_reader_does(spark, line):
    got = spark.createDataFrame([(line,)], "l string").select(structure.split_fields(F.col("l"))).first()[0]
    assert got == next(csv.reader([line]))


def test_records_keep_quoted_line_feeds(spark):
    text = 'h1,h2\r\na,"b\nc"\n\nd,"e ""f""\n"\ng,\rh\n'
    got = spark.createDataFrame([(text,)], "t string").select(structure.split_records(F.col("t"))).first()[0]
    assert [r for r in got if r] == ["h1,h2", 'a,"b\nc"', 'd,"e ""f""\n"', "g,\rh"]
    long = '"' + "x\n" * 50_000 + '",y\nz,1\n'
    got = spark.createDataFrame([(long,)], "t string").select(structure.split_records(F.col("t"))).first()[0]
    assert [r for r in got if r] == [long[:-5], "z,1"]


def _forms(folder):
    """Files whose bytes are read alike by both paths: mark, carriage returns, quotes, quoted line feeds."""
    good = [f"FI001,2024-01,HQLA_L1,MYR,{i}.50" for i in range(40)]
    lf = HEADER + "\n" + "\n".join(good) + "\n"
    quoted = list(good)
    quoted[3] = 'FI001,2024-01,HQLA_L1,"M\nY\n\nR",3.50'
    quoted[20] = ',"2024-01",HQLA_L1,MYR,"x\n"'
    quoted[21] = '"FI001","2024-01","HQLA_L1","MYR","1.00"'
    bodies = {"plain": lf, "mark": "﻿" + lf, "crlf": lf.replace("\n", "\r\n"),
              "lone": lf.replace("MYR,7.50", "MY\rR,7.50"), "blank": lf.replace("\n", "\n\n").replace("2.50\n", "2.50\n\r\n"),
              "quoted": HEADER + "\n" + "\n".join(quoted) + "\n", "open": lf + 'FI001,2024-01,"HQLA_L1,MYR,1\nx,y\n',
              "empty_head": "\n" + lf, "bytes": None}
    for i, (_, text) in enumerate(bodies.items()):
        data = lf.encode().replace(b"MYR", b"MY\xff", 1) if text is None else text.encode()
        write_submission(folder, f"FI{i + 1:03d}", "2024-01", 1, body=data, rows=[["", "", "", "", "1"]] * 40)
    return list(bodies)


def test_both_paths_give_one_verdict(spark, folder):
    names = _forms(folder)
    whole = {r["file_name"][:5]: r for r in structure.validate(
        raw.files_with_manifests(spark, folder).withColumn("content", F.coalesce("content", F.lit(""))), load_contract()).collect()}
    large = raw.files_with_manifests(spark, folder, large_bytes=0)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")               # many blocks a file
    try:
        paths = [r["path"] for r in large.select("path").collect()]
        records = tables.stage(spark, structure_large.numbered_records(spark, paths), "records")
        summary, errors = structure_large.validate_large(
            spark, paths, large.select(F.col("file_path").alias("path"), "manifest", "bom"), load_contract(), records=records)
        summary = {r["path"].rsplit("/", 1)[1][:5]: r for r in summary.collect()}
        found = {}
        for r in errors.orderBy("path", "error_no").collect():
            found.setdefault(r["path"].rsplit("/", 1)[1][:5], []).append((r["error_no"], r["message"]))
        parsed = structure_large.parse_large(spark, paths, load_contract(), records=records)
        counted = {r["path"].rsplit("/", 1)[1][:5]: r["n"] for r in parsed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for i, name in enumerate(names):
        inst = f"FI{i + 1:03d}"
        w, s = whole[inst], summary[inst]
        assert (s["record_count"], s["control_total"], s["n_errors"], s["status"]) == \
            (w["record_count"], w["control_total"], w["n_errors"], w["status"]), name
        assert found.get(inst, []) == list(enumerate(w["all_errors"], 1)), name
        if name not in ("bytes", "empty_head"):
            assert counted[inst] == w["record_count"], name
    assert whole["FI002"]["all_errors"][0].startswith("header ['﻿inst") and whole["FI003"]["status"] == whole["FI001"]["status"]
    text = open(os.path.join(folder, "FI006_LCR_2024-01_v1.csv"), newline="").read()
    assert whole["FI006"]["record_count"] == len(list(csv.DictReader(io.StringIO(text)))) == 40


def test_the_error_table_holds_all_errors(spark, folder):
    body = HEADER + "\n" + "".join(f"FI001,2024-01,HQLA_L1,MYR,x{i}\n" for i in range(450))
    write_submission(folder, "FI001", "2024-01", 1, body=body.encode())
    v = structure.validate(raw.files_with_manifests(spark, folder), load_contract()).withColumn("submission_id", F.lit("s"))
    assert structure.error_rows(v).count() == 452 and len(v.first()["errors"]) == 200


# ---------------------------------------------------- landing folder, intake

def test_every_name_gets_a_verdict_in_folders_with_spaces(spark, folder):
    land = os.path.join(folder, "land ing + é")
    write_submission(land, "FI001", "2024-01", 1)
    write_submission(land, "FI002", "2024-01", 1, name="FI002_LCR_2024-01_v1.CSV")
    write_submission(land, "FI003", "2024-01", 1, name="notes.txt", manifest=False)
    write_submission(land, "FI004", "2024-01", 99999999999)
    files = raw.files_with_manifests(spark, land).withColumn("received_at", F.col("modified_at"))
    got = {r["file_name"]: r["verdict"] for r in intake.decide(files).collect()}
    assert got == {"FI001_LCR_2024-01_v1.csv": "RECEIVED", "FI002_LCR_2024-01_v1.CSV": "REJECTED", "notes.txt": "REJECTED",
                   "FI004_LCR_2024-01_v99999999999.csv": "REJECTED"}


@pytest.mark.parametrize("large_bytes", [0, raw.LARGE_FILE_BYTES])
def test_batch_with_odd_files_goes_through(spark, folder, large_bytes):
    land, wh = os.path.join(folder, "land ing"), os.path.join(folder, "wh")
    write_submission(land, "FI001", "2024-01", 1)
    write_submission(land, "FI002", "2024-01", 99999999999)
    write_submission(land, "FI003", "2024-13", 1)
    out = run_lcr_batch(spark, land, wh, institutions(spark), large_bytes=large_bytes)
    status = {r["submission_id"]: r["status"] for r in out["status"].collect()}
    assert status["FI001-LCR-2024-01-v1"] == "PUBLISHED" and "FI003-LCR-2024-13-v1" in status and len(status) == 2
    receipts = [json.loads(r["receipt"]) for r in read_table(spark, wh, "receipts").collect()]
    assert {r["submission_id"] for r in receipts} == set(status)
    uri = read_table(spark, wh, "bronze").where("institution_id = 'FI001'").first()["source_uri"]
    assert uri.endswith("/land ing/FI001_LCR_2024-01_v1.csv") and os.path.exists(uri.removeprefix("file:"))
    again = run_lcr_batch(spark, land, wh, institutions(spark), large_bytes=large_bytes)
    assert again["intake"].count() == 0                    # only undecided files are read


def test_failed_model_test_leaves_the_history(spark, folder):
    """All-zero amounts give no ratio: the Gold test stops the build after everything before it is recorded."""
    land, wh = os.path.join(folder, "land"), os.path.join(folder, "wh")
    write_submission(land, "FI001", "2024-01", 1)
    run_lcr_batch(spark, land, wh, institutions(spark))
    before = read_table(spark, wh, "gold").drop("gold_built_at").collect()
    write_submission(land, "FI002", "2024-01", 1, "zero_amounts")
    with pytest.raises(checks.BuildTestError):
        run_lcr_batch(spark, land, wh, institutions(spark))
    events = {(r["submission_id"], r["status"]) for r in read_table(spark, wh, "ledger").collect()}
    assert {("FI002-LCR-2024-01-v1", s) for s in ("RECEIVED", "VALIDATED", "ACCEPTED")} <= events
    assert ("FI002-LCR-2024-01-v1", "PUBLISHED") not in events
    failed = read_table(spark, wh, "dq_results").where("stage = 'gold' and outcome = 'FAIL'")
    assert failed.where("rule_id = 'not_null_gold_lcr_ratio'").count() == 1
    assert read_table(spark, wh, "gold").drop("gold_built_at").collect() == before   # tested before it is swapped in


def test_no_join_of_the_intake_carries_file_bodies(spark, folder):
    write_submission(folder, "FI001", "2024-01", 1)
    files = tables.stage(spark, raw.files_with_manifests(spark, folder).withColumn("received_at", F.col("modified_at")), "landing")
    plan = intake.decide(files.drop("content", "manifest_text"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "sha256#" in plan and "content#" not in plan       # nor does a scan read them


def test_declared_tables(spark, folder):
    land, wh = os.path.join(folder, "land"), os.path.join(folder, "wh")
    write_submission(land, "FI001", "2024-01", 1)
    run_lcr_batch(spark, land, wh, institutions(spark), database="lcr_declared")
    assert spark.table("lcr_declared.bronze").count() == 7 and spark.table("lcr_declared.gold").count() == 1
    write_submission(land, "FI002", "2024-02", 1)
    run_lcr_batch(spark, land, wh, institutions(spark), database="lcr_declared")
    assert spark.sql("SELECT count(*) FROM lcr_declared.gold").first()[0] == 2
    spark.sql("DROP DATABASE lcr_declared CASCADE")


# ------------------------------------------------------------- replacements

def _bronze_rows(spark, rows):
    return spark.createDataFrame([("FI001", p, c, "MYR", None, sid, 1, "u", "h", dt.datetime(2024, 1, 1)) for sid, p, c in rows], BRONZE_LCR)


def test_replaced_submission_leaves_no_rows_behind(spark, folder):
    path = f"{folder}/bronze"
    content = lambda: sorted((r["submission_id"], str(r["reporting_period"]), r["line_code"])
                             for r in bronze.current(Store(spark, path).read("bronze", BRONZE_HISTORY)).collect())
    bronze.replace_submissions(spark, path, _bronze_rows(spark, [("a-v1", "2024-01", "X"), ("b-v1", "2024-02", "X"), ("c-v1", "2024-03", "X")]))
    bronze.replace_submissions(spark, path, _bronze_rows(spark, [("a-v1", "2024-02", "Y")]))       # moved to another period
    assert content() == [("a-v1", "2024-02", "Y"), ("b-v1", "2024-02", "X"), ("c-v1", "2024-03", "X")]
    gone = spark.createDataFrame([("c-v1",)], "submission_id string")
    assert bronze.replace_submissions(spark, path, _bronze_rows(spark, []), gone) == ["2024-03"]   # a delivery without rows
    assert content() == [("a-v1", "2024-02", "Y"), ("b-v1", "2024-02", "X")]


def test_quarantined_last_submission_empties_its_period(spark, folder):
    land, wh = os.path.join(folder, "land"), os.path.join(folder, "wh")
    write_submission(land, "FI001", "2024-01", 1)
    write_submission(land, "FI001", "2024-02", 1)
    run_lcr_batch(spark, land, wh, institutions(spark))
    dq = read_table(spark, wh, "dq_results").where("stage = 'bronze' and rule_id = 'LCR-004' and submission_id like '%2024-01%'")
    store = Store(spark, wh)                               # as if an earlier run's results had held it back
    store.commit({"quarantined": store.written(dq.select("submission_id").distinct(), "quarantined")})
    write_submission(land, "FI001", "2024-01", 2, "negative_amount")
    out = run_lcr_batch(spark, land, wh, institutions(spark))
    assert [r["reporting_period"] for r in out["gold"].select("reporting_period").collect()] == ["2024-02"]
    assert read_table(spark, wh, "silver").select("reporting_period").distinct().count() == 1


# ------------------------------------------------------------------- streams

def _event(eid, minute, amount=10.0, direction="OUT"):
    return json.dumps({"event_id": eid, "institution_id": "FI001", "event_time": 1_704_067_200_000 + minute * 60_000,
                       "payment_system": "RTGS", "direction": direction, "amount": amount, "currency": "MYR", "status": "SETTLED"})


def _replay(spark, root, src, lines, checkpoint):
    os.makedirs(src, exist_ok=True)
    for i, batch in enumerate(lines):
        with open(os.path.join(src, f"{i}.json"), "w") as fh:
            fh.write("\n".join(batch) + "\n")
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = payments.read_source(spark, "text", src, max_files_per_trigger=1)
    for q in payments.start_payments_job(stream, f"{root}/bronze", f"{root}/stats", f"{root}/dlq", checkpoint,
                                         trigger={"availableNow": True}, dq_path=f"{root}/dq"):
        q.awaitTermination()


def test_new_checkpoint_keeps_earlier_batches(spark, folder):
    _replay(spark, folder, f"{folder}/s1", [[_event("A", 0)], [_event("B", 1)]], f"{folder}/ck1")
    _replay(spark, folder, f"{folder}/s2", [[_event("C", 2)]], f"{folder}/ck2")
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/bronze").collect()) == ["A", "B", "C"]


def test_rules_see_the_copies_and_huge_amounts_go_to_the_dead_letters(spark, folder):
    _replay(spark, folder, f"{folder}/src", [[_event("A", 0), _event("B", 0), _event("A", 0), _event("H", 0, 1e30)], [_event("A", 1), _event("Z", 3000)]],
            f"{folder}/ck")
    dq = {r["submission_id"]: (r["records_tested"], r["records_failed"])
          for r in spark.read.parquet(f"{folder}/dq").where("rule_id = 'PAY-003'").collect()}
    assert dq["0"] == (3, 1)
    assert [r["error"] for r in spark.read.parquet(f"{folder}/dlq").collect()] == [payments.OUT_OF_RANGE]
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/bronze").collect()) == ["A", "B", "Z"]
    stats = spark.read.parquet(f"{folder}/stats").collect()
    assert sorted(r["event_count"] for r in stats) == [1, 3]


def test_first_copy_by_arrival_is_kept(spark):
    df = spark.createDataFrame([("e", 5, "late"), ("e", 2, "first"), ("f", 1, "only")], "event_id string, arrival int, x string")
    assert sorted(tuple(r) for r in payments.deduplicate(df).collect()) == [("e", 2, "first"), ("f", 1, "only")]


# ------------------------------------------------------ contract capabilities

def test_newest_valid_version_of_reference_data(spark):
    facts = spark.createDataFrame([("a", "2024-05"), ("a", "2020-01"), ("a", "2010-01"), ("b", "2024-13")], "institution_id string, reporting_period string")
    d = dt.date
    inst = spark.createDataFrame([("a", "old", "p", d(2015, 1, 1)), ("a", "new", "p", d(2022, 1, 1)), ("a", "future", "p", d(2030, 1, 1)),
                                  ("b", "b", "p", d(2000, 1, 1))],
                                 "institution_id string, institution_name string, peer_group string, active_from date")
    got = {(r["institution_id"], r["reporting_period"]): r["institution_name"] for r in governance.as_of_reference(facts, inst).collect()}
    assert got == {("a", "2024-05"): "new", ("a", "2020-01"): "old", ("a", "2010-01"): None, ("b", "2024-13"): None}


def test_period_that_is_no_month(spark):
    df = spark.createDataFrame([("s1", "2024-13", dt.datetime(2024, 2, 1)), ("s2", "2024-01", dt.datetime(2024, 2, 20))],
                               "submission_id string, reporting_period string, received_at timestamp_ntz")
    got = {r["submission_id"]: (r["deadline"], r["days_late"], r["on_time"]) for r in governance.timeliness(df, 15).collect()}
    assert got == {"s1": (None, None, None), "s2": (dt.date(2024, 2, 15), 5, False)}


def test_tokens_leave_no_raw_id(spark):
    df = spark.createDataFrame([("FI001", "FI001-LCR-2024-01-v1"), ("FI002", "odd")], "institution_id string, submission_id string")
    got = Tokens(spark, {1: b"key"}).replace(df, ["institution_id"], {"submission_id": "institution_id"}).collect()
    assert not any("FI00" in v for r in got for v in r) and got[0]["submission_id"] == got[0]["institution_id"] + "-LCR-2024-01-v1"


def test_accepted_values_hold_quotes_and_may_leave_nulls_out(spark):
    df = spark.createDataFrame([("it's",), ("x",), (None,)], "c string")
    rule = Rule(id="r", stage="s", dimension="d", type="accepted_values", severity="error", column="c", values=("it's",))
    count = lambda r: df.agg(quality._failed_count(df, r).alias("n")).first()["n"]
    assert count(rule) == 2 and count(Rule(**{**rule.__dict__, "ignore_null": True})) == 1


def test_broadcast_is_checked_by_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "t string")
    assert joins.fits(df, 100) and not joins.fits(df, 10) and not joins.fits(df, 100, 20_000)


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    from lakepipe import session

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Spark:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark())
