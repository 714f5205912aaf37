"""The LCR batch flow over a landing folder, all pending submissions per call.

receive -> validate -> load -> judge -> build (Silver, Gold and their tests)
-> publish.  Each step is a set of DataFrame functions of the operators
package; nothing is parsed or looped over on the driver; the only driver-side
values are paths of the batch's files, reporting periods and the list of
failed model tests.

Tables live in a ``Store``: a step writes all it makes (rows, reports, ledger
events) as loads that nobody sees and ends with one commit, so it has happened
as a whole or not at all.  The table ``open`` holds the submissions that are
not final, with the step that they have reached; every step takes up all open
submissions of its kind, whichever run received them.  A run that is stopped
anywhere is therefore taken up by the next one: nothing is lost, nothing is
done twice.  Silver and Gold are tested before they are put in place, both by
one commit; if a test fails they stay as they were, and the periods and the
accepted submissions wait for a later run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.contracts import Contract, RuleSet, load_contract, load_rules
from lakepipe.operators import bronze, checks, gold, intake, ledger, quality, silver, structure, structure_large
from lakepipe.schemas import BRONZE_HISTORY, DQ_RESULTS, LOADS, MANIFEST, SUBMISSION_EVENT, columns
from lakepipe.sources import raw, reference, tables
from lakepipe.sources.versioned import PERIOD, Store

#: Steps that an open submission has reached.
RECEIVED, VALIDATED, LOADED, ACCEPTED = "RECEIVED", "VALIDATED", "LOADED", "ACCEPTED"

OPEN = columns("submission_id string, step string, raw_key string, file_path string, path string, sha256 string, received_at time, "
               "large boolean, bom boolean, utf8_ok boolean").add("manifest", MANIFEST)
SUBMISSIONS = columns("submission_id string, sha256 string, institution_id string, return_type string, reporting_period string, version int")
FILES = columns("path string, bytes long, modified_at time, verdict string, reason string")
BODIES = columns("file_path string, content string")
RECEIPTS = columns("submission_id string, receipt string")
REPORTS = columns("submission_id string, raw_key string, status string, errors strings")
STRUCTURAL_ERRORS = columns("submission_id string, error_no int, message string")
QUARANTINED = columns("submission_id string")
SILVER = columns("institution_id string, reporting_period string, line_code string, currency string, amount amount, submission_id string, "
                 "submission_version int, bronze_loaded_at time, silver_built_at time")
GOLD = columns("institution_id string, institution_name string, institution_type string, peer_group string, reporting_period string, "
               "hqla double, outflows double, inflows double, net_outflows double, lcr_ratio double, submission_ids string, gold_built_at time")
VALIDATION = ["submission_id", "raw_key", "record_count", "control_total", "n_errors", "status", "reason", "errors", "detail_errors"]
#: Tables of the store and their schemas.
SCHEMAS: dict[str, T.StructType] = {
    "open": OPEN, "submissions": SUBMISSIONS, "files": FILES, "bodies": BODIES, "receipts": RECEIPTS, "reports": REPORTS,
    "structural_errors": STRUCTURAL_ERRORS, "ledger": SUBMISSION_EVENT, "bronze": BRONZE_HISTORY, "dq_results": DQ_RESULTS,
    "quarantined": QUARANTINED, "silver": SILVER, "gold": GOLD, "loads": LOADS}
#: Tables that grow by a load in each run.
APPENDED = ["submissions", "files", "receipts", "reports", "structural_errors", "ledger", "dq_results", "loads"]
#: Tables that can be declared in the session's catalog.
DECLARED = ["bronze", "silver", "gold", "dq_results", "ledger"]


def read_table(spark: SparkSession, warehouse: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the flow as its last commit (or that of a version) left it; Bronze with its replaced rows."""
    return Store(spark, warehouse).read(name, SCHEMAS[name], version=version)


def declare_tables(spark: SparkSession, warehouse: str, database: str) -> None:
    """Declare the tables in the catalog and point their partitions to the loads of the last commit.

    The partition of an appended table is the load, that of a model the period.
    """
    store = Store(spark, warehouse)
    state = store.state()
    for name in DECLARED:
        own = state["tables"].get(name)
        if not own:
            continue
        by = "load" if "" in own["parts"] else PERIOD
        wanted = {load: f"{store.root}/{name}/load={load}" for load in own["parts"][""]} if by == "load" else \
            {p: f"{store.root}/{name}/load={loads[-1]}/{PERIOD}={p}" for p, loads in own["parts"].items()}
        full = f"{database}.{name}"
        tables.ensure_table(spark, full, T.StructType([*SCHEMAS[name].fields, T.StructField(by, T.StringType())]), f"{store.root}/{name}", [by])
        there = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        for value in sorted(there - wanted.keys()):
            spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({by}='{value}')")
        for value, location in sorted(wanted.items()):
            if value not in there:
                spark.sql(f"ALTER TABLE {full} ADD PARTITION ({by}='{value}') LOCATION '{location}'")
            elif by == PERIOD:
                spark.sql(f"ALTER TABLE {full} PARTITION ({by}='{value}') SET LOCATION '{location}'")
        spark.catalog.refreshTable(full)


def new_files(spark: SparkSession, landing: str, decided: DataFrame | None) -> list[str]:
    """Paths in the landing folder that no earlier run decided (same path, size and time)."""
    listed = raw.list_files(spark, landing).select("path", "bytes", "modified_at")
    if decided is not None:
        listed = listed.join(decided.select("path", "bytes", "modified_at"), ["path", "bytes", "modified_at"], "left_anti")
    return [r.path for r in listed.select("path").collect()]          # the paths of one batch feed its scan


@dataclass
class Flow:
    """One run over a store; each method is a step that ends with one commit."""

    spark: SparkSession
    warehouse: str
    quarantine: str = "sticky"
    grain: str = "line"
    rebuild: str = "periods"
    contract: Contract = field(default_factory=load_contract)
    rules: RuleSet = field(default_factory=lambda: load_rules("lcr-monthly"))
    now: Column | None = None

    def __post_init__(self):
        self.store = Store(self.spark, self.warehouse)
        if self.now is None:      # one run, one time
            self.now = F.lit(self.spark.sql("SELECT localtimestamp() AS t").first()["t"]).cast("timestamp_ntz")

    def _open(self, step: str) -> DataFrame:
        return self.store.read("open", OPEN).where(F.col("step") == step)

    def _moved(self, step: str, to: DataFrame) -> dict:
        """``open`` with the rows of a step replaced by ``to``."""
        rest = self.store.read("open", OPEN).where(F.col("step") != step)
        return self.store.written(rest.unionByName(to.select(*OPEN.fieldNames())), "open")

    def _added(self, df: DataFrame, table: str, **more) -> dict:
        return self.store.written(df, table, append=True, **more)

    def _events(self, df: DataFrame, status, reason=None, detail=None, at=None) -> dict:
        return self._added(ledger.status_events(df, status, self.now if at is None else at, detail=detail, reason=reason), "ledger")

    # 1. one decision per file; bodies are read and hashed once and stay out of the joins
    def receive(self, files: DataFrame) -> DataFrame:
        """Decide on arrived files (as ``raw.files_with_manifests`` reads them, with ``received_at``)."""
        files = tables.stage(self.spark, files, "landing")
        known = self.store.read("submissions", SUBMISSIONS) if self.store.has("submissions") else None
        decided = tables.stage(self.spark, intake.decide(files.drop("content", "manifest_text"), known), "intake")
        got = decided.where(F.col("verdict") == "RECEIVED")
        here = got.withColumn("step", F.lit(RECEIVED)).select(*OPEN.fieldNames())
        small = files.where(~F.col("large")).select("file_path", F.coalesce("content", F.lit("")).alias("content"))
        self.store.commit({
            "open": self.store.written(self.store.read("open", OPEN).unionByName(here), "open"),
            "bodies": self._added(small.join(got.select("file_path"), "file_path", "left_semi"), "bodies"),
            "submissions": self._added(got.select(*SUBMISSIONS.fieldNames()), "submissions"),
            "receipts": self._added(intake.receipts(got), "receipts", format="json"),
            "ledger": self._events(got, "RECEIVED", at=F.col("received_at")),
            "files": self._added(decided.select("path", "bytes", "modified_at", "verdict", "reason"), "files")}, "receive")
        return decided

    def _large_paths(self, rows: DataFrame) -> list[str]:
        """The large files of a batch are few (each is at least large_bytes): their paths feed the scan."""
        return [r.path for r in rows.where(F.col("large")).select("path").collect()]

    def _with_bodies(self, rows: DataFrame) -> DataFrame:
        return rows.where(~F.col("large")).join(self.store.read("bodies", BODIES), "file_path")

    # 2. structural validation (invalid UTF-8 -> rejected without parsing)
    def validate(self) -> DataFrame:
        todo = tables.stage(self.spark, self._open(RECEIVED), "received")
        checked = tables.stage(self.spark, structure.validate(self._with_bodies(todo), self.contract)
                               .select(*VALIDATION, "all_errors"), "checked")
        validated, errors = checked.drop("all_errors"), structure.error_rows(checked)
        if paths := self._large_paths(todo):
            big = todo.where(F.col("large"))
            records = tables.stage(self.spark, structure_large.numbered_records(self.spark, paths), "records")
            summary, found = structure_large.validate_large(
                self.spark, paths, big.select(F.col("file_path").alias("path"), "manifest", "bom"), self.contract, records=records)
            found = tables.stage(self.spark, found, "large-errors")
            report = structure_large.report_rows(summary, found).withColumnRenamed("path", "file_path")
            ids = big.select("file_path", "submission_id", "raw_key")
            validated = validated.unionByName(report.join(ids, "file_path").select(*VALIDATION))
            errors = errors.unionByName(found.withColumnRenamed("path", "file_path").join(ids, "file_path").select(*errors.columns))
        validated = tables.stage(self.spark, validated, "validated")
        good = todo.join(validated.where(F.col("status") == "VALIDATED"), "submission_id", "left_semi")
        self.store.commit({
            "open": self._moved(RECEIVED, good.withColumn("step", F.lit(VALIDATED))),
            "reports": self._added(structure.report(validated), "reports", format="json"),
            "structural_errors": self._added(errors, "structural_errors"),
            "ledger": self._events(validated, F.col("status"), F.col("reason"),
                                   F.struct(F.col("detail_errors").alias("errors")))}, "validate")
        return validated

    # 3. Bronze: typed rows of validated files; the rows that they replace are closed
    def load(self) -> DataFrame:
        todo = tables.stage(self.spark, self._open(VALIDATED), "to-load")
        parsed = structure.parse_records(self._with_bodies(todo), self.contract, keep=("submission_id", "path", "sha256"))
        if paths := self._large_paths(todo):
            keys = todo.where(F.col("large")).select("file_path", "submission_id", "path", "sha256")
            lines = structure_large.parse_large(self.spark, paths, self.contract).withColumnRenamed("path", "file_path")
            parsed = parsed.unionByName(lines.join(keys, "file_path").select(*parsed.columns))
        changes, periods = bronze.replace(self.store, bronze.with_audit(parsed, self.now), todo.select("submission_id"), self.now)
        changes["open"] = self._moved(VALIDATED, todo.withColumn("step", F.lit(LOADED)))
        if not self._open(RECEIVED).limit(1).count():
            changes["bodies"] = self.store.removed([""])
        stale = sorted({*self.store.state()["values"].get("stale", []), *periods})
        self.store.commit(changes, "load", {"stale": stale})
        return todo

    def _stale(self) -> list[str]:
        """Periods whose Bronze rows changed since Silver and Gold were built: they prune every read of a run."""
        return self.store.state()["values"].get("stale", [])

    def loaded_rows(self, submissions: DataFrame) -> DataFrame:
        rows = bronze.current(self.store.read("bronze", BRONZE_HISTORY, self._stale()))
        return rows.join(submissions.select("submission_id"), "submission_id", "left_semi")

    # 4. Bronze rules for all loaded submissions in one pass; empty ones included; the gate sees this run only
    def judge(self) -> tuple[DataFrame, DataFrame]:
        todo = tables.stage(self.spark, self._open(LOADED), "to-judge")
        sids = todo.select("submission_id")
        dq = tables.stage(self.spark, quality.evaluate(self.loaded_rows(todo), self.rules, "bronze", submissions=sids, checked_at=self.now), "dq")
        gate = tables.stage(self.spark, quality.gate(dq), "gate")
        passed = todo.join(gate.where(F.col("status") == "ACCEPTED"), "submission_id", "left_semi")
        # the set of quarantined ids is kept and changed by this run's results; the history is not read
        held = self.store.read("quarantined", QUARANTINED)
        if self.quarantine == "latest_run":
            held = held.join(sids, "submission_id", "left_anti")
        failing = silver.quarantined_submissions(dq, "sticky")
        self.store.commit({
            "open": self._moved(LOADED, passed.withColumn("step", F.lit(ACCEPTED))),
            "dq_results": self._added(dq.select(*DQ_RESULTS.fieldNames()), "dq_results"),
            "quarantined": self.store.written(held.unionByName(failing.select("submission_id")).distinct(), "quarantined"),
            "ledger": self._events(gate, F.col("status"),
                                   F.when(F.col("status") == "QUARANTINED", F.lit("blocking quality rule failed")))}, "judge")
        return dq, gate

    def _record(self, tests: DataFrame, note: str) -> None:
        """Results of model tests are kept before a failed one stops the build."""
        self.store.commit({"dq_results": self._added(tests.select(*DQ_RESULTS.fieldNames()), "dq_results")}, note)
        checks.enforce(tests)

    # 5./6. Silver and Gold of the changed periods (or all), tested, then put in place together
    def build(self, institutions: DataFrame) -> DataFrame:
        periods = self._stale() if self.rebuild == "periods" else None
        source = bronze.current(self.store.read("bronze", BRONZE_HISTORY, periods))
        eligible = silver.remove_quarantined(source, self.store.read("quarantined", QUARANTINED))
        slv = tables.stage(self.spark, silver.build_silver(eligible, None, grain=self.grain), "silver")
        s_tests = tables.stage(self.spark, checks.run_model_tests(
            slv, checks.silver_tests(tuple(reference.codes("lcr_line_codes"))), "silver", self.now), "silver-tests")
        self._record(s_tests, "silver tests")
        gld = tables.stage(self.spark, gold.build_gold(slv, reference.line_codes(self.spark), institutions,
                                                       codes_rows=reference.code_list_rows("lcr_line_codes")), "gold")
        g_tests = tables.stage(self.spark, checks.run_model_tests(gld, checks.gold_tests(), "gold", self.now), "gold-tests")
        self._record(g_tests, "gold tests")
        swap = {"by_period": True, "periods": periods, "all": periods is None}
        self.store.commit({"silver": self.store.written(slv, "silver", **swap), "gold": self.store.written(gld, "gold", **swap)},
                          "build", {"stale": [], "unpublished": sorted({*self._unpublished(), *(periods or self.store.periods("bronze"))})})
        return s_tests.unionByName(g_tests)

    def _unpublished(self) -> list[str]:
        """Periods of Gold that were built since submissions were last published."""
        return self.store.state()["values"].get("unpublished", [])

    # 7. PUBLISHED for accepted submissions in Gold lineage; the others are superseded and stay ACCEPTED
    def publish(self) -> None:
        built = self.store.read("gold", GOLD, self._unpublished())
        in_gold = built.select(F.explode(F.split("submission_ids", ",")).alias("submission_id")).distinct()
        done = tables.stage(self.spark, self._open(ACCEPTED).join(in_gold, "submission_id", "left_semi").select("submission_id"), "published")
        self.store.commit({"ledger": self._events(done, "PUBLISHED"), "open": self._moved(ACCEPTED, self._open(ACCEPTED).limit(0))},
                          "publish", {"unpublished": []})

    def process(self, institutions: DataFrame) -> dict[str, DataFrame]:
        """Steps 2 to 7 for all open submissions."""
        validated = self.validate()
        todo = self.load()
        loaded = tables.stage(self.spark, self.loaded_rows(todo), "loaded")
        dq, gate = self.judge()
        tests = self.build(institutions)
        self.publish()
        for table in APPENDED:
            self.store.compact(table, SCHEMAS[table])
        read = lambda name: self.store.read(name, SCHEMAS[name])
        return {"validated": validated, "bronze": loaded, "dq": dq, "gate": gate, "tests": tests, "silver": read("silver"),
                "gold": read("gold"), "status": ledger.current_status(read("ledger"))}


def run_lcr_batch(spark: SparkSession, landing: str, warehouse: str, institutions: DataFrame,
                  quarantine: str = "sticky", grain: str = "line",
                  large_bytes: int = raw.LARGE_FILE_BYTES, rebuild: str = "periods",
                  database: str | None = None, file_system=None) -> dict[str, DataFrame]:
    """Process every new file in ``landing`` and every submission that an earlier run left open.

    Returns the per-stage DataFrames (read back).  Files above ``large_bytes``
    are never loaded as one row: they are hashed in chunks, validated and
    parsed by the splittable path.  ``rebuild``: ``"periods"`` rebuilds only
    the reporting periods whose Bronze rows changed (Silver and Gold are keyed
    within a period, so this equals a full rebuild); ``"full"`` rebuilds
    everything, as the reference's models do.  With ``database`` the tables are
    declared in the catalog.
    """
    flow = Flow(spark, warehouse, quarantine, grain, rebuild)
    decided = flow.store.read("files", FILES) if flow.store.has("files") else None
    paths = new_files(spark, landing, decided)
    read = raw.files_with_manifests(spark, landing, large_bytes, paths, file_system) if paths else \
        raw.files_with_manifests(spark, landing, large_bytes, None, file_system).where(F.lit(False))
    intaken = flow.receive(read.withColumn("received_at", F.col("modified_at")))
    out = flow.process(institutions)
    if database:
        declare_tables(spark, warehouse, database)
    return {"intake": intaken} | out
