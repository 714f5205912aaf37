"""Relations derived from the TPC-H-like test tables.

The engine's inputs (LCR returns, institutions, payment events, landing
files) are not in the test tables, so they are derived from them with plain
DataFrame expressions.  Every derivation reads its whole source table, so
its work grows with the scale factor.  The oracle SQL in
``lakepipe.plans.oracle`` derives the same relations in DuckDB.

Fault injection (bad cells, duplicates, late events) is keyed on row
attributes with a modulo, never by dropping or sampling rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.columns import file_name, raw_key, submission_id
from lakepipe.functions.joins import join_dimension

# LCR line codes in template order (looked up by line number 1..7),
# and the four institution types.
LINE_CODES = ["HQLA_L1", "HQLA_L2A", "HQLA_L2B", "OUT_RETAIL", "OUT_WHOLESALE",
              "OUT_OTHER", "IN_TOTAL"]
INSTITUTION_TYPES = ["COMMERCIAL_BANK", "ISLAMIC_BANK", "INVESTMENT_BANK", "DFI"]
PAYMENT_SYSTEMS = ["RTGS", "INSTANT", "CARD", "CHEQUE"]

# Institution ids have three digits, so there are as many institutions as source keys up to 999.
N_GOLD = N_RULES = N_FILES = 999
# Versions of submissions made from a group of orders start here, those of lines dealt out by supplier are 1 to 3.
ORDER_VERSION = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def institution_id(key: str | Column, n: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("FI"), F.lpad((k % n + 1).cast("string"), 3, "0"))


def _period(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM")


def _line_code(linenumber: str) -> Column:
    return F.try_element_at(F.array(*[F.lit(c) for c in LINE_CODES]), F.col(linenumber))


def _loaded_at(period: Column, version: Column) -> Column:
    """Load time of a version: 5 days per version (they repeat after three) after the period's end + 5 days."""
    end = F.last_day(F.to_date(F.concat(period, F.lit("-01"))))
    return F.date_add(end, ((version - 1) % 3 + 1) * 5 + 5).cast("timestamp_ntz")


def lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join every derived LCR line comes from (lineitem join orders)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def lcr_lines(spark: SparkSession, sf_dir: str, n: int, faults: bool = False,
              base: DataFrame | None = None) -> DataFrame:
    """One LCR submission line per lineitem (lineitem join orders).

    Every third group of eight orders is a submission of its own: its lines
    nearly always hold all seven codes, whatever the scale.  The other lines
    are dealt out by supplier, month and quantity.  With ``faults`` the rule-test variant injects NULLs, negative amounts and an
    unknown currency.  ``base``: an already materialised ``lineitem_orders``.
    """
    j = base if base is not None else lineitem_orders(spark, sf_dir)
    group = F.expr("l_orderkey div 8")
    own = group % 3 == 0
    inst = institution_id(F.when(own, group).otherwise(F.col("l_suppkey")), n)
    month = F.concat((F.floor(group / 12) % 6 + 1993).cast("string"), F.lit("-"), F.lpad((group % 12 + 1).cast("string"), 2, "0"))
    period = F.when(own, month).otherwise(_period("o_orderdate"))
    version = F.when(own, (group % 1000000000).cast("int") + ORDER_VERSION).otherwise(
        F.floor("l_quantity").cast("int") % 3 + 1)
    line_code = _line_code("l_linenumber")
    currency = F.lit("MYR")
    amount = F.col("l_extendedprice").cast("decimal(20,2)")
    if faults:
        line_code = (F.when(F.col("l_orderkey") % 71 == 0, F.lit(None).cast("string"))
                     .when(F.col("l_orderkey") % 73 == 0, F.lit("HQLA_X")).otherwise(line_code))
        currency = (F.when(F.col("l_partkey") % 97 == 0, F.lit("XXX"))
                    .when(F.col("l_partkey") % 89 == 0, F.lit(None).cast("string"))
                    .otherwise(currency))
        amount = (F.when(F.col("l_partkey") % 79 == 0, F.lit(None).cast("decimal(20,2)"))
                  .when(F.col("l_orderkey") % 83 == 0, -amount)
                  .otherwise(amount))
    rows = j.select(inst.alias("institution_id"), period.alias("reporting_period"),
                    line_code.alias("line_code"), currency.alias("currency"),
                    amount.alias("amount"), version.alias("submission_version"), own.alias("own"))
    return rows.withColumn(
        "submission_id", submission_id("institution_id", F.lit("LCR"), "reporting_period",
                                       "submission_version"))


def with_audit(df: DataFrame) -> DataFrame:
    """Submission id and Bronze audit columns for derived submissions, all made from the row's other columns."""
    df = df.withColumn("submission_id", submission_id("institution_id", F.lit("LCR"), "reporting_period", "submission_version"))
    fname = file_name("institution_id", F.lit("LCR"), "reporting_period", "submission_version")
    key = raw_key("institution_id", F.lit("LCR"), "reporting_period", "submission_version", fname)
    return (df.withColumn("source_uri", F.concat(F.lit("raw/"), key))
              .withColumn("source_sha256", F.sha2(F.col("submission_id"), 256))
              .withColumn("loaded_at", _loaded_at(F.col("reporting_period"),
                                                  F.col("submission_version"))))


BRONZE_COLUMNS = ["institution_id", "reporting_period", "line_code", "currency", "amount",
                  "submission_id", "submission_version", "source_uri", "source_sha256",
                  "loaded_at"]


LINE_KEYS = ["institution_id", "reporting_period", "line_code", "currency", "submission_version"]


def _presum(lines: DataFrame) -> DataFrame:
    """Lines of the same key inside a submission summed, without the columns that ``with_audit`` makes of the others.

    The lines come in order of orders, so a partial sum of a task holds nearly
    all its lines and saves nothing: they are shuffled first, and a task sums
    whole returns.
    """
    rows = lines.select(*LINE_KEYS, "amount").repartition("institution_id", "reporting_period")
    return rows.groupBy(*LINE_KEYS).agg(F.sum("amount").cast("decimal(20,2)").alias("amount"))


def lcr_bronze(spark: SparkSession, sf_dir: str, n: int = N_GOLD) -> DataFrame:
    """Bronze table of derived returns: one row per (submission, line, currency).

    Lines of the same key inside a submission are pre-summed, so every
    submission is a well-formed return.  Rows of a submission stand together.
    """
    rows = _presum(lcr_lines(spark, sf_dir, n))
    together = rows.sortWithinPartitions("institution_id", "reporting_period", "submission_version")
    return with_audit(together).select(*BRONZE_COLUMNS)


def rules_rows(spark: SparkSession, sf_dir: str, n: int = N_RULES, base: DataFrame | None = None,
               faults: bool = True) -> DataFrame:
    """``lcr_rules_input`` without the columns that ``with_audit`` adds."""
    lines = lcr_lines(spark, sf_dir, n, faults=faults, base=base)
    return lines.where("not own").select(*LINE_KEYS, "amount").unionByName(_presum(lines.where("own")))


def lcr_rules_input(spark: SparkSession, sf_dir: str, n: int = N_RULES, base: DataFrame | None = None,
                    faults: bool = True) -> DataFrame:
    """Bronze-shaped rows (with injected faults unless ``faults=False``), for the rule engine.

    Groups of orders are well-formed returns, one row a line and currency (but
    for faults); the other submissions repeat their lines.
    """
    return with_audit(rules_rows(spark, sf_dir, n, base, faults)).select(*BRONZE_COLUMNS)


def institutions(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Institution dimension: all suppliers folded onto ``n`` institution ids.

    Name and peer group (nation) come from the lowest supplier key of the
    group, size band from the summed account balance.
    """
    s = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sn = join_dimension(s, nat, s.s_nationkey == nat.n_nationkey, "left")
    first = F.min(F.struct("s_suppkey", "s_name", "s_nationkey", "n_name"))
    g = (sn.groupBy(institution_id("s_suppkey", n).alias("institution_id"))
           .agg(first.alias("f"), F.sum("s_acctbal").alias("bal")))
    types = F.array(*[F.lit(t) for t in INSTITUTION_TYPES])
    return g.select(
        "institution_id",
        F.col("f.s_name").alias("institution_name"),
        F.element_at(types, (F.col("f.s_nationkey") % 4 + 1).cast("int")).alias("institution_type"),
        F.col("f.n_name").alias("peer_group"),
        F.when(F.col("bal") < 0, F.lit("SMALL")).when(F.col("bal") < 20000, F.lit("MEDIUM"))
         .otherwise(F.lit("LARGE")).alias("size_band"),
        F.date_add(F.lit("1995-01-01").cast("date"),
                   (F.col("f.s_suppkey") % 80 * 45).cast("int")).alias("active_from"))


def institution_versions(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Institutions with a second version five years after the first."""
    first = institutions(spark, sf_dir, n)
    second = first.withColumns({"institution_name": F.concat("institution_name", F.lit(" II")),
                                "active_from": F.date_add("active_from", 1826)})
    return first.unionByName(second)


# ------------------------------------------------------- submission files

CONTRACT_HEADER = "institution_id,reporting_period,line_code,currency,amount"
REORDERED_HEADER = "reporting_period,institution_id,line_code,currency,amount"
SHORT_HEADER = "institution_id,reporting_period,line_code,currency"


def order_files(spark: SparkSession, sf_dir: str, n: int = N_FILES) -> DataFrame:
    """One submission file per order, its lines from the order's lineitems.

    Columns: submission_id, raw_key, file_name, content, manifest.  Injected:
    bad institution ids / periods, empty currencies and amounts, non-numbers,
    padded amounts, reordered or short headers, blank tail lines, wrong record
    counts and missing manifests.  An order has a bounded number of lines, so
    building its file text is a bounded per-group aggregate.
    """
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    j = od.join(li, od.o_orderkey == li.l_orderkey, "left")
    inst = institution_id("o_custkey", n)
    period = _period("o_orderdate")
    amount = F.col("l_extendedprice").cast("decimal(20,2)")
    amt = amount.cast("string")
    pk = F.col("l_partkey")
    f_inst = F.when(pk % 71 == 0, F.concat(F.lit("X"), inst)).otherwise(inst)
    f_period = F.when(pk % 73 == 0, F.regexp_replace(period, "-", "/")).otherwise(period)
    f_cur = F.when(pk % 67 == 0, F.lit("")).otherwise(F.lit("MYR"))
    f_amt = (F.when(pk % 53 == 0, F.lit("x")).when(pk % 59 == 0, F.lit(""))
             .when(pk % 61 == 0, F.lit("1_000")).when(pk % 43 == 0, F.concat(F.lit(" "), amt, F.lit(" ")))
             .otherwise(amt))
    reordered = F.col("o_orderkey") % 31 == 0
    line = F.when(reordered, F.concat_ws(",", f_period, f_inst, _line_code("l_linenumber"), f_cur, f_amt)) \
            .otherwise(F.concat_ws(",", f_inst, f_period, _line_code("l_linenumber"), f_cur, f_amt))
    entry = F.when(F.col("l_orderkey").isNotNull(),
                   F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", line.alias("line")))
    g = (j.groupBy("o_orderkey", "o_custkey", "o_orderdate")
          .agg(F.array_sort(F.collect_list(entry)).alias("recs"),
               F.count("l_orderkey").alias("n_lines"),
               F.sum(amount.cast("decimal(38,2)")).alias("total")))
    ok = F.col("o_orderkey")
    header = (F.when(ok % 31 == 0, F.lit(REORDERED_HEADER)).when(ok % 37 == 0, F.lit(SHORT_HEADER))
              .otherwise(F.lit(CONTRACT_HEADER)))
    # recs.line: the struct field of every element (no lambda needed)
    body = F.when(F.col("n_lines") > 0, F.concat(F.array_join(F.col("recs.line"), "\n"), F.lit("\n"))) \
            .otherwise(F.lit(""))
    content = F.concat(header, F.lit("\n"), body, F.when(ok % 41 == 0, F.lit("\n")).otherwise(F.lit("")))
    version = (ok + 1).cast("int")
    g = g.select(inst.alias("institution_id"), period.alias("reporting_period"),
                 version.alias("version"), content.alias("content"), "n_lines", "total",
                 F.col("o_orderkey"), F.col("o_orderdate"))
    fname = file_name("institution_id", F.lit("LCR"), "reporting_period", "version")
    manifest = F.when(ok % 53 != 0, F.struct(
        fname.alias("file_name"), F.col("institution_id"), F.lit("LCR").alias("return_type"),
        F.col("reporting_period"), F.col("version"),
        (F.col("n_lines") + F.when(ok % 29 == 0, 1).otherwise(0)).cast("long").alias("record_count"),
        F.round(F.coalesce(F.col("total"), F.lit(0).cast("decimal(38,2)")), 2).cast("double")
         .alias("control_total"),
        F.sha2(F.col("content"), 256).alias("sha256"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        F.lit(True).alias("synthetic")))
    return g.select(
        submission_id("institution_id", F.lit("LCR"), "reporting_period", "version").alias("submission_id"),
        raw_key("institution_id", F.lit("LCR"), "reporting_period", "version", fname).alias("raw_key"),
        fname.alias("file_name"), "content", manifest.alias("manifest"))


def return_files(spark: SparkSession, sf_dir: str, n: int = N_RULES) -> DataFrame:
    """The well-formed returns (groups of orders, faults included) as arrived files, as the landing scan reads files.

    A return has a bounded number of lines, so building its text is a bounded
    per-group aggregate.
    """
    lines = lcr_lines(spark, sf_dir, n, faults=True).where("own")
    keys = ["institution_id", "reporting_period", "submission_version", "submission_id"]
    summed = lines.groupBy(*keys, "line_code", "currency").agg(F.sum("amount").cast("decimal(20,2)").alias("amount"))
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat_ws(",", "institution_id", "reporting_period", cell("line_code"), cell("currency"), cell("amount"))
    files = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("lines"), F.sum("amount").alias("total"))
    name = file_name("institution_id", F.lit("LCR"), "reporting_period", "submission_version")
    content = F.concat(F.lit(CONTRACT_HEADER + "\n"), F.array_join("lines", "\n"), F.lit("\n"))
    files = files.withColumns({"file_name": name, "content": content})
    sha = F.sha2("content", 256)
    manifest = F.struct(
        "file_name", "institution_id", F.lit("LCR").alias("return_type"), "reporting_period", F.col("submission_version").alias("version"),
        F.size("lines").cast("long").alias("record_count"), F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("control_total"),
        sha.alias("sha256"), F.lit(None).cast("string").alias("generated_at"), F.lit(True).alias("synthetic"))
    arrived = _loaded_at(F.col("reporting_period"), F.col("submission_version"))
    path = F.concat(F.lit("landing/"), F.col("file_name"))
    return files.select(
        path.alias("path"), path.alias("file_path"), "file_name", F.octet_length("content").cast("long").alias("bytes"),
        arrived.alias("modified_at"), arrived.alias("received_at"), sha.alias("sha256"), F.lit(True).alias("utf8_ok"), "content",
        F.lit(False).alias("large"), F.lit(None).cast("boolean").alias("bom"), manifest.alias("manifest"),
        F.lit(None).cast("string").alias("manifest_text"), F.col("submission_version").alias("__version"))


def landing_files(spark: SparkSession, sf_dir: str, n: int = N_FILES) -> DataFrame:
    """Files arriving at the gateway, one per document (exact copies included).

    Columns: path, file_name, content, sha256, received_at, manifest (NULL
    when missing; its sha256 deliberately wrong for some files).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    did = F.col("doc_id")
    inst = institution_id("doc_id", n)
    period = F.concat(F.lit("2024-"), F.lpad((did % 12 + 1).cast("string"), 2, "0"))
    version = (did % 2 + 1).cast("string")
    good = F.concat(inst, F.lit("_LCR_"), period, F.lit("_v"), version, F.lit(".csv"))
    name = (F.when(did % 17 == 0, F.concat(F.lit("FI"), did.cast("string"), F.lit("_LCR.csv")))
            .when(did % 19 == 0, F.lower(good)).otherwise(good))
    sha = F.sha2(F.col("text"), 256)
    manifest = F.when(did % 23 != 0, F.struct(
        F.when(did % 29 == 0, F.sha2(F.concat(F.col("text"), F.lit("x")), 256)).otherwise(sha)
         .alias("sha256"),
        F.lit(1).cast("long").alias("record_count")))
    return d.select(
        F.concat(F.lit("landing/"), did.cast("string"), F.lit("/"), name).alias("path"),
        name.alias("file_name"), F.col("text").alias("content"), sha.alias("sha256"),
        F.timestamp_add("MINUTE", did, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
         .alias("received_at"),
        manifest.alias("manifest"))


# ------------------------------------------------------------ payment events

N_PAY_INST = 999
SENTINEL_INST = "SENTINEL"


def payment_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments topic as JSON lines: value, arrival (ingest time), copy.

    One event per ``events`` row; injected: events 1-4 minutes late
    (event_id % 50), 7 minutes late (% 170), an unknown direction (% 140), re-sent copies (% 100) arriving
    30 s later, or 15 min later (% 300), malformed JSON (% 250).
    """
    from lakepipe.functions.columns import ntz_to_epoch_millis
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    shift = (F.when(eid % 170 == 0, F.lit(7)).when(eid % 50 == 0, F.expr("event_id div 50") % 4 + 1)
             .otherwise(F.lit(0)))
    event_time = ntz_to_epoch_millis(F.timestamp_add("MINUTE", -shift, F.col("ts")))
    systems = F.array(*[F.lit(s) for s in PAYMENT_SYSTEMS])
    obj = F.struct(
        eid.cast("string").alias("event_id"),
        institution_id("user_id", N_PAY_INST).alias("institution_id"),
        event_time.alias("event_time"),
        F.element_at(systems, (F.col("user_id") % 4 + 1).cast("int")).alias("payment_system"),
        F.when(eid % 140 == 7, F.lit("BOTH")).when(eid % 2 == 0, F.lit("OUT")).otherwise(F.lit("IN")).alias("direction"),
        F.col("value").alias("amount"),
        F.lit("MYR").alias("currency"),
        F.when(F.col("event_type") == "error", F.lit("FAILED"))
         .when(F.col("event_type") == "signup", F.lit("PENDING")).otherwise(F.lit("SETTLED")).alias("status"))
    js = F.to_json(obj)
    broken = F.concat(F.lit('{"event_id":"'), eid.cast("string"), F.lit('","amount":'))
    value = F.when(eid % 250 == 0, broken).otherwise(js)
    base = e.select(value.alias("value"), F.col("ts").alias("arrival"), F.lit(0).alias("copy"), eid.alias("src_id"))
    again = (e.where(eid % 100 == 0)
             .select(value.alias("value"),
                     F.when(eid % 300 == 0, F.timestamp_add("MINUTE", F.lit(15), F.col("ts")))
                      .otherwise(F.timestamp_add("SECOND", F.lit(30), F.col("ts"))).alias("arrival"),
                     F.lit(1).alias("copy"), eid.alias("src_id")))
    return base.unionByName(again)


def sentinel_event(spark: SparkSession) -> DataFrame:
    """A far-future event that moves the watermark past every real window."""
    return spark.range(1).select(
        F.to_json(F.struct(F.lit("sentinel").alias("event_id"), F.lit(SENTINEL_INST).alias("institution_id"),
                           F.lit(4102444800000).alias("event_time"), F.lit("RTGS").alias("payment_system"),
                           F.lit("IN").alias("direction"), F.lit(0.0).alias("amount"),
                           F.lit("MYR").alias("currency"), F.lit("SETTLED").alias("status"))).alias("value"))
