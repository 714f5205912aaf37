"""Capabilities declared by the contracts and docs.

All are DataFrame compositions: joins to (size-checked) reference tables,
per-row predicates, and aggregates with map-side partial results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.contracts import Contract
from lakepipe.functions.columns import period_end, submission_deadline
from lakepipe.functions.joins import checked_broadcast


# ----------------------------------------------------------------- L3 / L4

def codelist_violations(rows: DataFrame, code_lists: dict[str, list[str]],
                        minimum: dict[str, float] | None = None, key: str = "submission_id") -> DataFrame:
    """Values missing from their code list and values below a minimum, found in one pass over the rows.

    ``code_lists``: column -> allowed codes (packaged lists, a handful of
    values each).  NULLs are a completeness problem, not a code-list one, and
    are not reported here.  Result: key, column, value, rows.
    """
    def found(column: str, bad) -> Column:
        return F.when(bad, F.struct(F.lit(column).alias("column"), F.col(column).cast("string").alias("value")))

    flags = [found(c, ~F.col(c).isin(codes)) for c, codes in code_lists.items()]
    flags += [found(c, F.col(c) < F.lit(lo)) for c, lo in (minimum or {}).items()]
    bad = rows.select(key, F.inline(F.filter(F.array(*flags), lambda x: x.isNotNull())))
    return bad.groupBy(key, "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def schema_violations(rows: DataFrame, contract: Contract, enums: dict[str, list[str]],
                      keys: tuple[str, ...] = ("submission_id", "line_no")) -> DataFrame:
    """JSON-Schema style row check: required, enum, pattern, minimum, no extra columns.

    One output row per violation: keys..., property, violation.
    """
    checks = []
    for p in contract.properties:
        c = F.col(p.name)
        missing = c.isNull() | (c.cast("string") == "")
        if p.required:
            checks.append(F.when(missing, F.struct(F.lit(p.name).alias("property"),
                                                   F.lit("missing").alias("violation"))))
        if p.name in enums:
            checks.append(F.when(~missing & ~c.isin(enums[p.name]),
                                 F.struct(F.lit(p.name).alias("property"), F.lit("not in enum").alias("violation"))))
        if p.pattern:
            checks.append(F.when(~missing & ~c.rlike(p.pattern),
                                 F.struct(F.lit(p.name).alias("property"),
                                          F.lit("does not match pattern").alias("violation"))))
        if p.minimum is not None:
            checks.append(F.when(~missing & (c < F.lit(p.minimum)),
                                 F.struct(F.lit(p.name).alias("property"),
                                          F.lit("below minimum").alias("violation"))))
    return rows.select(*keys, F.inline(F.filter(F.array(*checks), lambda x: x.isNotNull())))


def extra_columns(df: DataFrame, contract: Contract, allowed: tuple[str, ...] = ()) -> list[str]:
    """additionalProperties: false -> columns outside the contract (schema-level check)."""
    return [c for c in df.columns if c not in contract.column_names and c not in allowed]


# ------------------------------------------------------------ L6 timeliness

def timeliness(submissions: DataFrame, days_after_period_end: int) -> DataFrame:
    """Deadline = period end + N calendar days; late when received after that day.

    A period that is no month has no deadline: deadline, days_late and on_time are NULL.
    """
    deadline = submission_deadline("reporting_period", days_after_period_end)
    received_day = F.to_date("received_at")
    return submissions.select(
        "submission_id", "reporting_period", deadline.alias("deadline"), "received_at",
        F.when(deadline.isNotNull(), F.greatest(F.datediff(received_day, deadline), F.lit(0))).alias("days_late"),
        (received_day <= deadline).alias("on_time"))


# ------------------------------------------------------------- L7 freshness

def exact_percentile(values: DataFrame, group: str, value: str, p: float) -> DataFrame:
    """Exact percentile (linear interpolation) per group without holding a group in memory.

    Counts per (group, value) are pre-aggregated map-side; the per-group window
    then runs over distinct values only (e.g. latency in whole seconds), and
    the two order statistics around rank p*(n-1) are interpolated.
    """
    hist = values.groupBy(group, value).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group)
    j = hist.withColumn("__cum", F.sum("__c").over(w)).withColumn("__n", F.sum("__c").over(whole))
    pos = F.lit(p) * (F.col("__n") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    start = F.col("__cum") - F.col("__c")
    covers = lambda r: (start <= r) & (r < F.col("__cum"))
    agg = j.groupBy(group).agg(F.max(F.when(covers(lo), F.col(value))).alias("__vlo"),
                               F.max(F.when(covers(hi), F.col(value))).alias("__vhi"),
                               F.first(pos).alias("__pos"), F.first("__n").alias("n"))
    frac = F.col("__pos") - F.floor(F.col("__pos"))
    return agg.select(group, "n", (F.col("__vlo") + frac * (F.col("__vhi") - F.col("__vlo")))
                      .cast("double").alias(f"p{int(p * 100)}"))


#: Size of a latency sketch: rank errors of under 1 %, a few kilobytes each.
SKETCH_K = 400


def latency_sketches(values: DataFrame, group: str, at: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """A quantile sketch of a whole-number value per group and minute, for a running job to append.

    Result: group, minute, n, sketch.  NULL values are left out; a minute without a value has no row.
    """
    return (values.where(F.col(value).isNotNull()).groupBy(group, F.date_trunc("minute", at).alias("minute"))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(k)).alias("sketch")))


def sketched_percentile(sketches: DataFrame, group: str, p: float, k: int = SKETCH_K) -> DataFrame:
    """The percentile of any span of minutes from their sketches alone: group, n, and ``p95`` for 0.95."""
    merged = sketches.groupBy(group).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("__all"))
    return merged.select(group, "n", F.kll_sketch_get_quantile_bigint("__all", F.lit(float(p))).alias(f"p{int(p * 100)}"))


def rank_check(values: DataFrame, percentiles: DataFrame, group: str, value: str, p: float, bound: float) -> DataFrame:
    """Whether each percentile's rank among all values is within ``bound`` of ``p``: the percentiles and within_bound."""
    name = f"p{int(p * 100)}"
    found = checked_broadcast(percentiles.select(F.col(group).alias("__group"), F.col(name).alias("__at")))
    v = F.col(value)
    ranks = (values.where(v.isNotNull()).join(found, F.col(group).eqNullSafe(F.col("__group"))).groupBy("__group")
             .agg(F.avg((v < F.col("__at")).cast("int")).alias("__below"), F.avg((v <= F.col("__at")).cast("int")).alias("__upto")))
    ok = (F.col("__below") <= p + bound) & (F.col("__upto") >= p - bound)
    return percentiles.join(ranks, F.col(group).eqNullSafe(F.col("__group"))).withColumn("within_bound", ok).drop(
        "__group", "__below", "__upto")


def gold_freshness(gold: DataFrame, accepted: DataFrame, hours: int) -> DataFrame:
    """Gold available within N hours of the accepted submission."""
    lag = F.timestamp_diff("SECOND", F.col("accepted_at"), F.col("gold_built_at")) / 3600.0
    g = gold.select("gold_built_at", F.explode(F.split("submission_ids", ",")).alias("submission_id"))
    return g.join(accepted.select("submission_id", "accepted_at"), "submission_id").select(
        "submission_id", lag.alias("hours_to_gold"), (lag <= hours).alias("within_sla"))


# --------------------------------------------------------------- L8 retention

def retention_candidates(table: DataFrame, zone: str, years: int, as_of: str,
                         period_col: str = "reporting_period") -> DataFrame:
    """Partitions whose period ended more than ``years`` before ``as_of``."""
    expires = F.add_months(period_end(period_col), 12 * years)
    return (table.groupBy(period_col).agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("expires_on", expires)
            .where(F.col("expires_on") < F.lit(as_of).cast("date"))
            .select(F.lit(zone).alias("zone"), period_col, "row_count", "expires_on"))


# -------------------------------------------------------- L10 completeness

def expected_returns(onboarding: DataFrame, as_of_period: str) -> DataFrame:
    """Expected (institution, period) from each institution's first period up to as-of.

    Bounded per institution by the number of months; no cross join.
    """
    start = F.to_date(F.concat(F.col("first_period"), F.lit("-01")))
    end = F.to_date(F.lit(as_of_period + "-01"))
    months = F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))
    return onboarding.where(start <= end).select(
        "institution_id", F.explode(months).alias("m")).select(
        "institution_id", F.date_format("m", "yyyy-MM").alias("reporting_period"))


def missing_returns(expected: DataFrame, received: DataFrame) -> DataFrame:
    keys = ["institution_id", "reporting_period"]
    return expected.join(received.select(*keys).distinct(), keys, "left_anti")


# ----------------------------------------------------- L12 bitemporal join

def as_of_reference(facts: DataFrame, institutions: DataFrame, period_col: str = "reporting_period") -> DataFrame:
    """Attach the institution attributes valid at the period end: of several versions, the newest by then."""
    versions = Window.partitionBy("institution_id").orderBy("active_from")      # an institution's few versions
    inst = checked_broadcast(institutions.select(
        F.col("institution_id").alias("__iid"), "institution_name", "peer_group", "active_from",
        F.lead("active_from").over(versions).alias("__until")))
    end = period_end(period_col)
    cond = ((F.col("institution_id") == F.col("__iid")) & (F.col("active_from") <= end)
            & (F.col("__until").isNull() | (F.col("__until") > end)))
    return facts.join(inst, cond, "left").drop("__iid", "__until")


# ------------------------------------------------------- L15 schema evolution

def read_evolving(spark, path: str) -> DataFrame:
    """Read a table whose files gained columns over time; old rows read NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)
