"""Silver: the current, validated version of every LCR line.

Latest-version selection is an aggregate, not a window: ``max(struct(version,
loaded_at, ...))`` per key is computed partially on the map side, so a key
with a long history (or a hot institution) never has to be sorted in one task.
The struct carries only the columns Silver keeps; the submission id and the
amount break ties, which makes the choice deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_KEY = ["institution_id", "reporting_period", "line_code", "currency"]
RETURN_KEY = ["institution_id", "reporting_period"]
SID = "submission_id"


def quarantined_submissions(dq_results: DataFrame, mode: str = "sticky",
                            stage: str = "bronze") -> DataFrame:
    """Submission ids excluded from Silver.

    ``sticky`` (as the reference): a blocking FAIL in ANY run keeps the sid out,
    because results are append-only.  ``latest_run``: only the most recent run
    (max ``checked_at``) of the sid counts.
    """
    r = dq_results.where((F.col("stage") == stage) & F.col(SID).isNotNull())
    blocking_fail = ((F.col("severity") == "blocking") & (F.col("outcome") == "FAIL"))
    if mode == "sticky":
        return r.where(blocking_fail).select(SID).distinct()
    if mode == "latest_run":
        per_run = r.groupBy(SID, "checked_at").agg(F.max(blocking_fail.cast("int")).alias("f"))
        last = per_run.groupBy(SID).agg(F.max(F.struct("checked_at", "f")).alias("last"))
        return last.where(F.col("last.f") == 1).select(SID)
    raise ValueError(f"unknown quarantine mode: {mode}")


def remove_quarantined(bronze: DataFrame, quarantined: DataFrame) -> DataFrame:
    """``sid NOT IN (quarantined)`` without the null-aware broadcast-only plan.

    Both sides are NULL-guarded, so a plain left-anti join is equivalent and
    can shuffle when the quarantined set is large (AQE broadcasts it when not).
    """
    q = quarantined.where(F.col(SID).isNotNull()).select(SID)
    return bronze.where(F.col(SID).isNotNull()).join(q, SID, "left_anti")


SILVER_PAYLOAD = ["submission_version", "loaded_at", SID, "amount"]


def latest_per_line(bronze: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """Row with the highest (version, loaded_at) per (inst, period, line, currency).

    Only the columns Silver keeps travel through the shuffle.
    """
    payload = payload or SILVER_PAYLOAD
    order = ["submission_version", "loaded_at"] + [c for c in payload
                                                    if c not in ("submission_version", "loaded_at")]
    best = bronze.groupBy(*LINE_KEY).agg(F.max(F.struct(*order)).alias("b"))
    return best.select(*LINE_KEY, *[F.col(f"b.{c}").alias(c) for c in payload])


def latest_per_return(bronze: DataFrame) -> DataFrame:
    """All lines of the newest submission per (inst, period) (``grain='submission'``)."""
    newest = (bronze.groupBy(*RETURN_KEY)
              .agg(F.max(F.struct("submission_version", "loaded_at", SID)).alias("b"))
              .select(*RETURN_KEY, F.col(f"b.{SID}").alias(SID)))
    return bronze.join(newest, [*RETURN_KEY, SID], "left_semi")


def build_silver(bronze: DataFrame, dq_results: DataFrame | None = None,
                 quarantine: str = "sticky", grain: str = "line",
                 build_ts: bool = True) -> DataFrame:
    eligible = bronze
    if dq_results is not None:
        eligible = remove_quarantined(bronze, quarantined_submissions(dq_results, quarantine))
    if grain == "line":
        current = latest_per_line(eligible)
    elif grain == "submission":
        current = latest_per_return(eligible)
    else:
        raise ValueError(f"unknown grain: {grain}")
    cols = [F.col("institution_id"), F.col("reporting_period"), F.col("line_code"),
            F.col("currency"), F.col("amount").cast("decimal(20,2)").alias("amount"),
            F.col(SID), F.col("submission_version"),
            F.col("loaded_at").alias("bronze_loaded_at")]
    if build_ts:
        cols.append(F.localtimestamp().alias("silver_built_at"))
    return current.select(*cols)
