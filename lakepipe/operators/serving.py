"""Serving queries over Gold and the quality results, with access policies.

Policies are data (role -> mask / row filter) applied as ordinary column
expressions, so a row filter is pushed into the Parquet scan like any other
predicate.
"""

from __future__ import annotations

from functools import lru_cache

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.contracts import RESOURCES

REFERENCE_LINE = 1.0      # minimum LCR (100 %)
WATCH_LINE = 1.2          # dashboard threshold (120 %)


def ratio_by_institution(gold: DataFrame) -> DataFrame:
    """Ratio per institution and period with the 100 % reference line."""
    return gold.select("institution_id", "reporting_period", "lcr_ratio",
                       (F.col("lcr_ratio") < REFERENCE_LINE).alias("below_minimum"))


def ratio_trend(gold: DataFrame) -> DataFrame:
    """Average ratio per period and peer group."""
    # exact sum of the 4-place ratios, then one division: independent of row order
    total = F.sum(F.col("lcr_ratio").cast("decimal(38,4)")).cast("double")
    return gold.groupBy("reporting_period", "peer_group").agg(
        F.try_divide(total, F.count("lcr_ratio").cast("double")).alias("avg_lcr_ratio"),
        F.count("lcr_ratio").alias("n_ratios"))


def below_threshold(gold: DataFrame, threshold: float = WATCH_LINE) -> DataFrame:
    """Institutions below the watch line."""
    return gold.where(F.col("lcr_ratio") < threshold).select(
        "institution_id", "institution_name", "reporting_period", "lcr_ratio")


def point_lookup(gold: DataFrame, institution_id: str, period: str) -> DataFrame:
    """One institution and period (both predicates reach the scan)."""
    return gold.where((F.col("institution_id") == institution_id) & (F.col("reporting_period") == period))


@lru_cache(maxsize=None)
def load_policies(name: str = "gold") -> tuple:
    return tuple(yaml.safe_load((RESOURCES / "policies" / f"{name}.yaml").read_text()))


def apply_policy(df: DataFrame, role: str, schema: str = "gold", policies=None) -> DataFrame:
    """J6 + J7: column masks and row filters of a role; unknown roles see nothing."""
    rules = [p for p in (policies or load_policies()) if p["role"] == role
             and p.get("schema") in ("*", schema)]
    if not rules:
        raise PermissionError(f"role {role!r} has no access to schema {schema!r}")
    out = df
    for p in rules:
        if p.get("filter"):
            out = out.where(F.expr(p["filter"]))
        for c in p.get("columns", []):
            if c["name"] in out.columns:
                out = out.withColumn(c["name"], F.expr(c["mask"]).cast(out.schema[c["name"]].dataType))
    return out


def lineage(gold: DataFrame, bronze: DataFrame) -> DataFrame:
    """Every Gold number back to its submissions and raw files."""
    g = gold.select("institution_id", "reporting_period", "lcr_ratio",
                    F.explode(F.split("submission_ids", ",")).alias("submission_id"))
    files = bronze.select("submission_id", "source_uri", "source_sha256").distinct()
    return g.join(files, "submission_id", "left")


def monthly_payments(stats: DataFrame) -> DataFrame:
    """Minute statistics rolled up to institution and month."""
    return (stats.groupBy("institution_id", F.date_format("window_start", "yyyy-MM").alias("month"))
            .agg(F.sum("event_count").alias("event_count"),
                 F.sum(F.col("total_amount").cast("decimal(38,10)")).cast("double").alias("total_amount"),
                 F.sum("failed_count").alias("failed_count")))


def mixed_batch_stream(gold: DataFrame, stats: DataFrame) -> DataFrame:
    """Payment activity per institution and month next to its latest LCR."""
    latest = gold.groupBy("institution_id").agg(
        F.max(F.struct("reporting_period", "lcr_ratio")).alias("l"))
    latest = latest.select("institution_id", F.col("l.reporting_period").alias("latest_period"),
                           F.col("l.lcr_ratio").alias("latest_lcr_ratio"))
    return monthly_payments(stats).join(latest, "institution_id", "left")
