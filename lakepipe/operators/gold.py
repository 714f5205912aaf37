"""Gold: liquidity coverage ratio per institution and period.

Sums are exact decimals (order-free across partitions); the ratio is the
double quotient of the unrounded sums, rounded to 4 places.  ``least`` keeps
the NULL-propagating semantics of the reference's SQL engine: a period
without inflows (or outflows) has no net outflows and no ratio.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.columns import safe_divide, strict_least
from lakepipe.functions.joins import join_dimension

GOLD_COLUMNS = ["institution_id", "institution_name", "institution_type", "peer_group",
                "reporting_period", "hqla", "outflows", "inflows", "net_outflows",
                "lcr_ratio", "submission_ids"]

INFLOW_CAP = Decimal("0.75")   # fixed value: inflows count up to 75 % of outflows


def aggregate_returns(silver: DataFrame, line_codes: DataFrame, codes_rows: int | None = None) -> DataFrame:
    """Per (inst, period): weighted HQLA, outflows, inflows, lineage list.

    ``codes_rows``: row count of the code list when known (packaged list).
    """
    codes = line_codes.select("line_code", "category", "weight")
    s = join_dimension(silver, codes, "line_code", known_rows=codes_rows)   # unknown codes drop out
    cat = F.col("category")
    return (s.groupBy("institution_id", "reporting_period")
            .agg(F.sum(F.when(cat == "HQLA", F.col("amount") * F.col("weight"))).alias("hqla_d"),
                 F.sum(F.when(cat == "OUTFLOW", F.col("amount"))).alias("out_d"),
                 F.sum(F.when(cat == "INFLOW", F.col("amount"))).alias("in_d"),
                 F.array_join(F.array_sort(F.collect_set("submission_id")), ",")
                  .alias("submission_ids")))


def ratio_columns(agg: DataFrame) -> DataFrame:
    """G6/G7 on the aggregated sums."""
    dec = "decimal(24,4)"
    capped = strict_least(F.col("in_d").cast(dec), (F.lit(INFLOW_CAP) * F.col("out_d")).cast(dec))
    net = F.col("out_d") - capped
    return agg.select(
        "institution_id", "reporting_period",
        F.round("hqla_d", 2).cast("double").alias("hqla"),
        F.round("out_d", 2).cast("double").alias("outflows"),
        F.round("in_d", 2).cast("double").alias("inflows"),
        F.round(net, 2).cast("double").alias("net_outflows"),
        F.round(safe_divide(F.col("hqla_d").cast("double"), net.cast("double")), 4).alias("lcr_ratio"),
        "submission_ids")


def build_gold(silver: DataFrame, line_codes: DataFrame, institutions: DataFrame,
               build_ts: bool = True, codes_rows: int | None = None) -> DataFrame:
    g = ratio_columns(aggregate_returns(silver, line_codes, codes_rows))
    inst = institutions.select("institution_id", "institution_name", "institution_type", "peer_group")
    out = join_dimension(g, inst, "institution_id", "left")   # unknown institution keeps NULLs
    cols = [F.col(c) for c in GOLD_COLUMNS]
    if build_ts:
        cols.append(F.localtimestamp().alias("gold_built_at"))
    return out.select(*cols)
