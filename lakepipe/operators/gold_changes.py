"""Gold by change (G2, G4): add the delivered lines and subtract the replaced ones.

The state holds a row per institution, period and submission: how many Silver
lines it has in Gold, and by category its sum and the number of its amounts.
All of these are exact and additive, so a change costs the lines that changed
and the state of the pairs they belong to, whatever the size of a period.
Lineage follows from the counts: a submission whose lines are all gone leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.joins import join_dimension
from lakepipe.operators.gold import GOLD_COLUMNS, ratio_columns

PAIR = ["institution_id", "reporting_period"]
KEY = [*PAIR, "submission_id"]
#: State columns of a category, and whether its amounts are weighted.
CATEGORIES = {"HQLA": ("hqla", True), "OUTFLOW": ("out", False), "INFLOW": ("in", False)}
_SUM = "decimal(38,6)"
_LINE = [*KEY, "line_code", "currency", "amount"]


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).cast(_SUM if c.endswith("_sum") else "long").alias(c) for c in columns]


STATE = ["n_lines", *[f"{c}_{kind}" for c, _ in CATEGORIES.values() for kind in ("sum", "n")]]


def contributions(lines: DataFrame, line_codes: DataFrame, codes_rows: int | None = None) -> DataFrame:
    """The state that lines add.  ``n`` tells how often a line counts, negative if it goes; without it each counts once.

    Lines of unknown codes are not in Gold; a NULL amount counts as a line, not as an amount.
    """
    n = F.col("n") if "n" in lines.columns else F.lit(1)
    s = join_dimension(lines.withColumn("n", n.cast("long")), line_codes.select("line_code", "category", "weight"), "line_code", known_rows=codes_rows)
    columns = [F.col("n").alias("n_lines")]
    for category, (name, weighted) in CATEGORIES.items():
        value = F.when(F.col("category") == category, F.col("amount") * F.col("weight") if weighted else F.col("amount"))
        columns += [F.coalesce(value * F.col("n"), F.lit(0)).cast(_SUM).alias(f"{name}_sum"),
                    F.when(value.isNotNull(), F.col("n")).otherwise(0).alias(f"{name}_n")]
    return s.select(*KEY, *columns).groupBy(*KEY).agg(*_sums(STATE))


def line_changes(before: DataFrame, after: DataFrame, touched: DataFrame) -> DataFrame:
    """The Silver lines of the touched pairs by which two states of Silver differ, with ``n``: +1 came, -1 went.

    ``touched``: institution_id, reporting_period of every delivered or
    replaced row.  Lines are compared as a multiset; unchanged ones cancel out.
    """
    pairs = touched.select(*PAIR).distinct()

    def signed(df: DataFrame, n: int) -> DataFrame:
        return df.join(pairs, PAIR, "left_semi").select(*_LINE, F.lit(n).alias("n"))
    return (signed(after, 1).unionByName(signed(before, -1)).groupBy(*_LINE)
            .agg(F.sum("n").alias("n")).where("n != 0"))


def apply_changes(state: DataFrame, changes: DataFrame, line_codes: DataFrame, codes_rows: int | None = None) -> DataFrame:
    """The state after the changes; submissions without a line left are out of it.

    A count below zero means that the changes do not belong to this state: the
    job fails instead of writing a wrong sum.
    """
    both = state.select(*KEY, *STATE).unionByName(contributions(changes, line_codes, codes_rows))
    merged = both.groupBy(*KEY).agg(*_sums(STATE))
    wrong = F.raise_error(F.concat(F.lit("more lines removed than there are: "), F.coalesce(F.col("submission_id"), F.lit("NULL"))))
    checked = merged.withColumn("n_lines", F.when(F.col("n_lines") < 0, wrong).otherwise(F.col("n_lines")))
    return checked.where(F.col("n_lines") > 0)


def gold_of(state: DataFrame, institutions: DataFrame) -> DataFrame:
    """Gold rows of a state (or of some of its pairs), equal to those of a full rebuild."""
    def total(name: str, type_: str, alias: str) -> Column:
        return F.when(F.sum(f"{name}_n") > 0, F.sum(f"{name}_sum")).cast(type_).alias(alias)
    agg = state.groupBy(*PAIR).agg(
        total("hqla", _SUM, "hqla_d"), total("out", "decimal(30,2)", "out_d"), total("in", "decimal(30,2)", "in_d"),
        F.array_join(F.array_sort(F.collect_set("submission_id")), ",").alias("submission_ids"))
    inst = institutions.select("institution_id", "institution_name", "institution_type", "peer_group")
    return join_dimension(ratio_columns(agg), inst, "institution_id", "left").select(*GOLD_COLUMNS)
