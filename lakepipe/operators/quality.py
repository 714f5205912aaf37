"""Quality-rules engine (rules as data, results as data).

All rules of a stage are evaluated for all submissions in one pass:

* row rules (not_null, accepted_values, range, row_expression) and aggregate
  rules become ``count_if`` / aggregate expressions of ONE
  ``groupBy(submission_id).agg(...)`` (partial + final hash aggregate, so a
  hot submission is pre-aggregated on the map side);
* each ``unique`` rule needs the key-group counts, i.e. a second aggregate
  ``groupBy(sid, keys)`` -> ``groupBy(sid)``, joined back on the sid;
* the wide row per submission is turned into one result row per rule with
  ``inline(array(struct ...))`` (no shuffle).

A submission without any rows (e.g. every line rejected upstream) still gets
results when the submission list is passed in: the aggregate rules are then
evaluated on the empty input, as a plain aggregate over zero rows would be.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.contracts import Rule, RuleSet
from lakepipe.functions.columns import any_null

KEY = "submission_id"
_TESTED = "__tested"
_ALL = "__all"


#: Compilers of rules that judge single rows: type -> (table, rule) -> TRUE for a failing row.
ROW_RULES: dict[str, Callable[[DataFrame, Rule], Column]] = {}


def _compiles(rule_type: str):
    def register(compile_rule):
        ROW_RULES[rule_type] = compile_rule
        return compile_rule
    return register


@_compiles("not_null")
def _missing(df: DataFrame, rule: Rule) -> Column:
    return any_null(*rule.columns)


@_compiles("accepted_values")
def _unlisted(df: DataFrame, rule: Rule) -> Column:
    value = F.col(rule.column)
    # a NULL is not in the list either, unless the rule leaves NULLs to other rules
    return F.coalesce(~value.isin(*rule.values), F.lit(not rule.ignore_null))


@_compiles("range")
def _outside(df: DataFrame, rule: Rule) -> Column:
    value = F.col(rule.column)
    text = isinstance(df.schema[rule.column].dataType, T.StringType) if rule.column in df.columns else False

    def comparable(bound) -> Column:
        """The value in a type that the bound can be compared with, whatever the text holds (ANSI)."""
        return value.try_cast("decimal(38,10)" if isinstance(bound, int) else "double") if text else value

    broken = [beyond(comparable(bound), F.lit(bound))
              for bound, beyond in ((rule.min, operator.lt), (rule.max, operator.gt)) if bound is not None]
    return reduce(operator.or_, broken, F.lit(False))


@_compiles("row_expression")
def _untrue(df: DataFrame, rule: Rule) -> Column:
    return ~F.expr(rule.expression)


def _failed_count(df: DataFrame, rule: Rule) -> Column:
    """Aggregate that counts what a rule finds in a submission (an aggregate rule counts 1 or 0)."""
    if rule.type in ROW_RULES:
        return F.count_if(ROW_RULES[rule.type](df, rule))
    holds = F.coalesce(F.expr(rule.expression), F.lit(False))
    return (~holds).cast("long")


def _fcol(rule: Rule) -> str:
    return "__f_" + rule.id.replace("-", "_")


def _check(rules: RuleSet) -> None:
    # Unknown types fail at compile time, before any job runs.
    for r in rules.rules:
        if r.type not in {*ROW_RULES, "unique", "aggregate_expression"}:
            raise ValueError(f"Unknown rule type: {r.type}")


def evaluate_wide(df: DataFrame, rules: RuleSet, key: str | None = KEY,
                  submissions: DataFrame | None = None) -> DataFrame:
    """One row per submission: ``key, __tested, __f_<rule> ...`` (failed counts)."""
    _check(rules)
    if key is None:
        # Whole-table rules (Silver/Gold checks): one group under a constant key.
        df = df.withColumn(_ALL, F.lit(0))
        key = _ALL
    keys = [key]
    plain = [r for r in rules.rules if r.type != "unique"]
    uniques = [r for r in rules.rules if r.type == "unique"]
    aggs = [F.count(F.lit(1)).alias(_TESTED)] + [_failed_count(df, r).alias(_fcol(r)) for r in plain]
    wide = df.groupBy(*keys).agg(*aggs)
    dups = []
    for r in uniques:
        groups = df.groupBy(*keys, *r.columns).agg(F.count(F.lit(1)).alias("__n"))
        dups.append(groups.groupBy(*keys).agg(F.count_if(F.col("__n") > 1).alias(_fcol(r))))
    if key == _ALL and dups:
        # one row per side: stack them and take each column's value (a join on a
        # constant key would be planned as a cross join)
        cols = wide.columns + [d.columns[1] for d in dups]
        parts = [x.select(*[F.col(c) if c in x.columns else F.lit(None).cast("long").alias(c) for c in cols])
                 for x in [wide, *dups]]
        stacked = parts[0]
        for p in parts[1:]:
            stacked = stacked.unionByName(p)
        wide = stacked.groupBy(_ALL).agg(*[F.max(c).alias(c) for c in cols if c != _ALL])
    else:
        for dup in dups:
            wide = wide.join(dup, keys, "left")
    if submissions is not None and key != _ALL:
        wide = _with_empty_submissions(df, rules, wide, submissions.select(key).distinct(), key)
    return wide


def _with_empty_submissions(df, rules, wide, subs, key):
    """Left-join the submission list; sids with no rows get zero-row outcomes."""
    agg_rules = [r for r in rules.rules if r.type == "aggregate_expression"]
    empty = {}
    if agg_rules:
        # A global aggregate over zero rows returns exactly one row of constants.
        row = df.limit(0).agg(*[_failed_count(df, r).alias(_fcol(r)) for r in agg_rules]).first()
        empty = {c: row[c] for c in row.asDict()}
    out = subs.join(wide, key, "left")
    fill = {_TESTED: 0}
    for r in rules.rules:
        fill[_fcol(r)] = empty.get(_fcol(r), 0)
    return out.select(key, *[F.coalesce(F.col(c), F.lit(v).cast("long")).alias(c) for c, v in fill.items()])


def to_results(wide: DataFrame, rules: RuleSet, stage: str, key: str | None = KEY,
               checked_at: Column | None = None) -> DataFrame:
    """Explode the wide row into the ``dq_results`` long format."""
    entries = [F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.dimension).alias("dimension"),
                        F.lit(r.severity).alias("severity"),
                        F.col(_fcol(r)).cast("long").alias("records_failed"))
               for r in rules.rules]
    sid = F.col(key) if key and key != _ALL else F.lit(None).cast("string")
    ts = checked_at if checked_at is not None else F.localtimestamp()
    return (wide
            .select(sid.alias("submission_id"), F.col(_TESTED).cast("long").alias("records_tested"),
                    F.inline(F.array(*entries)))
            .select("rule_id",
                    F.lit(rules.version).alias("rule_version"),
                    F.lit(rules.contract).alias("contract"),
                    F.lit(stage).alias("stage"),
                    "submission_id", "dimension", "severity", "records_tested", "records_failed",
                    F.when(F.col("records_failed") == 0, F.lit("PASS"))
                     .otherwise(F.lit("FAIL")).alias("outcome"),
                    ts.cast("timestamp_ntz").alias("checked_at")))


def evaluate(df: DataFrame, rules: RuleSet, stage: str = "bronze", key: str | None = KEY,
             submissions: DataFrame | None = None, checked_at: Column | None = None) -> DataFrame:
    """``run_rules`` for every submission at once -> dq_results rows."""
    staged = rules.for_stage(stage)
    wide = evaluate_wide(df, staged, key, submissions)
    return to_results(wide, staged, stage, key, checked_at)


def gate(results: DataFrame, key: str = KEY) -> DataFrame:
    """Severity gate: QUARANTINED iff a blocking rule failed, else ACCEPTED."""
    blocked = F.max(((F.col("severity") == "blocking") & (F.col("outcome") == "FAIL")).cast("int"))
    return (results.groupBy(key)
            .agg(blocked.alias("__b"),
                 F.count_if((F.col("severity") == "blocking") & (F.col("outcome") == "FAIL"))
                  .alias("blocking_failures"))
            .select(key,
                    F.when(F.col("__b") == 1, F.lit("QUARANTINED")).otherwise(F.lit("ACCEPTED"))
                     .alias("status"),
                    "blocking_failures"))


def failures_by_rule(results: DataFrame) -> DataFrame:
    """Dashboard view: failed rule results per rule and submission."""
    return (results.where(F.col("outcome") == "FAIL")
            .groupBy("rule_id", "submission_id")
            .agg(F.count(F.lit(1)).alias("failed_runs"),
                 F.sum("records_failed").alias("records_failed")))
