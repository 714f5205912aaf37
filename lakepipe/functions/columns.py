"""Column-expression helpers.

All of these build Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and do not block predicate pushdown.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's float() accepts '1_000', 'nan' and 'inf'; a supervisor's amount
# must be a plain decimal literal, so those are rejected on purpose.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_null(*cols: str | Column) -> Column:
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in cols])


def strict_least(*cols: str | Column) -> Column:
    """``least`` that is NULL when any argument is NULL (standard SQL engines).

    Spark's own ``least`` skips NULLs: least(NULL, 1.0) = 1.0.
    """
    return F.when(~any_null(*cols), F.least(*[col(c) for c in cols]))


def nullif(c: str | Column, value) -> Column:
    return F.when(col(c) != F.lit(value), col(c))


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """num / nullif(den, 0): NULL instead of an ANSI division error."""
    return F.try_divide(col(num), nullif(den, 0))


def submission_id(inst, rtype, period, version) -> Column:
    return F.concat(col(inst), F.lit("-"), col(rtype), F.lit("-"), col(period),
                    F.lit("-v"), col(version).cast("string"))


def file_name(inst, rtype, period, version) -> Column:
    return F.concat(col(inst), F.lit("_"), col(rtype), F.lit("_"), col(period),
                    F.lit("_v"), col(version).cast("string"), F.lit(".csv"))


def raw_key(inst, rtype, period, version, fname) -> Column:
    return F.concat_ws("/", col(inst), col(rtype), col(period),
                       F.concat(F.lit("v"), col(version).cast("string")), col(fname))


def version_from_sid(sid: str | Column) -> Column:
    """Right-split on '-v' (the last one), as the loader does; NULL if it is no 32-bit number."""
    return F.regexp_extract(col(sid), r"-v([0-9]+)$", 1).try_cast("int")


def period_start(period: str | Column) -> Column:
    """First day of a 'yyyy-MM' period; NULL for a month that does not exist (the contract pattern allows 13)."""
    return F.concat(col(period), F.lit("-01")).try_cast("date")


def period_end(period: str | Column) -> Column:
    return F.last_day(period_start(period))


def submission_deadline(period: str | Column, days: int) -> Column:
    return F.date_add(period_end(period), days)


def epoch_millis_to_ntz(ms: str | Column) -> Column:
    """Epoch milliseconds to a UTC wall-clock TIMESTAMP_NTZ.

    Independent of the session time zone (unlike ``timestamp_millis``).
    """
    return F.timestamp_add("MILLISECOND", col(ms), F.expr(EPOCH_NTZ))


def ntz_to_epoch_millis(ts: str | Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), col(ts))
