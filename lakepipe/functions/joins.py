"""Join helpers that keep broadcast decisions honest.

A side is broadcast only after its size has been checked against a bound.
Beyond the bound the join is left to the planner (sort-merge or, with AQE, a
runtime switch once real shuffle sizes are known).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes that a broadcast side may have.
DEFAULT_BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def _bytes(field: T.StructField) -> Column:
    """Size of a value: texts by their length, nested values as JSON, others as a word."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) + 16
    return F.lit(8)


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most so many rows and bytes (one aggregate over it)."""
    size = reduce(lambda a, b: a + b, [_bytes(f) for f in df.schema.fields], F.lit(16))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and BROADCAST_BYTES bytes.

    ``known_rows`` is for relations whose size is fixed when they are built
    (literal VALUES tables such as packaged code lists): no job is needed.
    """
    ok = known_rows <= max_rows if known_rows is not None else fits(df, max_rows)
    return F.broadcast(df) if ok else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Fact-to-dimension join with a size-checked broadcast of the dimension."""
    return fact.join(checked_broadcast(dim, max_rows, known_rows), on, how)
