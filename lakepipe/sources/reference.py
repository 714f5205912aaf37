"""Reference data: code lists shipped with the engine and the reference load job."""

from __future__ import annotations

import csv
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakepipe.contracts import RESOURCES
from lakepipe.schemas import REFERENCE_SCHEMAS

REFERENCE_FILES = {
    "institutions": "institutions.csv",
    "lcr_line_codes": "code-lists/lcr-line-codes.csv",
    "currencies": "code-lists/currencies.csv",
    "institution_types": "code-lists/institution-types.csv",
    "return_types": "code-lists/return-types.csv",
}


def _convert(value: str, dtype: T.DataType):
    if isinstance(dtype, T.DecimalType):
        return Decimal(value)
    if isinstance(dtype, T.BooleanType):
        return value.strip().lower() == "true"
    return value


@lru_cache(maxsize=None)
def _packaged_rows(name: str) -> tuple:
    schema = REFERENCE_SCHEMAS[name]
    with open(RESOURCES / "reference" / f"{name}.csv", newline="", encoding="utf-8") as fh:
        return tuple(tuple(_convert(r[f.name], f.dataType) for f in schema.fields)
                     for r in csv.DictReader(fh))


def _sql_literal(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.DecimalType):
        return f"CAST({v} AS {dtype.simpleString()})"
    if isinstance(dtype, T.BooleanType):
        return "true" if v else "false"
    return "'" + str(v).replace("'", "''") + "'"


def code_list(spark: SparkSession, name: str) -> DataFrame:
    """A packaged code list (a few fixed rows of configuration) as a local relation."""
    schema = REFERENCE_SCHEMAS[name]
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in _packaged_rows(name))
    cols = ", ".join(f.name for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({cols})")


def line_codes(spark: SparkSession) -> DataFrame:
    return code_list(spark, "lcr_line_codes")


def code_list_rows(name: str) -> int:
    """Row count of a packaged code list (known without a job)."""
    return len(_packaged_rows(name))


def codes(name: str) -> list[str]:
    """The codes of a packaged code list (its first column)."""
    return [r[0] for r in _packaged_rows(name)]


def read_reference(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One reference CSV with its explicit schema (no inference pass)."""
    return (spark.read.schema(REFERENCE_SCHEMAS[name]).option("header", True)
            .option("mode", "FAILFAST").csv(f"{directory.rstrip('/')}/{REFERENCE_FILES[name]}"))


def load_reference(spark: SparkSession, directory: str, target: str,
                   names: tuple[str, ...] = tuple(REFERENCE_FILES)) -> dict[str, int]:
    """Idempotent daily full replace of the reference tables (A4 + A5 + A15).

    ``target`` is a folder of parquet tables.  Returns rows written per table
    (counted on the written table, not by re-reading the CSV).
    """
    from lakepipe.sources.tables import create_or_replace
    counts = {}
    for name in names:
        path = f"{target.rstrip('/')}/{name}"
        create_or_replace(read_reference(spark, directory, name), path)
        counts[name] = spark.read.parquet(path).count()
    return counts
