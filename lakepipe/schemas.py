"""Table and record schemas (explicit everywhere: no inference passes)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
AMOUNT = T.DecimalType(20, 2)

_NAMED = {"string": S, "long": L, "int": I, "double": D, "boolean": B, "amount": AMOUNT, "time": T.TimestampNTZType(), "strings": T.ArrayType(S)}


def columns(text: str) -> T.StructType:
    """A schema from "name type, ..." with the type names above (no session is needed)."""
    return T.StructType([T.StructField(name, _NAMED[kind]) for name, kind in (c.split() for c in text.split(","))])


# Business columns of one LCR submission line, in contract order.
LCR_BUSINESS = T.StructType([
    T.StructField("institution_id", S),
    T.StructField("reporting_period", S),
    T.StructField("line_code", S),
    T.StructField("currency", S),
    T.StructField("amount", AMOUNT),
])

BRONZE_LCR = T.StructType(LCR_BUSINESS.fields + [
    T.StructField("submission_id", S),
    T.StructField("submission_version", I),
    T.StructField("source_uri", S),
    T.StructField("source_sha256", S),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# Bronze keeps replaced rows: a row is current until the time it was replaced.
BRONZE_HISTORY = T.StructType(BRONZE_LCR.fields + [T.StructField("replaced_at", T.TimestampNTZType())])

# The list of loads: what each delivery put into Bronze, and into which partitions.
LOADS = T.StructType([
    T.StructField("submission_id", S),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("rows", L),
    T.StructField("periods", T.ArrayType(S)),
])

MANIFEST = T.StructType([
    T.StructField("file_name", S),
    T.StructField("institution_id", S),
    T.StructField("return_type", S),
    T.StructField("reporting_period", S),
    T.StructField("version", I),
    T.StructField("record_count", L),
    T.StructField("control_total", D),
    T.StructField("sha256", S),
    T.StructField("generated_at", S),
    T.StructField("synthetic", B),
])

DQ_RESULTS = T.StructType([
    T.StructField("rule_id", S),
    T.StructField("rule_version", S),
    T.StructField("contract", S),
    T.StructField("stage", S),
    T.StructField("submission_id", S),
    T.StructField("dimension", S),
    T.StructField("severity", S),
    T.StructField("records_tested", L),
    T.StructField("records_failed", L),
    T.StructField("outcome", S),
    T.StructField("checked_at", T.TimestampNTZType()),
])

SUBMISSION_EVENT = T.StructType([
    T.StructField("event_id", L),
    T.StructField("submission_id", S),
    T.StructField("status", S),
    T.StructField("detail", S),          # JSON text
    T.StructField("created_at", T.TimestampNTZType()),
])

# The payment event as produced on the topic, names in the producer's order
# (event_time is epoch milliseconds).
PAYMENT_EVENT = T.StructType([
    T.StructField("event_id", S),
    T.StructField("institution_id", S),
    T.StructField("event_time", L),
    T.StructField("payment_system", S),
    T.StructField("direction", S),
    T.StructField("amount", D),
    T.StructField("currency", S),
    T.StructField("status", S),
])

# Reference tables (explicit schemas instead of the inference pass).
REFERENCE_SCHEMAS = {
    "institutions": T.StructType([
        T.StructField("institution_id", S), T.StructField("institution_name", S),
        T.StructField("institution_type", S), T.StructField("peer_group", S),
        T.StructField("size_band", S), T.StructField("active_from", T.DateType())]),
    "lcr_line_codes": T.StructType([
        T.StructField("line_code", S), T.StructField("line_description", S),
        T.StructField("category", S), T.StructField("weight", T.DecimalType(5, 2))]),
    "currencies": T.StructType([
        T.StructField("currency_code", S), T.StructField("currency_name", S),
        T.StructField("is_reporting_currency", B)]),
    "institution_types": T.StructType([
        T.StructField("institution_type", S), T.StructField("description", S)]),
    "return_types": T.StructType([
        T.StructField("return_type", S), T.StructField("description", S),
        T.StructField("frequency", S), T.StructField("contract", S), T.StructField("mode", S)]),
}
