"""Retention with an archive copy (L8): expired periods are copied, compared, and only then removed.

The live table and the archive are stores (``sources/versioned.py``).  A period
leaves the live table by a commit that follows the commit of its copy, and the
copy is committed only if its rows, read back, have the fingerprint of the
live rows.  A run that stops anywhere has removed nothing that the archive
does not hold; the next run takes up where it stopped, by the receipts.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources.tables import discard, stage
from lakepipe.sources.versioned import PERIOD, Store, period_part

RECEIPTS = "receipts"
RECEIPT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField(PERIOD, T.StringType()),
    T.StructField("row_count", T.LongType()), T.StructField("sum_a", T.DecimalType(38, 0)),
    T.StructField("sum_b", T.DecimalType(38, 0)), T.StructField("archived_at", T.TimestampNTZType())])
_MARKS = ["row_count", "sum_a", "sum_b"]


def _plain(field: T.StructField) -> Column:
    """A column that hashes by its value: nested ones as JSON, as a hash steps over the NULLs inside them."""
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(F.struct(c)) if nested else c


def fingerprints(df: DataFrame, by: Column, name: str = PERIOD) -> DataFrame:
    """Rows and two sums of 64-bit row hashes per group: the same for the same rows in any order and any files.

    NULLs count by their place, repeated rows by their number; columns are
    taken by name.  One aggregate with partial results; nothing is sorted.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    parts = [x for f in fields for x in (_plain(f), F.col(f"`{f.name}`").isNull())]
    hashed = df.select(by.alias(name), F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))
    return hashed.groupBy(name).agg(F.count(F.lit(1)).alias("row_count"), *[
        F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"sum_{c}") for c in "ab"])


def expired(periods: list[str], years: int, as_of: dt.date) -> list[str]:
    """The months that ended more than ``years`` before ``as_of``; what is no month never expires."""
    def gone(period: str) -> bool:
        year, month = int(period[:4]) + years, int(period[5:])
        return dt.date(year, month, calendar.monthrange(year, month)[1]) < as_of
    return [p for p in periods if len(p) == 7 and p[4] == "-" and gone(p)]


class Retention:
    """The steps by which the expired periods of a table move to the archive."""

    def __init__(self, live: Store, archive: Store, table: str, schema: T.StructType,
                 period_col: str = "reporting_period"):
        self.live, self.archive, self.table, self.schema = live, archive, table, schema
        self.by = period_part(period_col)

    def receipts(self) -> DataFrame:
        return self.archive.read(RECEIPTS, RECEIPT_SCHEMA).where(F.col("table_name") == self.table)

    def _same(self, marks: DataFrame, others: DataFrame) -> list[str]:
        """The periods with equal fingerprints; a list of months."""
        keys = [PERIOD, *_MARKS]
        return [r[PERIOD] for r in marks.join(others.select(*keys), keys, "left_semi").select(PERIOD).distinct().collect()]

    def copied(self, periods: list[str], state: dict) -> dict:
        """Write the periods' rows to the archive, not visible yet."""
        rows = self.live.read(self.table, self.schema, periods=periods, state=state)
        return self.archive.written(rows, self.table, append=True, by_period=True)

    def verified(self, change: dict, marks: DataFrame) -> list[str]:
        """The periods whose copy, read back from its files, has the fingerprint of the live rows."""
        written = {"tables": {self.table: {"format": "parquet", "parts": {p: [x] for p, x in change["parts"].items()}}}}
        return self._same(marks, fingerprints(self.archive.read(self.table, self.schema, state=written), self.by))

    def run(self, years: int, as_of: dt.date, now: dt.datetime) -> dict[str, list[str]]:
        """Move what has expired; returns the periods by outcome: moved, and different (kept in the live table).

        A period with a receipt of the same fingerprint is in the archive
        already (an earlier run stopped after its copy) and is only removed.
        A period that another writer changed meanwhile stays for the next run.
        """
        state = self.live.state()
        due = expired(self.live.periods(self.table, state), years, as_of)
        if not due:
            return {"moved": [], "different": []}
        marks = stage(self.live.spark, fingerprints(self.live.read(self.table, self.schema, periods=due, state=state), self.by), "marks")
        held = self._same(marks, self.receipts())
        new = [p for p in due if p not in held]
        good: list[str] = []
        if new:
            change = self.copied(new, state)
            good = self.verified(change, marks.where(F.col(PERIOD).isin(new)))
        if good:
            receipt = marks.where(F.col(PERIOD).isin(good)).select(
                F.lit(self.table).alias("table_name"), PERIOD, *_MARKS, F.lit(now).cast("timestamp_ntz").alias("archived_at"))
            self.archive.commit({self.table: change | {"parts": {p: change["parts"][p] for p in good}},
                                 RECEIPTS: self.archive.written(receipt, RECEIPTS, append=True)}, f"archive {self.table}")
        discard(marks)
        return {"moved": self.remove([*held, *good], state), "different": [p for p in new if p not in good]}

    def remove(self, periods: list[str], state: dict) -> list[str]:
        """Take archived periods out of the live table, but for those whose files are not the ones that were copied."""
        then, now = (s["tables"].get(self.table, {}).get("parts", {}) for s in (state, self.live.state()))
        same = sorted(p for p in periods if then.get(p) == now.get(p))
        if same:
            self.live.commit({self.table: self.live.removed(same)}, f"archived {self.table}")
        return same
