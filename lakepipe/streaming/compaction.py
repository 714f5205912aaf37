"""Compaction of a sink's batch folders.

A ``foreachBatch`` sink writes ``run=<run>/batch_id=<n>/...`` folders, many
small files.  Compaction writes finished ones as one load, a folder per day
in order of institutions, and then commits the load together with the number of the
last batch in it, by one pointer.  Readers take both from one pointer: the
loads, and the batch folders after that number.  So a row is seen once before,
during and after, and a compaction that stops has changed nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from lakepipe.sources.tables import delete_folder
from lakepipe.sources.versioned import Store

TABLE, THROUGH = "merged", "through"


class BatchFolders:
    """The batch folders of one sink, and what was merged from them (kept in ``_compacted`` beside them)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, institution: str = "institution_id"):
        self.spark, self.path, self.schema, self.institution = spark, path.rstrip("/"), schema, institution
        self.store, self._files = Store(spark, f"{self.path}/_compacted"), Store(spark, self.path)

    def _batches(self, run: str) -> list[int]:
        """The batches of a run, in order; a stream starts a batch when the one before is done, so all but the last are finished."""
        return sorted(int(n.split("=", 1)[1]) for n in self._files._names(run) if n.startswith("batch_id="))

    def _open(self, state: dict) -> dict[str, list[int]]:
        """The batches that no load holds, by run."""
        through = state["values"].get(THROUGH, {})
        runs = [n for n in self._files._names() if n.startswith("run=")]
        return {r: [b for b in self._batches(r) if b > through.get(r, -1)] for r in runs}

    def _rows(self, batches: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.path}/{r}/batch_id={b}" for r, bs in batches.items() for b in bs]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths).select(*self.schema.names)

    def read(self, state: dict | None = None) -> DataFrame:
        """All rows of the sink; ``state``: those that a reader of that pointer sees."""
        state = state or self.store.state()
        return self.store.read(TABLE, self.schema, state=state).unionByName(self._rows(self._open(state)))

    def merge(self, batches: dict[str, list[int]], day: Column) -> dict:
        """Write the batches' rows as a load that nobody sees yet, a folder a day; its files are in order of institutions.

        A folder per institution too would make more files than the batches had
        where an institution has few events a day.
        """
        load = uuid.uuid4().hex[:16]
        rows = self._rows(batches).withColumn("day", day).hint("rebalance", "day")
        rows.sortWithinPartitions("day", self.institution).write.partitionBy("day").parquet(f"{self.store.root}/{TABLE}/load={load}")
        return {"parts": {"": load}, "append": True, "format": "parquet"}

    def compact(self, day: Column, least: int = 2) -> int:
        """Merge the batches but each run's newest, which may be being written or written again; returns their number.

        Fewer than ``least`` batches are left as they are.
        """
        state = self.store.state()
        batches = {r: bs[:-1] for r, bs in self._open(state).items() if len(bs) > 1}
        n = sum(map(len, batches.values()))
        if n < max(least, 1):
            return 0
        through = state["values"].get(THROUGH, {}) | {r: bs[-1] for r, bs in batches.items()}
        self.store.commit({TABLE: self.merge(batches, day)}, f"compact {n} batches", {THROUGH: through})
        return n

    def clean(self, state: dict) -> int:
        """Delete the batch folders that the loads of an earlier pointer hold; returns their number.

        ``state``: a pointer that every reader at work has seen, such as that
        of the compaction before; readers of older ones still need the folders.
        """
        gone = [f"{self.path}/{r}/batch_id={b}" for r, last in state["values"].get(THROUGH, {}).items()
                for b in self._batches(r) if b <= last]
        for folder in gone:
            delete_folder(self.spark, folder)
        return len(gone)
