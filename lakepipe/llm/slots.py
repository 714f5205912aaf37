"""Sharding (3): fixed virtual slots and a versioned slot-to-shard map.

Method, in DataFrame functions only: a record's hash puts it into one of
``SLOTS`` virtual slots for good.  Bytes are summed per slot, and a map gives
each slot a shard so that shards hold nearly equal bytes.  The map is a small
versioned table; rebalancing, or another number of shards, edits it by moving
as few bytes as it can.  Texts are never shuffled: a row's shard is an entry
of the map.

The law is ``bytes``: as slots are dealt largest first to the lightest shard,
two shards differ by the bytes of one slot at most.  Rows that are equal in id
and text share a slot, whatever their number.

Defined results: a null text has no bytes; null ids are hashed like a value;
an empty table gives an empty result (and a map that deals the slots evenly).
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import stage

SLOTS = 4096
SHARDS = 24
ROW_BYTES = 8


def record_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def deal(slot_bytes: list[int], shards: int) -> list[int]:
    """A first map: largest slot first, each to the shard that is lightest so far (empty slots in turn)."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(slot_bytes)
    for n, slot in enumerate(sorted(range(len(slot_bytes)), key=lambda i: (-slot_bytes[i], i))):
        if slot_bytes[slot]:
            held, shard = heapq.heappop(heap)
            heapq.heappush(heap, (held + slot_bytes[slot], shard))
        else:
            shard = n % shards
        out[slot] = shard
    return out


def rebalance(slot_bytes: list[int], old: list[int], shards: int) -> list[int]:
    """Edit a map: while it evens them out, move a slot from the heaviest shard to the lightest; all else stays.

    Slots of shards that no longer exist are dealt first.
    """
    new = list(old)
    held = [0] * shards
    own: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(old):
        if shard < shards:
            held[shard] += slot_bytes[slot]
            own[shard].append(slot)
        else:
            homeless.append(slot)

    def put(slot: int, shard: int) -> None:
        new[slot] = shard
        held[shard] += slot_bytes[slot]
        own[shard].append(slot)

    for slot in sorted(homeless, key=lambda i: (-slot_bytes[i], i)):
        put(slot, min(range(shards), key=lambda s: (held[s], s)))
    while True:
        hi, lo = max(range(shards), key=lambda s: held[s]), min(range(shards), key=lambda s: held[s])
        gap = held[hi] - held[lo]
        fits = [s for s in own[hi] if 0 < slot_bytes[s] < gap]
        if not fits:
            return new
        slot = min(fits, key=lambda s: (abs(gap - 2 * slot_bytes[s]), s))
        own[hi].remove(slot)
        held[hi] -= slot_bytes[slot]
        put(slot, lo)


def totals(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot, from rows with ``virtual_slot`` and ``size``: one driver row a slot, however many records."""
    held, count = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        held[r["virtual_slot"]], count[r["virtual_slot"]] = r["b"], r["n"]
    return held, count


def _entry(values: list[int], slot: Column) -> Column:
    """The value of a slot, from a literal array (as many values as slots)."""
    return F.element_at(F.expr("array(" + ",".join(f"{v}L" for v in values) + ")"), slot + 1)


def write_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Add a version of the map to its table (slot, shard, version)."""
    n = spark.range(len(shard_of)).select(F.col("id").cast("int").alias("slot"))
    (n.select("slot", _entry(shard_of, F.col("slot")).cast("int").alias("shard"), F.lit(version).alias("version"))
     .coalesce(1).write.mode("append").parquet(path))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """A version of the map, the newest by default."""
    table = spark.read.parquet(path)
    version = table.agg(F.max("version")).first()[0] if version is None else version
    return version, [r["shard"] for r in table.where(F.col("version") == version).orderBy("slot").collect()]


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), record_size(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
                       record_slot(F.col("doc_id"), F.col("text")).alias("virtual_slot"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, shard_of: list[int] | None = None) -> DataFrame:
    """One row per document: size, text_crc32, law, shard, place in the shard, slot (see the contract of op3)."""
    rows = stage(docs.sparkSession, _narrow(docs), "slots")
    held, count = totals(rows)
    shard_of = shard_of or deal(held, shards)
    # places of a shard run through its slots in turn, so they are numbered slot by slot
    before, base = [0] * shards, []
    for slot, shard in enumerate(shard_of):
        base.append(before[shard])
        before[shard] += count[slot]
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    slot = F.col("virtual_slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                       _entry(shard_of, slot).cast("int").alias("shard"), (_entry(base, slot) + place - 1).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def with_shards(docs: DataFrame, shards: int = SHARDS, shard_of: list[int] | None = None) -> DataFrame:
    """The documents with the columns ``shard`` and ``virtual_slot`` (replaced, if there are such); texts stay where they are."""
    if shard_of is None:
        shard_of = deal(totals(_narrow(docs).select("virtual_slot", "size"))[0], shards)
    slot = record_slot(F.col("doc_id"), F.col("text"))
    return docs.withColumns({"virtual_slot": slot, "shard": _entry(shard_of, slot).cast("int")})
