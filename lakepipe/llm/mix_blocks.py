"""Mixing sources to target weights (10): packed blocks drawn through index permutations.

Method, in DataFrame functions only: the words of a source, its documents in
hash order, are one sequence that is cut into blocks of ``BLOCK_WORDS``.  Each
source gets a number of slots in the mix by its target; a slot falls into an
output shard by its hash, so that a shard's counts of sources are multinomial
draws, given the totals.  A slot's number is mapped to a block's number by
the source's permutation x -> a x + c modulo the number of blocks, another one
each time the source has been used up, and joined to that block.

The place of a document in its source is found in two steps, sums of hash
ranges and then places within a range, so no task holds a source.  Slots are
made in chunks that are dealt out, so no task makes those of a source.

Defined results: a null text has no words and is never taken; a null source is
a source of its own, the last; rows that are equal in id and text are
documents of their own but give the same text; a source without words gets
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import BROADCAST_BYTES, stage

BLOCK_WORDS = 64
SHARDS = 256
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Hash ranges of a source's documents, and slots in a chunk.
RANGES, CHUNK = 4096, 4096
#: Multipliers for the permutations, fixed primes; for any number of blocks under 8e12 one of them does not divide it.
PRIMES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121)
WORDS = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _row_key(docs: DataFrame) -> Column:
    """A key of the text and all columns but the id: rows that share it with their id are equal."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    more = F.hex(F.xxhash64(F.to_json(F.struct(*rest)))) if rest else F.lit("")
    return F.concat_ws(":", text_key(F.col("text")), more)


def _narrow(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """Each document without its text: key, source, words, place in its source's order; row numbers are kept by staging.

    The key is that of the text, or of the whole row.
    """
    key = text_key(F.col("text"))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), key)
                                     .cast("binary")), 1, 12), 16, 10).cast("long")
    return stage(docs.sparkSession, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (_row_key(docs) if whole_rows else key).alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"), place.alias("place"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")


def targets(rows: DataFrame) -> DataFrame:
    """Per source: number, words, weight, target words, blocks and slots.

    Targets share all words by weight, but none passes MOST_TIMES its source:
    in the order of cap by weight, sources are full up to some one, and the
    rest share what the full ones leave.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    s = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("number", F.row_number().over(by_name) - 1)
         .withColumn("weight", weight.cast("long")).withColumn("cap", MOST_TIMES * F.col("source_size")))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("left", F.sum("source_size").over(every)
                      - F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("of", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("full", F.col("cap") * F.col("of") <= F.col("left") * F.col("weight"))
         .withColumn("share", F.max(F.when(~F.col("full"), F.col("left") / F.col("of"))).over(every)))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("share") * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long")
    return s.select("source", "number", "source_size", "weight", target.alias("target"), blocks.alias("blocks")).withColumn(
        "slots", F.when(F.col("blocks") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5))
        .otherwise(0).cast("long"))


def _bounded(df: DataFrame, row_bytes: int = 256) -> DataFrame:
    """Broadcast a staged table if it is small; otherwise it is joined by shuffling."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _with_source(rows: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    s = sources.select(F.col("source").alias("_source"), "number", *columns)
    return rows.join(_bounded(s), rows["source"].eqNullSafe(F.col("_source")), "left").drop("_source")


def segments(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The pieces of documents that each block holds: number, block, row, doc_id, text_key, from (word of the document), words."""
    r = _with_source(rows.where("size > 0"), sources).withColumn("range", F.col("place").bitwiseAND(F.lit(RANGES - 1)))
    sums = r.groupBy("number", "range").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    within = (Window.partitionBy("number", "range").orderBy("place", "doc_id", "text_key", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    r = r.join(sums, ["number", "range"]).withColumn("start", start).withColumn("end", F.col("start") + F.col("size"))
    b = r.withColumn("block", F.explode(F.sequence(F.expr(f"start div {BLOCK_WORDS}"), F.expr(f"(end - 1) div {BLOCK_WORDS}"))))
    lo = F.greatest("start", F.col("block") * BLOCK_WORDS)
    hi = F.least("end", (F.col("block") + 1) * BLOCK_WORDS)
    return b.select("number", "block", "row", "doc_id", "text_key", "size", (lo - F.col("start")).alias("from"), (hi - lo).alias("words"))


def slots(sources: DataFrame) -> DataFrame:
    """The slots of the mix: output shard, source number, slot number in the source, block."""
    some = sources.where("slots > 0").select("number", "blocks", "slots")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK}")))
    # a given number of parts: the few rows here become many, which their present size does not tell
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = some.select("*", chunk.alias("chunk")).repartition(parts, "number", "chunk")
    first = F.col("chunk") * CHUNK
    s = dealt.select("number", "blocks", F.explode(F.sequence(first, F.least(first + CHUNK, "slots") - 1)).alias("slot"))
    turn, at = F.expr("slot div blocks"), F.expr("slot % blocks")
    fit = F.filter(F.array(*[F.lit(p).cast("long") for p in PRIMES]), lambda p: F.col("blocks") % p != 0)
    a = F.element_at(fit, ((F.col("number") + turn) % F.size(fit) + 1).cast("int"))
    c = (F.col("number") * 7919 + turn * 104729 + 1) * 1299709
    block = (a * at + c) % F.col("blocks")
    shard = F.pmod(F.xxhash64("number", "slot"), F.lit(SHARDS)).cast("int")
    return s.select(shard.alias("shard"), "number", "slot", block.alias("block"))


def _taken(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each segment with the number of slots that took its block, 0 left out."""
    times = slots(sources).groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    # as many rows as blocks, though made from a table of few: never broadcast on its estimated size
    return segments(rows, sources).join(times.hint("merge"), ["number", "block"])


def mixture(docs: DataFrame) -> DataFrame:
    """One row per document with the words that the mix takes of it (see the contract of op10)."""
    rows = _narrow(docs)
    sources = stage(docs.sparkSession, targets(rows), "mix-sources")
    took = _taken(rows, sources).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = _with_source(rows, sources, "source_size", "target").join(took, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each time that words of a document are taken, with the words then taken as its text.

    A text that is taken whole is left as it is.  All columns are kept;
    ``n_chars``, if there is one, is that of the new text.  Rows equal in id
    and text but not in other columns are documents of their own, each with
    its source and columns.
    """
    rows = _narrow(docs, whole_rows=True)
    sources = stage(docs.sparkSession, targets(rows), "mix-sources")
    parts = _taken(rows, sources).groupBy("row", "doc_id", "text_key", "size").agg(
        F.array_sort(F.collect_list(F.struct("from", "words", "times"))).alias("_parts"))
    parts = parts.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("size").alias("_size"), "_parts")
    if rows.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
        # equal rows: each of them has its parts, and one copy of the row serves all
        docs = docs.withColumn("_row_key", _row_key(docs)).dropDuplicates(["doc_id", "_row_key"]).drop("_row_key")
    names = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_doc"), F.col("doc_id").alias("_doc_id"),
                    _row_key(docs).alias("_text_key"))
    both = d.join(parts, F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    # split once, before rows are made for each time, and only texts that are not always taken whole
    times = F.transform("_parts", lambda p: p["times"])
    total = lambda parts: F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + p["words"])
    always = (total(F.col("_parts")) == F.col("_size")) & (F.array_min(times) == F.array_max(times))
    words = F.split(F.regexp_replace(F.col("_doc.text"), f"^{GAPS}", ""), GAPS)
    both = both.withColumn("_words", F.when(~always, words)).withColumn("_most", F.array_max(times))
    both = both.select("_doc", "_size", "_parts", "_words", F.explode(F.sequence(F.lit(1).cast("long"), "_most")).alias("_time"))
    both = both.withColumn("_chosen", F.filter("_parts", lambda p: p["times"] >= F.col("_time")))
    whole = total(F.col("_chosen")) == F.col("_size")
    piece = F.array_join(F.flatten(F.transform(
        "_chosen", lambda p: F.slice(F.col("_words"), (p["from"] + 1).cast("int"), p["words"].cast("int")))), " ")
    both = both.withColumn("_text", F.when(whole, F.col("_doc.text")).otherwise(piece))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast(kinds.get("n_chars", "long"))}
    return both.select(*[new.get(n, F.col("_doc").getField(n)).alias(n) for n in names])
