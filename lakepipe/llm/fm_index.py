"""Benchmark decontamination (9): an FM-index per shard of training text.

Method: each Arrow batch of documents is a shard.  Its text is turned into
symbols (one for each word of the benchmark), indexed by a suffix array, a
Burrows-Wheeler transform and a wavelet matrix, and all test phrases are
searched backward at once through wavelet ranks.  Occurrences are located by
walking to sampled suffix positions; their word ranges are merged to spans.

Only runs of words that all occur in the benchmark and are as long as the
shortest phrase are indexed: no phrase can lie anywhere else.

Phrases are handed to the tasks in blocks of ``BLOCK_BYTES`` of benchmark
text, one pass over the documents each, so that what a task holds does not
grow with the benchmark.

Defined results: null texts have no words; an item without words has no
window; equal items all count; without benchmark rows nothing is hit;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm.frames import stage, text_hash
from lakepipe.llm.words import Words, covered, slices

WINDOW = 13
BLOCK_BYTES = 2 << 20
SAMPLE = 8
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
SPANS = ("doc_id long, text_hash long, n_words long, n_hit long, span_start array<int>, span_end array<int>, "
         "items array<string>")


class Phrases:
    """All windows of the items of a block, as symbols; phrase p belongs to items ``owners[first[p]:first[p+1]]``."""

    def __init__(self, items: list[tuple[str, str]]):
        w = Words(pa.array([t for _, t in items], type=pa.string()), lower=True)
        self.vocabulary = np.unique(w.hash)
        symbols = np.searchsorted(self.vocabulary, w.hash) + 1
        found: dict[bytes, set[str]] = {}
        for i, (name, _) in enumerate(items):
            own = symbols[w.off[i]: w.off[i + 1]].astype(np.int32)
            for a in range(max(1, len(own) - WINDOW + 1) if len(own) else 0):
                found.setdefault(own[a: a + WINDOW].tobytes(), set()).add(name)
        self.items = [sorted(x) for x in found.values()]
        self.length = np.array([len(x) // 4 for x in found], dtype=np.int64)
        #: last symbol of each phrase first
        self.back = np.zeros((len(found), WINDOW), dtype=np.int32)
        for p, x in enumerate(found):
            self.back[p, : self.length[p]] = np.frombuffer(x, dtype=np.int32)[::-1]
        self.shortest = int(self.length.min()) if len(found) else 0


class FMIndex:
    """Full-text index of a sequence of symbols over 1..sigma; 0 ends each run and is never searched."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        self.n = n
        order = _suffix_order(text)
        last = text[order - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 2))])
        # wavelet matrix: one bit of the symbols a level, ones counted up to each place
        self.levels, cur = [], last
        for shift in range(int(sigma).bit_length() - 1, -1, -1):
            bit = ((cur >> shift) & 1).astype(bool)
            ones = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones, n - int(ones[-1])))
            cur = np.concatenate([cur[~bit], cur[bit]])
        self.base = self._down(np.arange(sigma + 1), np.zeros(sigma + 1, dtype=np.int64))
        self.last = last
        run_start = np.concatenate([[True], text[:-1] == 0])
        self.sampled = (order % SAMPLE == 0) | run_start[order]
        self.sample_no = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            one = ones[at]
            at = np.where((symbol >> shift) & 1, zeros + one, at - one)
        return at

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows below ``at`` whose suffix, with ``symbol`` put before it, sorts lower: the LF mapping."""
        return self.below[symbol] + self._down(symbol, at) - self.base[symbol]

    def search(self, back: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and their ranges of rows."""
        alive = np.arange(len(length))
        lo, hi = np.zeros(len(length), dtype=np.int64), np.full(len(length), self.n, dtype=np.int64)
        for k in range(back.shape[1]):
            go = alive[length[alive] > k]
            lo[go], hi[go] = self.step(back[go, k], lo[go]), self.step(back[go, k], hi[go])
            alive = alive[lo[alive] < hi[alive]]
        return alive, lo[alive], hi[alive]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, each found by walking back to a sampled one."""
        out, walk, steps = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows)), 0
        at = rows.copy()
        while len(walk):
            done = self.sampled[at]
            out[walk[done]] = self.samples[self.sample_no[at[done]]] + steps
            walk, at = walk[~done], at[~done]
            at = self.step(self.last[at], at)
            steps += 1
        return out


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; each 0 is a symbol of its own, so no comparison passes the end of a run."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()))
    width = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == n - 1 or width > n:
            return order


def _shard(batch: pa.RecordBatch, phrases: Phrases):
    """Hit mask of the batch's words, word offsets of its rows, and (row, item) of each item found."""
    symbols, counts, rows = [], [], []
    base = 0
    for part in slices(batch):
        w = Words(part.column("text"), lower=True)
        at = np.minimum(np.searchsorted(phrases.vocabulary, w.hash), len(phrases.vocabulary) - 1)
        symbols.append(np.where(phrases.vocabulary[at] == w.hash, at + 1, 0).astype(np.int32))
        counts.append(w.count)
        rows.append(w.row + base)
        base += w.n_rows
    symbol, row = np.concatenate(symbols), np.concatenate(rows)
    off = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    n = len(symbol)
    known = symbol > 0
    first = known.copy()
    first[1:] &= ~known[:-1] | (row[1:] != row[:-1])
    last = known.copy()
    last[:-1] &= ~known[1:] | (row[1:] != row[:-1])
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = b - a >= phrases.shortest
    a, b = a[long], b[long]
    if not len(a):
        return np.zeros(n, dtype=bool), off, np.zeros((0, 2), dtype=np.int64)
    length = b - a
    place = np.arange(int(length.sum()) + len(a))
    run = np.repeat(np.arange(len(a)), length + 1)
    word = a[run] + place - (np.cumsum(length + 1) - length - 1)[run]
    text = np.where(word < b[run], symbol[np.minimum(word, n - 1)], 0)
    index = FMIndex(text, len(phrases.vocabulary))
    which, lo, hi = index.search(phrases.back, phrases.length)
    if not len(which):
        return np.zeros(n, dtype=bool), off, np.zeros((0, 2), dtype=np.int64)
    size = hi - lo
    at_rows = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    phrase = np.repeat(which, size)
    start = word[index.locate(at_rows)]
    hit = covered(n, start, phrases.length[phrase])
    return hit, off, np.unique(np.stack([row[start], phrase], axis=1), axis=0)


def _search(phrases: Phrases):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            hit, off, found = _shard(batch, phrases)
            # a span starts at a hit word whose predecessor in the same text is not hit
            firsts = np.isin(np.arange(len(hit)), off)
            a = np.flatnonzero(hit & (firsts | ~np.concatenate([[False], hit[:-1]])))
            b = np.flatnonzero(hit & (np.concatenate([firsts[1:], [True]]) | ~np.concatenate([hit[1:], [False]]))) + 1
            lists = np.searchsorted(a, off).astype(np.int32)
            row = np.searchsorted(off, a, side="right") - 1
            ones = np.concatenate([[0], np.cumsum(hit)])
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for r, p in found:
                items[r].update(phrases.items[p])
            ints = lambda x: pa.ListArray.from_arrays(pa.array(lists), pa.array((x - off[row]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(off)),
                 pa.array(ones[off[1:]] - ones[off[:-1]]), ints(a), ints(b),
                 pa.array([sorted(x) for x in items], type=pa.list_(pa.string()))],
                names=["doc_id", "text_hash", "n_words", "n_hit", "span_start", "span_end", "items"])
    return run


def _nothing(batches):
    for batch in batches:
        for part in slices(batch):
            n = part.num_rows
            none = pa.array([[]] * n, type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"),
                 pa.array(Words(part.column("text"), lower=True).count.astype(np.int64)),
                 pa.array(np.zeros(n, dtype=np.int64)), none, none, pa.array([[]] * n, type=pa.list_(pa.string()))],
                names=["doc_id", "text_hash", "n_words", "n_hit", "span_start", "span_end", "items"])


def _merged(batches):
    """Union of the spans and items that several blocks of phrases found for a document."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            n = r["n_words"]
            starts = np.array([x for part in r["found"] for x in part["span_start"]], dtype=np.int64)
            ends = np.array([x for part in r["found"] for x in part["span_end"]], dtype=np.int64)
            hit = covered(n, starts, ends - starts)
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            rows.append({"doc_id": r["doc_id"], "text_hash": r["text_hash"], "n_words": n, "n_hit": int(hit.sum()),
                         "span_start": np.flatnonzero(edge > 0).tolist(), "span_end": np.flatnonzero(edge < 0).tolist(),
                         "items": sorted({x for part in r["found"] for x in part["items"]}), "copies": r["copies"]})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
            ("span_start", pa.list_(pa.int32())), ("span_end", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
            ("copies", pa.int64())]))


def removal_spans(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, hit words, merged word spans [start, end), items with occurring windows."""
    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = named.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // block_bytes))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash(F.col("text")).alias("text_hash"))
    found = []
    for i in range(blocks):
        part = named if blocks == 1 else named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        phrases = Phrases([(r["item_id"] or "", r["text"]) for r in part.collect()])  # one block, of bounded size
        found.append(texts.mapInArrow(_search(phrases) if phrases.shortest else _nothing, SPANS))
    if blocks == 1:
        return found[0]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    merged = (every.groupBy("doc_id", "text_hash")
              .agg(F.first("n_words").alias("n_words"),
                   F.collect_set(F.struct("span_start", "span_end", "items")).alias("found"), F.count(F.lit(1)).alias("copies"))
              .withColumn("copies", F.expr(f"copies div {blocks}")))
    # equal rows met in one group: give each its own row again
    return (merged.mapInArrow(_merged, SPANS + ", copies long")
            .select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "col"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The verdict on each document (see the contract of op9)."""
    spans = removal_spans(docs, benchmark)
    return spans.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    size = benchmark.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    if size <= BLOCK_BYTES:
        phrases = Phrases([(str(r["item_id"]), r["text"] or "") for r in benchmark.select("item_id", "text").collect()])
        return docs.mapInArrow(_filter(phrases), docs.schema)
    spark = docs.sparkSession
    bad = stage(spark, removal_spans(docs, benchmark)
                .where((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))
                .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (text_hash(docs["text"]) == bad["_hash"]), "left_anti")


def _filter(phrases: Phrases):
    def run(batches):
        for batch in batches:
            if not batch.num_rows or not phrases.shortest:
                yield batch
                continue
            hit, off, _ = _shard(batch, phrases)
            ones = np.concatenate([[0], np.cumsum(hit)])
            n_hit, n = ones[off[1:]] - ones[off[:-1]], np.diff(off)
            yield batch.filter(pa.array(~((n_hit > 0) & (ONE_IN * n_hit >= n))))
    return run
