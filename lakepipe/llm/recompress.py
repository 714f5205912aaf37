"""Substring dedup (6): recompression finds the words of repeated 35-word windows.

Method: every text is parsed by the same rounds.  The first names runs of
equal words; each further round splits the symbols in two halves by a hash of
the name, and names every pair (left half, right half).  A name is a hash of
what it stands for, so equal substrings get equal interior symbols in every
document and on every executor, without an exchange of naming tables.

For every symbol the parse keeps the range of words that decided it.  A window
that holds this range has that symbol at that place wherever the window
occurs.  Each window takes the highest symbol it decides (the last of these,
if several), so equal windows take the same one, and no repeat is missed.
(A window inside a run of one word decides no symbol and stands for itself.)

Symbols met twice or more reveal candidates.  They are verified by two
independent 64-bit hashes: first whole stretches of windows that took one
symbol, as most repeats are longer than a window; then, one by one, the
windows of the stretches that were not met again as a whole, against each
other and against one occurrence of each verified stretch of their symbols.

Spark shuffles symbols, stretches, windows and the ranges to remove, by
aggregates with map-side partial results and joins that AQE can split.  No
group is ever gathered and no pairs of occurrences are made.

Defined results: null texts have no words; texts under 35 words keep all;
windows of repeated rows count once for each row; ids may be null or repeated
(a row is found again by id and text); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm.frames import KEY, attach, discard, stage, text_hash
from lakepipe.llm.words import U, Words, covered, mix, prefix, ranged, slices, spread

WINDOW = 35
#: Rounds of pair naming; more only make fewer, longer symbols.
PAIR_ROUNDS = 7


class Level:
    """Symbols of a slice: name, row, and the words [lo, hi) that decided them."""

    def __init__(self, name, row, lo, hi):
        self.name, self.row, self.lo, self.hi = name, row, lo, hi


def _neighbours(level: Level, words: Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the deciding range starts (ends) if the symbol before ``first`` (after ``last``) matters too.

    At a text's edge that is beyond the text, so that no window holds it.
    """
    n = len(level.name)
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    lo = np.where((first > 0) & (level.row[before] == level.row[first]), level.lo[before], words.off[level.row[first]] - 1)
    hi = np.where((last + 1 < n) & (level.row[after] == level.row[last]), level.hi[after], words.off[level.row[last] + 1] + 1)
    return lo, hi


def _runs(level: Level, words: Words) -> Level:
    """Name each run of equal symbols by the symbol and the run's length."""
    n = len(level.name)
    first = np.flatnonzero(np.concatenate([[True], (level.name[1:] != level.name[:-1]) | (level.row[1:] != level.row[:-1])]))
    last = np.concatenate([first[1:], [n]]) - 1
    lo, hi = _neighbours(level, words, first, last)
    return Level(mix(level.name[first] + (last - first).astype(U) * U(0xA24BAED4963EE407)), level.row[first], lo, hi)


def _pairs(level: Level, words: Words, number: int) -> Level:
    """Name each pair of a left-half symbol and the right-half symbol after it."""
    n = len(level.name)
    left = (mix(level.name ^ spread(number, 31)[-1]) >> U(63)) == 0
    joins = np.zeros(n, dtype=bool)
    joins[:-1] = left[:-1] & ~left[1:] & (level.row[:-1] == level.row[1:])
    stays = np.ones(n, dtype=bool)
    stays[1:] = ~joins[:-1]
    at = np.flatnonzero(stays)
    pair, is_left = joins[at], left[at]
    second = np.minimum(at + 1, n - 1)
    name = np.where(pair, mix(mix(level.name[at]) + level.name[second] * U(0xD6E8FEB86659FD93)), level.name[at])
    lo, hi = _neighbours(level, words, at, at)
    # a lone left-half symbol was decided by the next one too, a lone right-half one by the one before
    return Level(name, level.row[at], np.where(pair | is_left, level.lo[at], lo),
                 np.where(pair, level.hi[second], np.where(is_left, hi, level.hi[at])))


def parse(words: Words, rounds: int = PAIR_ROUNDS) -> list[Level]:
    at = np.arange(len(words))
    level = _runs(Level(words.hash, words.row, at, at + 1), words)
    levels = [level]
    for number in range(1, rounds + 1):
        level = _pairs(level, words, number)
        levels.append(level)
    return levels


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The symbol each window takes, for each stretch of windows that take the same one.

    Names, first windows, numbers of windows, and whether the stretch is the
    symbol's first.
    """
    window, own = words.windows(WINDOW)
    names, first, count, head = [], [], [], []
    left = np.arange(len(window))
    for height, level in reversed(list(enumerate(parse(words) if len(window) else []))):
        if not len(left):
            break
        at = window[left]
        k = np.searchsorted(level.hi, at + WINDOW, side="right") - 1
        has = (k >= 0) & (level.lo[np.maximum(k, 0)] >= at)
        k, at = k[has], at[has]
        left = left[~has]
        if not len(at):
            continue
        new = np.concatenate([[True], k[1:] != k[:-1]])
        cut = np.flatnonzero(new | np.concatenate([[True], at[1:] != at[:-1] + 1]))
        names.append(mix(level.name[k[cut]] ^ spread(height + 1, 32)[-1]))
        first.append(at[cut])
        count.append(np.diff(np.concatenate([cut, [len(at)]])))
        head.append(new[cut])
    names.append(own[left])
    first.append(window[left])
    count.append(np.ones(len(left), dtype=np.int64))
    head.append(np.ones(len(left), dtype=bool))
    return tuple(np.concatenate(x) for x in (names, first, count, head))


def _rows_of(part: pa.RecordBatch, row: np.ndarray) -> list:
    take = pa.array(row)
    return [part.column("doc_id").take(take), part.column("text_hash").take(take)]


def _anchors(batches):
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"))
            name, first, count, head = anchors(w)
            row = w.row[first] if len(first) else first
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), *_rows_of(part, row), pa.array((first - w.off[row]).astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array(head)],
                names=["symbol", *KEY, "first", "windows", "head"])


def _places(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of windows of each stretch in a row's list of structs."""
    lists = part.column("stretches")
    lengths = np.diff(lists.offsets.to_numpy())
    if lists.null_count:
        lengths = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    row = np.repeat(np.arange(len(lists)), lengths)
    every = lists.flatten()
    return row, every.field("first").to_numpy() + words.off[row], every.field("windows").to_numpy()


def _both_hashes(words: Words, start: np.ndarray, end: np.ndarray) -> list[pa.Array]:
    return [pa.array(ranged(prefix(h, 11 + i), start, end, 11 + i).view(np.int64)) for i, h in enumerate(words.hashes)]


def _whole(batches):
    """The hashes of each candidate stretch."""
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), seeds=(1, 2))
            row, first, size = _places(part, w)
            lists = part.column("stretches").flatten()
            yield pa.RecordBatch.from_arrays(
                [*_both_hashes(w, first, first + size + WINDOW - 1), lists.field("symbol"), *_rows_of(part, row),
                 lists.field("first"), lists.field("windows")], names=["one", "two", "symbol", *KEY, "first", "windows"])


def _windows(batches):
    """The hashes of each window of a stretch."""
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), seeds=(1, 2))
            row, first, size = _places(part, w)
            k = np.repeat(np.arange(len(row)), size)
            at = first[k] + np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
            of = w.row[at]
            yield pa.RecordBatch.from_arrays(
                [*_both_hashes(w, at, at + WINDOW), *_rows_of(part, of), pa.array((at - w.off[of]).astype(np.int32)),
                 part.column("stretches").flatten().field("whole").take(pa.array(k))],
                names=["one", "two", *KEY, "at", "whole"])


def _ranges(part: pa.RecordBatch, words: Words, start: str, size: str) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges (first, length) held as two list columns of each row."""
    lists = part.column(start)
    lengths = np.diff(lists.offsets.to_numpy())
    if lists.null_count:
        lengths = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    row = np.repeat(np.arange(len(lists)), lengths)
    return lists.flatten().to_numpy() + words.off[row], part.column(size).flatten().to_numpy()


def _merged(batches):
    """Each row's stretches of windows as few, sorted ones that do not touch."""
    for batch in batches:
        starts, sizes = [], []
        for i in range(batch.num_rows):
            held = batch.column("stretches")[i].values
            first = held.field("first").to_numpy()
            end = first + held.field("windows").to_numpy()
            order = np.argsort(first, kind="stable")
            first, reach = first[order], np.maximum.accumulate(end[order])
            cut = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
            starts.append(first[cut])
            sizes.append(reach[np.concatenate([cut[1:] - 1, [len(first) - 1]])] - first[cut])
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in KEY], pa.array(starts, type=kind), pa.array(sizes, type=kind)],
                                         names=[*KEY, "first", "windows"])


def removed_words(part: pa.RecordBatch, words: Words) -> np.ndarray:
    first, size = _ranges(part, words, "first", "windows")
    return covered(len(words), first, size + WINDOW - 1)


def kept_bytes(words: Words, kept: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of all rows, each with a space after it but for some at a text's end; and the rows' offsets."""
    data = words.data.copy()
    stop = words.row_bytes[words.row + 1]
    end = words.end + (words.end < stop)
    data[end[words.end < stop] - 1] = 0x20
    mask = covered(len(data), words.start[kept], (end - words.start)[kept])
    at = np.concatenate([[0], np.cumsum(mask)])
    return data[mask].tobytes(), at[words.row_bytes]


def _results(batches):
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), seeds=())
            gone = removed_words(part, w)
            text, off = kept_bytes(w, ~gone)
            sha = [hashlib.sha256(text[a:b].rstrip(b" ")).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(w.count.astype(np.int64)), pa.array(w.by_row(gone)), pa.array(sha, type=pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _texts(batches):
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), seeds=())
            gone = removed_words(part, w)
            text, off = kept_bytes(w, ~gone)
            kept = [text[a:b].rstrip(b" ").decode() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(kept, type=pa.string())],
                                             names=[*KEY, "text"])


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """Per document with any: stretches (first window, number of windows) of windows that also start elsewhere.

    ``docs`` has doc_id, text and text_hash.
    """
    spark = docs.sparkSession
    found = stage(spark, docs.mapInArrow(
        _anchors, "symbol long, doc_id long, text_hash long, first int, windows int, head boolean"), "symbols")
    shared = found.where("head").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("symbol")
    # sets: rows equal in id and text give the same stretches
    listed = lambda df, *columns: df.groupBy(*KEY).agg(F.collect_set(F.struct(*columns)).alias("stretches"))
    candidates = stage(spark, listed(found.join(shared, "symbol"), "symbol", "first", "windows"), "candidates")
    discard(found)

    # whole stretches, and of those met again one occurrence
    whole = stage(spark, attach(docs, candidates, "inner").mapInArrow(
        _whole, "one long, two long, symbol long, doc_id long, text_hash long, first int, windows int"), "whole")
    discard(candidates)
    own = F.xxhash64(*KEY, "first")
    met = whole.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("pick"))
    known = stage(spark, whole.join(met, ["one", "two"]).select(
        "symbol", *KEY, "first", "windows", (F.col("n") > 1).alias("whole"), (own == F.col("pick")).alias("picked")), "known")
    discard(whole)

    # single windows
    alone = known.where("not whole")
    open_symbols = alone.select("symbol").distinct()
    picked = known.where("whole and picked").join(open_symbols, "symbol", "left_semi")
    places = stage(spark, listed(alone.unionByName(picked.select(known.columns)), "first", "windows", "whole"), "places")
    windows = stage(spark, attach(docs, places, "inner").mapInArrow(
        _windows, "one long, two long, doc_id long, text_hash long, at int, whole boolean"), "windows")
    discard(places)
    again = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two")
    single = windows.where("not whole").join(again, ["one", "two"]).select(*KEY, F.col("at").alias("first"), F.lit(1).alias("windows"))
    every = single.unionByName(known.where("whole").select(*KEY, "first", "windows"))
    out = stage(spark, listed(every, "first", "windows").mapInArrow(
        _merged, "doc_id long, text_hash long, first array<int>, windows array<int>"), "stretches")
    discard(windows, known)
    return out


def _with_stretches(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash(F.col("text")).alias("text_hash"))
    return attach(texts, repeated_stretches(texts))


def repeats_removed(docs: DataFrame) -> DataFrame:
    """One row per document: words, removed words, hash of what is left (see the contract of op6)."""
    return _with_stretches(docs).mapInArrow(_results, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def kept_texts(docs: DataFrame) -> DataFrame:
    """One row per document with the text that is left, words joined by one space."""
    return _with_stretches(docs).mapInArrow(_texts, "doc_id long, text_hash long, text string")
