"""Quality rules (7): characters inside repeated n-grams and lines.

Method: rolling hashes of several n-gram lengths in numpy.  Each text is
judged alone and whole, in one pass over the scan, without a shuffle.

Defined results: a null text is an empty one and has no words, so it fails
the base rule; ids, repeated rows and further columns have no effect on a
row's verdict; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm.words import Words, covered, prefix, ranged, repeated, row_salt, slices, spread, text_bytes

#: Largest share of a text's word characters that may lie in n-grams occurring twice or more.
COVER_LIMITS = {5: 0.45, 6: 0.40, 8: 0.35, 10: 0.30}
#: Largest share of a text's line characters in lines equal to an earlier one.
LINE_LIMIT = 0.30
MIN_WORDS, BASE_GRAM, BASE_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_share double, "
          + ", ".join(f"cover_{n} double" for n in COVER_LIMITS))


def _lines(column, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: lines with a word that equal an earlier line, their characters, the characters of all lines with a word."""
    data, off = text_bytes(column)
    n = len(off) - 1
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([off[:-1], breaks + 1]))
    row = np.searchsorted(off, start, side="right") - 1
    # a line break that ends a text opens an empty last line of that text, not a line of the next text
    keep = (start < off[-1]) & (row < n)
    start, row = np.unique(start[keep]), None
    row = np.searchsorted(off, start, side="right") - 1
    stop = np.concatenate([start[1:], off[-1:]])
    end = np.minimum(stop, off[row + 1])
    end = end - ((end > start) & (data[np.maximum(end - 1, 0)] == 10))
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[has_word], end[has_word], row[has_word]
    h = ranged(prefix(spread(256, 5)[data], 5), start, end, 5) ^ row_salt(row)
    order = np.argsort(h, kind="stable")
    again = np.zeros(len(h), dtype=bool)
    again[order[1:]] = h[order[1:]] == h[order[:-1]]
    chars = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    size = chars[end] - chars[start]
    count = lambda weights: np.bincount(row, weights=weights, minlength=n).astype(np.int64)
    return count(again.astype(float)), count(size * again), count(size.astype(float))


def measure(column) -> dict[str, np.ndarray]:
    """The measures and verdicts of a slice of texts."""
    w = Words(column)
    chars = np.zeros(len(w.data) + 1, dtype=np.int64)
    np.cumsum((w.data & 0xC0) != 0x80, out=chars[1:])
    size = chars[w.end] - chars[w.start]
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    symbols = np.zeros(len(w.data) + 1, dtype=np.int64)
    np.cumsum(symbol[w.data], out=symbols[1:])
    out = {"n_words": w.count.astype(np.int64), "word_chars": w.by_row(size),
           "n_symbols": symbols[w.row_bytes[1:]] - symbols[w.row_bytes[:-1]]}
    dup, dup_chars, line_chars = _lines(column, w)
    out["n_dup_lines"] = dup
    at = None
    for n in sorted({*COVER_LIMITS, BASE_GRAM}):
        # a repeated longer n-gram starts with a repeated shorter one
        start, h = w.windows(n, at)
        at = start[repeated(h ^ row_salt(w.row[start]))] if len(start) else start
        inside = covered(len(w), at, n)
        if n == BASE_GRAM:
            out["n_repeat_words"] = w.by_row(inside)
        if n in COVER_LIMITS:
            out[f"cover_{n}"] = w.by_row(size * inside) / np.maximum(out["word_chars"], 1)
    out["dup_line_share"] = dup_chars / np.maximum(line_chars, 1)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_PERCENT * out["n_words"])
    bad = out["dup_line_share"] > LINE_LIMIT
    for n, limit in COVER_LIMITS.items():
        bad |= out[f"cover_{n}"] > limit
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def _measured(batches):
    for batch in batches:
        for part in slices(batch):
            got = measure(part.column("text"))
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                     "dup_line_share", *[f"cover_{n}" for n in COVER_LIMITS]]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(got[k]) for k in names]],
                                             names=["doc_id", *names])


def _kept_rows(batches):
    for batch in batches:
        for part in slices(batch):
            yield part.filter(pa.array(measure(part.column("text"))["kept"]))


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its measures and verdict."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measured, SCHEMA)


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.mapInArrow(_kept_rows, docs.schema)
