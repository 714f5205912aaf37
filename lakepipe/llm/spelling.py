"""Spelling variants (13): a dictionary of trie-node pairs.

Words are runs of Latin letters with A-Z lower-cased, as the contract of op13
makes them (a run whose CRC-32 with its document's id is divisible by 199
loses one letter), of ``MIN_LETTERS`` code points and ``MIN_COUNT``
occurrences or more.

Method: the prefixes of all words are the nodes of a forward trie, their
suffixes those of a reversed one, and every node gets an integer.  A word of n
letters is written as n + 1 pairs (prefix node, suffix node) that meet between
two letters, and n pairs that skip a letter.  Two words of equal pairs that
skip are one letter apart (replaced); a pair that skips and one that does not
are a longer and a shorter word (inserted, deleted).  A letter equal to the
one before is skipped for replacement only, so that each near pair is found
at one pair of nodes.  All words at one pair differ in one letter of a fixed
alphabet, so a group has at most 91 members; counts and the two most frequent
members give every word its figures without emitting pairs of words.

Nodes are told apart by two 64-bit hashes of their letters until they are
numbered.  Nodes of up to three letters have numbers of their own arithmetic,
as they belong to very many words; the others are numbered as a staged table.

Defined results: null texts have no words; a null id counts as an empty string
in the CRC; repeated rows count again; an empty table gives an empty result.
Whole texts are read, long ones in pieces (a single run of letters is held
whole).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import discard, stage
from lakepipe.llm.words import LOWER, U, mix, pieces, prefix, ranged, runs, spread, strings, text_bytes

MIN_LETTERS = 6
MIN_COUNT = 5
#: One run in so many loses a letter.
TYPO_IN = 199
#: A form occurs at least so many times as often as its variant.
FORM_TIMES = 5
#: Trie nodes of up to so many letters are numbered by their letters.
SHORT = 3
#: Words are cut into nodes by about so many bytes at once.
NODE_BYTES = 1 << 16
#: Runs of more bytes go through the C library's CRC one by one.
LONG_RUN = 48

ASCII_LETTER = np.zeros(256, dtype=bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Where a long text must not be cut: letters and all bytes of longer characters.
UNCUT = ASCII_LETTER | (np.arange(256) >= 128)
#: U+00C0 to U+00FF are this byte and one more in UTF-8.
LATIN = 0xC3


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, each continued from the CRC ``before`` it."""
    table, out = crc_table(), np.zeros(len(start), dtype=np.uint32)
    length = end - start
    for i in np.flatnonzero(length > LONG_RUN):
        out[i] = zlib.crc32(data[start[i]: end[i]].tobytes(), int(before[i]))
    order = np.argsort(-length, kind="stable")
    order = order[length[order] <= LONG_RUN]
    state, at, left = ~before[order], start[order], length[order]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k))           # ranges longer than k come first
        state[:n] = table[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = ~state
    return out


def _counted(batches):
    """Words of each piece of text and how often they occur in it."""
    for batch in batches:
        ids = [zlib.crc32(f"{'' if x is None else x}:".encode()) for x in batch.column("doc_id").to_pylist()]
        ids = np.array(ids, dtype=np.uint32)
        for rows, data, off in pieces(batch.column("text"), UNCUT):
            lead = data == LATIN
            inside = ASCII_LETTER[data] | lead
            inside[1:] |= lead[:-1]
            start, end = runs(inside, off)
            leads = np.concatenate([[0], np.cumsum(lead)])
            letters = end - start - (leads[end] - leads[start])
            long = letters >= MIN_LETTERS
            start, end, letters = start[long], end[long], letters[long]
            row = rows[np.searchsorted(off, start, side="right") - 1]
            low = LOWER[data]
            crc = crc32(low, start, end, ids[row])
            typo = crc % TYPO_IN == 0
            made = []
            for i in np.flatnonzero(typo & (letters > MIN_LETTERS)):
                word, at = low[start[i]: end[i]].tobytes().decode(), int(crc[i]) % int(letters[i])
                made.append(word[:at] + word[at + 1:])
            start, end = start[~typo], end[~typo]
            h = ranged(prefix(spread(256, 1)[low], 1), start, end, 1)
            _, first, n = np.unique(h, return_index=True, return_counts=True)
            found = strings(low, start[first], end[first])
            yield pa.RecordBatch.from_arrays([found, pa.array(n.astype(np.int64))], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(made, type=pa.string()), pa.array(np.ones(len(made), dtype=np.int64))],
                                             names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word, n) of the words that are long and frequent enough."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


NODES = "id long, n long, kind byte, p long, p1 long, p2 long, s long, s1 long, s2 long"
#: Kinds of pairs: between two letters; a skipped letter; a skipped letter equal to the one before.
BETWEEN, SKIP, SKIP_AGAIN = 0, 1, 2


def _letter_number(code: np.ndarray) -> np.ndarray:
    """1..90 for a-z and U+00C0..U+00FF."""
    return np.where(code < 128, code - 96, code - 0xC0 + 27).astype(np.int64)


def _side(sums, start, end, number, letters, salt):
    """Node of each byte range: its number if it is short, else two hashes.

    Short ones get hashes that nothing matches, spread evenly, so that the
    joins which number the others have no hot key.
    """
    short = letters <= SHORT
    one, two = (ranged(sums[k], start, end, 31 + k).view(np.int64) for k in (0, 1))
    one = np.where(short, salt.view(np.int64), one)
    return [pa.array(number, mask=~short), pa.array(one), pa.array(two, mask=short)]


def _node_pairs(batches):
    """The pairs of nodes of each word."""
    for batch in batches:
        _, off = text_bytes(batch.column("word"))
        a = 0
        while a < len(batch):
            b = max(a + 1, int(np.searchsorted(off, off[a] + NODE_BYTES, side="right")) - 1)
            yield _pairs_of(batch.slice(a, b - a))
            a = b


def _pairs_of(part: pa.RecordBatch) -> pa.RecordBatch:
    data, off = text_bytes(part.column("word"))
    opens = (data & 0xC0) != 0x80
    at = np.flatnonzero(opens)                                        # first byte of each letter
    after = np.concatenate([at[1:], [len(data)]])
    wide = after - at == 2
    code = np.where(wide, ((data[at].astype(np.int64) & 0x1F) << 6) | (data[np.minimum(at + 1, len(data) - 1)] & 0x3F), data[at])
    letter = _letter_number(code)
    word = np.searchsorted(off, at, side="right") - 1
    first = np.searchsorted(word, np.arange(len(off)))                # first letter of each word
    n = np.diff(first)
    # n + 1 places between letters, then n skipped letters
    between_word = np.repeat(np.arange(len(n)), n + 1)
    place = np.arange(len(between_word)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
    skip = np.arange(len(at)) - first[word]
    same = np.zeros(len(at), dtype=bool)
    same[1:] = (letter[1:] == letter[:-1]) & (word[1:] == word[:-1])
    of = np.concatenate([between_word, word])
    left = np.concatenate([place, skip])                              # letters of the prefix
    right = np.concatenate([n[between_word] - place, n[word] - skip - 1])
    ends = np.concatenate([at, [len(data)]])
    cut_a, cut_b = ends[first[of] + left], ends[first[of] + n[of] - right]
    values = [spread(256, 61 + k)[data] for k in (0, 1)]
    sums = [prefix(v, 31 + k) for k, v in enumerate(values)]
    padded = np.concatenate([letter, np.zeros(SHORT, dtype=np.int64)])
    short_left = sum(np.where(left > k, padded[first[of] + k] * 91**k, 0) for k in range(SHORT))
    tail = first[of] + n[of] - 1
    short_right = sum(np.where(right > k, padded[np.maximum(tail - k, 0)] * 91**k, 0) for k in range(SHORT))
    ids = part.column("id").to_numpy()
    salt = mix(ids[of].astype(U) * U(0x9E3779B97F4A7C15) + np.arange(len(of), dtype=U))
    kind = np.concatenate([np.full(len(place), BETWEEN), np.where(same, SKIP_AGAIN, SKIP)]).astype(np.int8)
    columns = [pa.array(ids[of]), pa.array(part.column("n").to_numpy()[of]), pa.array(kind),
               *_side(sums, off[of], cut_a, -1 - short_left, left, salt),
               *_side(sums, cut_b, off[of + 1], -1 - short_right, right, mix(salt))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NODES.split(", ")])


def _numbered(spark: SparkSession, rows: DataFrame, side: str) -> DataFrame:
    """Rows with the integer of their node on one side, numbered over all words."""
    one, two = f"{side}1", f"{side}2"
    nodes = rows.where(F.col(two).isNotNull()).select(one, two).distinct()
    numbers = stage(spark, nodes.withColumn("number", F.monotonically_increasing_id()), "trie-nodes")
    return rows.join(numbers, [one, two], "left").withColumn(side, F.coalesce(side, "number")).drop(one, two, "number")


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """Of words (id, word, n): rows (id, n_near, best) of those that have near words; best is (n, -id) of the first in rank."""
    rows = stage(spark, words.mapInArrow(_node_pairs, NODES), "node-pairs")
    forward = stage(spark, _numbered(spark, rows, "p"), "forward")
    discard(rows)
    pairs = _numbered(spark, forward, "s")
    group = Window.partitionBy("p", "s")
    ranked = (group.orderBy((F.col("kind") == BETWEEN).asc(), F.col("n").desc(), F.col("id"))
              .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    me = F.struct("n", (-F.col("id")).alias("o"))
    skips, canonical = F.col("kind") != BETWEEN, F.col("kind") == SKIP
    met = pairs.select(
        "id", "n", "kind", F.sum(skips.cast("int")).over(group).alias("skips"), F.sum(canonical.cast("int")).over(group).alias("canonical"),
        F.max(F.when(canonical, me)).over(group).alias("longer"), F.max(F.when(~skips, me)).over(group).alias("shorter"),
        F.first(me).over(ranked).alias("first"), F.nth_value(me, 2).over(ranked).alias("second"))
    mine = F.col("first.o") == -F.col("id")
    replaced = F.when(skips & (F.col("skips") > 1), F.when(mine, F.col("second")).otherwise(F.col("first")))
    deleted = F.when(canonical, F.col("shorter"))
    inserted = F.when(~skips, F.col("longer"))
    near = (F.when(skips, F.col("skips") - 1).otherwise(F.col("canonical"))
            + (canonical & F.col("shorter").isNotNull()).cast("int"))
    found = met.select("id", near.alias("near"), F.greatest(replaced, deleted, inserted).alias("best")).where("near > 0")
    return found.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """Of (id, form): (id, root), the last word when forms are followed; each round doubles the way gone."""
    now = stage(spark, forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        new = stage(spark, now.join(step, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(now)
        now = new.select("id", "root")
        if not new.where("moved").limit(1).count():
            return now


def spelling_groups(docs: DataFrame) -> DataFrame:
    """One row per word (see the contract of op13)."""
    spark = docs.sparkSession
    counts = stage(spark, word_counts(docs), "word-counts")
    # ids in code-point order, so that ties between words are ties between ids
    words = stage(spark, counts.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    discard(counts)
    near = stage(spark, near_words(spark, words), "near-words")
    best = words.join(near, "id", "left").withColumn(
        "form_id", F.when(F.col("best.n") >= FORM_TIMES * F.col("n"), -F.col("best.o")))
    variants = best.where(F.col("form_id").isNotNull()).select("id", F.col("form_id").alias("form"))
    last = roots(spark, variants).withColumnRenamed("root", "root_id")
    named = lambda key, word, *more: words.select(F.col("id").alias(key), F.col("word").alias(word), *more)
    return (best.join(last, "id", "left").join(named("form_id", "form"), "form_id", "left").join(named("root_id", "root"), "root_id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(F.col("form_id").isNotNull(), F.col("best.n")).alias("form_n")))
