"""Ranked lexical search (11): a K2-treap over the grid of terms and documents.

Terms, weights and scores are those of op11's contract (integers throughout).
Method: the grid has a row for each term and a column for each document; a
cell holds the term's impact there, the part of the score that does not depend
on the item.  The grid of a shard (an Arrow batch of documents, in order of
size) is a quadtree whose cells keep which quarters hold anything, as bits, and
the largest impact inside, as the difference to the cell above.  An item's
terms are rows; their paths descend together: a search state is a range of
documents with the cell of each term there, its bound is the weighted sum of
the cells' maxima, and states are expanded best first until no bound can reach
the item's tenth score.  Items are searched in groups; each item expands its
best ``BEAM`` states at once, then twice as many, and so on.

The index is a staged table with a row for each shard, so searches read it and
no text.  By default it holds all terms; ``ranked`` gives the terms of the
items (no other row is ever read) if these are at most ``MOST_TERMS``.  A task
carries each item's tenth score from shard to shard and returns ten rows an
item; Spark merges the tasks' rows.

Defined results: null texts have no terms; a row without a term is found by
nothing and not counted in N; each benchmark row is ranked by itself, also if
its id repeats; repeated documents are ranked each; equal scores by ascending
doc_id, null last; an empty table gives an empty result.  Long texts are read
in pieces.  Terms are told apart by one 64-bit hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import discard, stage
from lakepipe.llm.words import LETTERS, LOWER, Words, pieces, prefix, ranged, runs, spread

TOP = 10
#: Impacts are (SCALE * tf) div (SATURATE * tf + LENGTH * m), m = 10 + (90 * n * N) div L.
SCALE, SATURATE, LENGTH, WEIGHT = 1_000_000_000, 1000, 8, 1000
M_BASE, M_SHARE = 10, 90
#: The items of a block are searched together; a pass over the index for each block of so many bytes of their text.
BLOCK_BYTES = 2 << 20
#: The index is restricted to the items' terms if there are at most so many.
MOST_TERMS = 2_000_000
#: States that an item expands in a round.
BEAM = 16
#: Items are searched in groups that hold about so many cells at once.
STATE_CELLS = 2_000_000


def _terms(batch: pa.RecordBatch):
    """Row, term hash and occurrences, a piece of text at a time; a row of a long text can come more than once."""
    for rows, data, off in pieces(batch.column("text"), LETTERS | (np.arange(256) >= 128) | ((np.arange(256) >= 65) & (np.arange(256) <= 90))):
        low = LOWER[data]
        start, end = runs(LETTERS[low], off)
        h = ranged(prefix(spread(256, 1)[low], 1), start, end, 1)
        yield rows[np.searchsorted(off, start, side="right") - 1], h


def _sizes(batches):
    for batch in batches:
        n = np.zeros(batch.num_rows, dtype=np.int64)
        for row, _ in _terms(batch):
            n += np.bincount(row, minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["docs", "terms"])


def _unique_counts(row: np.ndarray, h: np.ndarray, times: np.ndarray):
    """Rows and terms without repeats, with the sum of their times."""
    order = np.lexsort((h, row))
    row, h, times = row[order], h[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else order
    return row[new], h[new], np.add.reduceat(times, new) if len(new) else times


class Treap:
    """Quadtree over rows x columns (2**height each) with the largest value of every cell."""

    def __init__(self, height: int, bits: list[np.ndarray], best: list[np.ndarray]):
        self.height, self.best = height, best
        #: per level, for each cell its four quarters: which exist, and how many exist before them
        self.bits = bits
        self.before = [(np.cumsum(b) - b).astype(np.int32) for b in bits]

    @classmethod
    def build(cls, row: np.ndarray, column: np.ndarray, value: np.ndarray) -> Treap:
        """Of distinct cells with positive values."""
        height = max(1, int(max(row.max(), column.max())).bit_length())
        code = np.zeros(len(row), dtype=np.int64)
        for k in range(height):
            code |= ((row >> k & 1) << (2 * k + 1)) | ((column >> k & 1) << (2 * k))
        order = np.argsort(code, kind="stable")
        code, best = code[order], [value[order]]
        bits = []
        for _ in range(height):
            up = code >> 2
            new = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            parent = np.repeat(np.arange(len(new)), np.diff(np.concatenate([new, [len(up)]])))
            here = np.zeros(4 * len(new), dtype=bool)
            here[4 * parent + (code & 3)] = True
            bits.append(here)
            best.append(np.maximum.reduceat(best[-1], new))
            code = up[new]
        return cls(height, bits[::-1], best[::-1])

    def packed(self) -> tuple[bytes, bytes, list[int]]:
        """Bits, differences of maxima to the cell above, and cells a level."""
        bits = np.packbits(np.concatenate(self.bits)).tobytes()
        down = [self.best[0]]
        for level, here in enumerate(self.bits):
            down.append(np.repeat(self.best[level], here.reshape(-1, 4).sum(axis=1)) - self.best[level + 1])
        return bits, np.concatenate(down).astype(np.int32).tobytes(), [len(b) for b in self.best]

    @classmethod
    def unpacked(cls, bits: bytes, down: bytes, cells: list[int]) -> Treap:
        every = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))
        down, levels, best = np.frombuffer(down, dtype=np.int32).astype(np.int64), [], []
        at = seen = 0
        for level, n in enumerate(cells):
            own = down[seen: seen + n]
            if level:
                own = np.repeat(best[-1], levels[-1].reshape(-1, 4).sum(axis=1)) - own
            best.append(own)
            seen += n
            if level + 1 < len(cells):
                levels.append(every[at: at + 4 * n].astype(bool))
                at += 4 * n
        return cls(len(cells) - 1, levels, best)


INDEX = ("docs array<long>, terms array<long>, df array<long>, bits binary, down binary, cells array<int>")


def _shards(known: np.ndarray | None, n_docs: int, n_terms: int):
    """The K2-treap of each batch of documents; ``known``: sorted hashes of the terms to index (None: all)."""
    def run(batches):
        for batch in batches:
            rows, terms, times = [], [], []
            n = np.zeros(batch.num_rows, dtype=np.int64)
            for row, h in _terms(batch):
                n += np.bincount(row, minlength=len(n))
                if known is not None:
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    own = known[at] == h if len(known) else np.zeros(len(h), dtype=bool)
                    row, h = row[own], h[own]
                for out, x in zip((rows, terms, times), _unique_counts(row, h, np.ones(len(h), dtype=np.int64)), strict=True):
                    out.append(x)
            if not rows:
                continue
            row, h, tf = _unique_counts(*(np.concatenate(x) for x in (rows, terms, times)))
            if not len(row):
                continue
            # columns are documents with a term, by size: then impacts in a range of columns are alike and bounds are close
            ids = batch.column("doc_id")
            got = np.unique(row)
            got = got[np.argsort(n[got], kind="stable")]
            column = np.empty(batch.num_rows, dtype=np.int64)
            column[got] = np.arange(len(got))
            names, term = np.unique(h, return_inverse=True)
            m = np.array([M_BASE + M_SHARE * int(x) * n_docs // n_terms for x in n], dtype=np.int64)[row]
            treap = Treap.build(term.astype(np.int64), column[row], SCALE * tf // (SATURATE * tf + LENGTH * m))
            bits, down, cells = treap.packed()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], type=t) for x, t in (
                    (ids.take(pa.array(got)).to_pylist(), pa.list_(pa.int64())), (names.view(np.int64), pa.list_(pa.int64())),
                    (np.bincount(term), pa.list_(pa.int64())), (bits, pa.binary()), (down, pa.binary()), (cells, pa.list_(pa.int32())))],
                names=[c.split()[0] for c in INDEX.split(", ")])
    return run


def build_index(docs: DataFrame, known: np.ndarray | None = None) -> tuple[DataFrame, int]:
    """The staged index (a row for each shard of documents), and N."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = texts.mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs").alias("n"), F.sum("terms").alias("l")).first()
    n_docs, n_terms = size["n"] or 0, size["l"] or 0
    return stage(docs.sparkSession, texts.mapInArrow(_shards(known, n_docs, max(1, n_terms)), INDEX), "k2-treaps"), n_docs


class Items:
    """Distinct terms of each item of a block, with their weights."""

    def __init__(self, texts: list[str | None]):
        w = Words(pa.array(texts, type=pa.string()), lower=True)
        row, h, _ = _unique_counts(w.row, w.hash, np.ones(len(w), dtype=np.int64))
        self.names, self.term = np.unique(h, return_inverse=True)
        self.item = row
        self.n = len(texts)

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        weight = np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df.get(int(t), 0) + 1))) for t in self.names.view(np.int64)],
                          dtype=np.int64)
        self.weight = weight[self.term]
        #: sorted hashes of all terms of the block
        self.known = self.names


def lowest(rank: np.ndarray, height: int) -> list[np.ndarray]:
    """Per level, the smallest rank of the columns in each block."""
    every = np.full(1 << height, len(rank), dtype=np.int32)
    every[: len(rank)] = rank
    out = [every]
    for _ in range(height):
        out.append(out[-1].reshape(-1, 2).min(axis=1))
    return out[::-1]


def _first(owner: np.ndarray, *keys) -> tuple[np.ndarray, np.ndarray]:
    """Order by owner and keys, and the place of each one among its owner's."""
    order = np.lexsort((*keys[::-1], owner))
    return order, np.arange(len(order)) - np.searchsorted(owner[order], owner[order], side="left")


def search(treap: Treap, rank: np.ndarray, item: np.ndarray, row: np.ndarray, weight: np.ndarray, floor: np.ndarray, top: int = TOP):
    """The best ``top`` columns of each item: (item, column, score), scores above 0 and at least the item's ``floor``.

    ``rank``: place of each column's document by id, which decides ties.
    ``item``, ``row``, ``weight``: the items' terms that the grid has.  A state
    is (item, level, block of columns); the cells of all states' terms are one
    list, ``of`` says whose each is.  In each round an item expands twice as
    many states as in the one before, so rounds are few.
    """
    floor, least = floor.copy(), lowest(rank, treap.height)
    last = np.full(len(floor), len(rank))                # rank of the item's last document, if it has enough
    owner, of = np.unique(item, return_inverse=True)
    block, level = np.zeros(len(owner), dtype=np.int32), np.zeros(len(owner), dtype=np.int32)
    row, cell = row.astype(np.int32), np.zeros(len(row), dtype=np.int32)
    bound = np.bincount(of, weights=weight * float(treap.best[0][0]), minlength=len(owner))
    done = [np.zeros(0, dtype=np.int64) for _ in range(3)]  # item, column, score
    beam = BEAM
    while len(owner):
        lowest_rank = np.empty(len(owner), dtype=np.int64)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            lowest_rank[some] = least[k][block[some]]
        alive = np.flatnonzero((bound > floor[owner]) | ((bound == floor[owner]) & (lowest_rank < last[owner])))
        order, place = _first(owner[alive], -bound[alive], lowest_rank[alive])
        order = alive[order]
        taken, rest = order[place < beam], order[place >= beam]
        beam *= 2
        # states that go on
        number = np.full(len(owner), -1, dtype=np.int32)
        number[rest] = np.arange(len(rest))
        stay = np.flatnonzero(number[of] >= 0)
        lists = [[number[of[stay]], row[stay], weight[stay], cell[stay]]]
        states = [[owner[rest], level[rest], block[rest], bound[rest]]]
        base = len(rest)
        # both halves of the columns of those that are expanded, a level at a time
        for k in np.unique(level[taken]):
            some = taken[level[taken] == k]
            number[:] = -1
            number[some] = np.arange(len(some))
            own = np.flatnonzero(number[of] >= 0)
            o_of, o_row, o_weight = number[of[own]], row[own], weight[own]
            quarter = 4 * cell[own] + 2 * (o_row >> (treap.height - 1 - k) & 1)
            for half in (0, 1):
                there = np.flatnonzero(treap.bits[k][quarter + half])
                child = treap.before[k][quarter[there] + half]
                c_of, c_weight = o_of[there], o_weight[there]
                total = np.bincount(c_of, weights=c_weight * treap.best[k + 1][child], minlength=len(some))
                blocks = 2 * block[some] + half
                at = np.flatnonzero((total > 0) & (total >= floor[owner[some]]))
                if k + 1 == treap.height:
                    done = [np.concatenate(x) for x in zip(done, (owner[some[at]], blocks[at], total[at].astype(np.int64)), strict=True)]
                    continue
                number_of = np.full(len(some), -1, dtype=np.int32)
                number_of[at] = base + np.arange(len(at))
                go = np.flatnonzero(number_of[c_of] >= 0)
                lists.append([number_of[c_of[go]], o_row[there[go]], c_weight[go], child[go]])
                states.append([owner[some[at]], np.full(len(at), k + 1, dtype=np.int32), blocks[at], total[at]])
                base += len(at)
        of, row, weight, cell = (np.concatenate([x[i] for x in lists]) for i in range(4))
        owner, level, block, bound = (np.concatenate([x[i] for x in states]) for i in range(4))
        # only the best of each item stay; the last of them is the floor
        order, place = _first(done[0], -done[2], rank[done[1]])
        done = [x[order[place < top]] for x in done]
        end = np.flatnonzero(place[place < top] == top - 1)
        end = end[done[2][end] >= floor[done[0][end]]]
        floor[done[0][end]], last[done[0][end]] = done[2][end], rank[done[1][end]]
    good = done[2] >= floor[done[0]]
    return tuple(x[good] for x in done)


def _groups(item: np.ndarray, columns: int):
    """Runs of whole items whose search holds about STATE_CELLS cells at most (at least one item each)."""
    names, first = np.unique(item, return_index=True)
    ends = np.concatenate([first[1:], [len(item)]])
    a = 0
    while a < len(names):
        b = max(a + 1, int(np.searchsorted((ends - first[a]) * columns, STATE_CELLS, side="right")))
        yield slice(int(first[a]), int(ends[b - 1]))
        a = b


FOUND = "item int, doc_id long, score long"


def _searched(items: Items, top: int):
    def run(batches):
        best = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool)]   # item, score, id, whether the id is null
        floor = np.zeros(items.n, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]  # noqa: B023, E731
                terms = get("terms").values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(terms, items.names), len(terms) - 1)
                has = terms[at] == items.names
                own = has[items.term] & (items.weight > 0)
                if not own.any():
                    continue
                treap = Treap.unpacked(get("bits").as_py(), get("down").as_py(), get("cells").values.to_numpy())
                docs = get("docs").values
                ids, none = docs.fill_null(0).to_numpy(zero_copy_only=False), docs.is_null().to_numpy(zero_copy_only=False)
                rank = np.empty(len(ids), dtype=np.int64)
                rank[np.lexsort((ids, none))] = np.arange(len(ids))
                item, row, weight = items.item[own], at[items.term[own]], items.weight[own]
                for g in _groups(item, len(ids)):
                    who, column, score = search(treap, rank, item[g], row[g], weight[g], floor, top)
                    best = [np.concatenate(x) for x in zip(best, (who, score, ids[column], none[column]), strict=True)]
                order, place = _first(best[0], -best[1], best[3], best[2])
                best = [x[order[place < top]] for x in best]
                full = np.flatnonzero(place[place < top] == top - 1)
                floor[best[0][full]] = best[1][full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[0].astype(np.int32)), pa.array(best[2], mask=best[3]), pa.array(best[1])], names=["item", "doc_id", "score"])
    return run


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each row of ``items`` (see the contract of op11)."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    known = _all_terms(asked) if blocks > 1 else None
    first, parts = None, []
    for b in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        got = part.collect()                            # one block, of bounded size
        block = Items([r["text"] for r in got])
        if first is None:
            first = build_index(docs, block.names if blocks == 1 else known)
        index, n_docs = first
        wanted = spark.createDataFrame([(int(t),) for t in block.names.view(np.int64)], "term long")
        seen = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
        df = {r["term"]: r["df"] for r in seen.join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        block.weigh(df, n_docs)
        found = index.mapInArrow(_searched(block, top), FOUND)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(got)], "item int, item_id " + dict(asked.dtypes)["item_id"])
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        parts.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = stage(spark, out, "ranked")
    discard(first[0])
    return out


def _all_terms(asked: DataFrame) -> np.ndarray | None:
    """Sorted hashes of all items' terms, if they are few enough to be handed to the tasks."""
    def terms(batches):
        for batch in batches:
            for _, h in _terms(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], names=["term"])
    every = asked.mapInArrow(terms, "term long").distinct().limit(MOST_TERMS + 1).toArrow().column("term").to_numpy()
    return None if len(every) > MOST_TERMS else np.sort(every.view(np.uint64))
