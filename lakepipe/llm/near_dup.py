"""Near-duplicate documents (2): ProbMinHash, banding, verification.

Shingles are runs of five words (A-Z lower-cased, letters and digits only; a
text of fewer words is one shingle), weighted 1 + ln(occurrences).  Method:
each shingle starts a Poisson process whose rate is its weight; an arrival
falls into one of ``REGISTERS`` registers, which keeps its earliest shingle.
Arrivals are made up to a time by which all registers are very likely filled
and stop there; texts with an empty register go on to twice that time.  Two
texts agree in a register with the probability Jaccard similarity J_P.

Registers are joined to bands; texts that share a band key meet in a bucket.  A
text that repeats shingles has the bands of its plain set (all weights 1) too,
as links by plain Jaccard similarity can have a lower J_P.
Links are verified on the full shingle sets: two texts are linked if J_P, or
the plain Jaccard similarity of the two sets, is 0.8 or more.  Classes are the
connected components of the links.

Copies of one text are one node from the start.  A bucket's members are not
all compared with one another: they are compared with the most central member
(the one that meets most others, in a group of edited copies the original);
then, in buckets whose members are still in different classes, small buckets
in all pairs of different classes, large ones with the most central member of
each of ``LEADERS`` parts.  The texts of large buckets that are still in
different classes are then joined exactly (``open_pairs``): their shingles are
put in one order, rarest first, and a pair meets at the first shingle that both
have, if what either text has from there on can still make a link and the
parities of their shingles do not tell that they are too far apart.

Defined results: null texts are empty; texts without words only join equal
texts; of a class, the row with the smallest id (null last, ties by text hash)
stays, once; repeated rows get one class; an id that several texts carry may
be the id of several classes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import BROADCAST_BYTES, discard, stage, text_hash
from lakepipe.llm.words import U, Words, mix, prefix, ranged, slices, spread

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS_PER_BAND = 36, 7
REGISTERS = BANDS * ROWS_PER_BAND
#: Buckets of up to this many members may be compared in all pairs.
SMALL_BUCKET = 12
#: A signature costs about 150 KB of memory while it is made, however short the text: that many are made at once.
SIGNED_ROWS = 256
LEADERS = 8
#: What rounding may take from a bound.
EPSILON = 1e-9
#: Places of the parity marks that tell how far two texts are apart at least.
MARKS = 512
MARK_COLUMNS = [f"mark{i}" for i in range(MARKS // 64)]
#: A shingle of more texts than this is joined in parts.
PART_ROWS = 2000
#: P(at most k arrivals in a time of 1 at rate 1)
_POISSON = np.cumsum(np.exp(-1) / np.concatenate([[1.0], np.cumprod(np.arange(1, 18, dtype=float))]))


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of occurrences of each distinct shingle of the rows, by row and hash."""
    start, h = words.windows(SHINGLE)
    few = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    row, h = words.row[start], h
    if len(few):
        a, b = words.off[few], words.off[few + 1]
        row = np.concatenate([row, few])
        h = np.concatenate([h, ranged(prefix(words.hash, 11), a, b, 11)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else order
    return row[new], h[new], np.diff(np.concatenate([new, [len(h)]]))


def signatures(n_rows: int, row: np.ndarray, h: np.ndarray, weight: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The shingle in each of ``m`` registers of each row (0 in rows without shingles)."""
    total = np.bincount(row, weights=weight, minlength=n_rows)
    best, won = np.full(n_rows * m, np.inf), np.zeros(n_rows * m, dtype=U)
    horizon = m * (np.log(m) + 2) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        own = np.flatnonzero(todo[row])
        r, e, w = row[own], h[own], weight[own]
        # one cell for each unit of a shingle's own time, which runs at its weight
        cells = np.ceil(horizon[r] * w).astype(np.int64)
        k = np.repeat(np.arange(len(own)), cells)
        cell = np.arange(len(k)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mix(e[k] + cell.astype(U) * U(0x9E3779B97F4A7C15))
        arrivals = np.searchsorted(_POISSON, (seed >> U(11)).astype(float) * 2.0**-53)
        j = np.repeat(np.arange(len(k)), arrivals)
        nth = np.arange(len(j)) - np.repeat(np.cumsum(arrivals) - arrivals, arrivals)
        bits = mix(seed[j] ^ (nth.astype(U) + U(1)) * U(0xC2B2AE3D27D4EB4F))
        k, cell = k[j], cell[j]
        time = (cell + (bits >> U(24)).astype(float) * 2.0**-40) / w[k]
        at = r[k] * m + ((bits & U(0xFFFFFF)) % U(m)).astype(np.int64)
        np.minimum.at(best, at, time)
        mine = time == best[at]
        won[at[mine]] = e[k[mine]]
        # an arrival after the horizon could still be the first in an empty register only
        late = (best.reshape(n_rows, m) > horizon[:, None]).any(axis=1) & todo
        best.reshape(n_rows, m)[late] = np.inf
        horizon[late] *= 2
        todo = late
    return won.reshape(n_rows, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS_PER_BAND)
    keys = (mix(parts) * (spread(ROWS_PER_BAND, 21) | U(1))).sum(axis=2, dtype=U)
    return mix(keys + spread(BANDS, 22))


def _weights(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def _all_bands(n_rows: int, row: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of each row, and which of them count: those by weight, and the others of the plain set.

    A text that repeats no shingle has the same arrivals either way.
    """
    first = band_keys(signatures(n_rows, row, h, _weights(count)))
    keys, use = np.concatenate([first, first], axis=1), np.zeros((n_rows, 2 * BANDS), dtype=bool)
    use[row, :BANDS] = True
    some = np.unique(row[count > 1])
    own = np.isin(row, some)
    plain = band_keys(signatures(len(some), np.searchsorted(some, row[own]), h[own], np.ones(own.sum())))
    keys[some, BANDS:] = plain
    use[some, BANDS:] = plain != first[some]
    return keys, use


def _bands(batches):
    for batch in batches:
        for part in slices(batch, rows=SIGNED_ROWS):
            w = Words(part.column("text"), lower=True)
            row, h, count = shingles(w)
            keys, use = _all_bands(w.n_rows, row, h, count)
            off = np.concatenate([[0], np.cumsum(use.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("node"),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(keys[use].view(np.int64)))],
                names=["doc_id", "node", "bands"])


def _sets(batches):
    """Distinct shingles, sorted, with the places and numbers of those that occur more than once."""
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), lower=True)
            row, h, count = shingles(w)
            off = np.searchsorted(row, np.arange(w.n_rows + 1))
            many = np.flatnonzero(count > 1)
            many_off = pa.array(np.searchsorted(many, off).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64))),
                 pa.ListArray.from_arrays(many_off, pa.array((many - off[row[many]]).astype(np.int32))),
                 pa.ListArray.from_arrays(many_off, pa.array(count[many].astype(np.int32)))],
                names=["node", "shingles", "many", "counts"])


SETS = "node long, shingles array<long>, many array<int>, counts array<int>"


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """J_P of two weight vectors over the same shingles (0 where a text lacks one)."""
    a, b = a / a.sum(), b / b.sum()
    with np.errstate(divide="ignore"):
        ratio = np.where(b > 0, a / np.where(b > 0, b, 1), np.inf)
    order = np.argsort(-ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    over = np.concatenate([[0], np.cumsum(a)])
    under = b.sum() - np.concatenate([[0], np.cumsum(b)])
    both = np.flatnonzero((a > 0) & (b > 0))
    # shingles with a ratio at least as large count by a, the others by b
    end = np.searchsorted(-ratio, -ratio[both], side="right")
    return float((1 / (over[end] / a[both] + under[end] / b[both])).sum())


def similarity(x: np.ndarray, x_count: np.ndarray, y: np.ndarray, y_count: np.ndarray) -> float:
    """The larger of J_P and the plain Jaccard similarity of two sorted sets with counts."""
    if not len(x) or not len(y):
        return 0.0
    either = np.union1d(x, y)
    a, b = np.zeros(len(either)), np.zeros(len(either))
    a[np.searchsorted(either, x)] = _weights(x_count)
    b[np.searchsorted(either, y)] = _weights(y_count)
    plain = ((a > 0) & (b > 0)).sum() / len(either)
    return float(max(plain, probability_jaccard(a, b)))


def _verified(batches):
    for batch in batches:
        get = lambda name, i: batch.column(name)[i].values.to_numpy()
        sims = []
        for i in range(batch.num_rows):
            sides = []
            for s in ("a_", "b_"):
                x = get(s + "shingles", i)
                c = np.ones(len(x))
                c[get(s + "many", i)] = get(s + "counts", i)
                sides += [x.view(np.uint64), c]
            sims.append(similarity(*sides))
        sims = np.array(sims, dtype=float)
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims)], names=["a", "b", "similarity"])
        yield out.filter(pa.array(sims >= SIMILARITY))


def _links(spark: SparkSession, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough, staged."""
    side = lambda s: sets.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in sets.columns[1:]])
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", *[f"{s}_{c}" for s in "ab" for c in sets.columns[1:]])
    return stage(spark, both.mapInArrow(_verified, "a long, b long, similarity double"), name)


def _entries(batches):
    """A row for each shingle of a text: its share of the text's weight, and the number of the text's shingles."""
    for batch in batches:
        n = pa.compute.list_value_length(batch.column("shingles")).to_numpy()
        off = np.concatenate([[0], np.cumsum(n)])
        text = np.repeat(np.arange(len(n)), n)
        count = np.ones(off[-1])
        many = batch.column("many").flatten().to_numpy()
        count[many + np.repeat(off[:-1], pa.compute.list_value_length(batch.column("many")).to_numpy())] = batch.column("counts").flatten()
        weight = _weights(count)
        share = weight / np.bincount(text, weights=weight, minlength=len(n))[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column("node").to_numpy()[text]), batch.column("shingles").flatten(), pa.array(share),
             pa.array(n[text].astype(np.int32))], names=["node", "shingle", "share", "size"])


def _marks(batches):
    """Of each text: the total weight of its shingles, and for MARKS places the parity of the shingles that fall there."""
    for batch in batches:
        n = pa.compute.list_value_length(batch.column("shingles")).to_numpy()
        text = np.repeat(np.arange(len(n)), n)
        h = batch.column("shingles").flatten().to_numpy().view(np.uint64)
        place = (mix(h ^ U(0x6A09E667F3BCC909)) % U(MARKS)).astype(np.int64)
        odd = (np.bincount(text * MARKS + place, minlength=len(n) * MARKS) & 1).astype(np.uint8).reshape(len(n), MARKS)
        bits = np.packbits(odd, axis=1).view(np.int64)
        counts = batch.column("counts")
        more = np.bincount(np.repeat(np.arange(len(n)), pa.compute.list_value_length(counts).to_numpy()),
                           weights=np.log(counts.flatten().to_numpy().astype(float)), minlength=len(n))
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array((n + more).astype(float)), *[pa.array(b) for b in bits.T]],
                                         names=["node", "total", *MARK_COLUMNS])


def open_pairs(spark: SparkSession, sets: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts of different classes that can be similar enough: none that is can be missing.

    If the shingles that two texts share weigh shares p and q of them, plain
    Jaccard (weights 1) is 1 / (1/p + 1/q - 1), and J_P is at most that: each
    term of J_P is at most a harmonic mean, which is concave.  From the first
    shared shingle on, in one order of all shingles, a text has at least its
    shared ones, so what it has bounds p and q.  Of two texts one has to keep
    8/9 there, the other 0.8.

    Shingles of one text only number at least as many as the places where the
    two texts' parities differ.  A link by plain similarity allows 1/9 of both
    sizes; one by J_P 2/9 of the larger total weight, as each of them weighs 1
    or more and the bound is convex.  This is tested inside the join, so that
    of a family whose members are all a little too far from one another no
    pairs come out.  A shingle of many texts is dealt to several tasks: each
    has a part of one side and all of the other.
    """
    each = stage(spark, sets.mapInArrow(_entries, "node long, shingle long, share double, size int"), "entries")
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # what a text has from a shingle on: the shingles as frequent or more, of those that any two texts share
    onward = Window.partitionBy("node").orderBy(F.col("often").desc(), "shingle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = (each.join(often, "shingle").withColumn("rest", F.count(F.lit(1)).over(onward))
            .withColumn("mass", F.sum("share").over(onward))
            .where((F.col("rest") >= F.col("size") * (SIMILARITY - EPSILON)) | (F.col("mass") >= SIMILARITY - EPSILON)))
    marks = sets.mapInArrow(_marks, "node long, total double, " + ", ".join(f"{c} long" for c in MARK_COLUMNS))
    kept = _with_class(kept.select("node", "shingle", "size", "rest", "mass"), label, "node", "class")
    kept = stage(spark, kept.join(marks, "node"), "kept")
    # of two classes at a shingle, one is not the largest there
    classes = kept.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(
        F.max(F.struct("n", "class"))["class"].alias("largest"), F.count(F.lit(1)).alias("classes"),
        F.ceil(F.sum("n") / PART_ROWS).cast("int").alias("parts")).where("classes > 1")
    classes = stage(spark, classes.select("shingle", "largest", "parts"), "met-at")
    some = kept.join(classes, "shingle")
    here = some.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    side = some.where("class <> largest").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = side.select(*[F.col(c).alias(f"_{c}") for c in ("shingle", "part", "node", "size", "rest", "mass", "class", "total", *MARK_COLUMNS)])
    most = 1 + 1 / SIMILARITY + EPSILON
    own = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"_{c}"))) for c in MARK_COLUMNS), F.lit(0))
    spare = (1 - SIMILARITY) / (1 + SIMILARITY) + EPSILON
    plain = (F.col("size") + F.col("_size") <= F.least("rest", "_rest") * most) & (own <= (F.col("size") + F.col("_size")) * spare)
    weighted = (1 / F.col("mass") + 1 / F.col("_mass") <= most) & (own <= 2 * F.greatest("total", "_total") * spare)
    met = here.join(side, (F.col("shingle") == F.col("_shingle")) & (F.col("part") == F.col("_part"))
                    & (F.col("class") != F.col("_class")) & (plain | weighted))
    found = stage(spark, met.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct(), "open-pairs")
    discard(each, kept, classes)
    return found


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """The smallest node of each linked node's component: smallest labels spread over links and jump ahead, staged a round."""
    edges = stage(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    label = stage(spark, edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        heard = (edges.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("heard")))
        spreads = (label.join(heard.withColumnRenamed("a", "node"), "node")
                   .select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label")))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stage(spark, spreads.join(jump, "label", "left")
                    .select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        discard(label)
        moved = new.where("label <> old").limit(1).count()
        label = new.select("node", "label")
        if not moved:
            discard(edges)
            return label


def _with_class(rows: DataFrame, label: DataFrame, node: str, name: str) -> DataFrame:
    return (rows.join(label.select(F.col("node").alias(node), F.col("label").alias(name)), node, "left")
            .withColumn(name, F.coalesce(name, node)))


def text_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, node), links (a, b, similarity) between nodes, and the class label of each linked node.

    A node is a text, named by its 64-bit hash.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash(F.col("text")).alias("node"))
    rows = stage(spark, texts.mapInArrow(_bands, "doc_id long, node long, bands array<long>"), "bands")
    keys = rows.select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("key"))
    full = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stage(spark, keys.join(full, "key"), "buckets")
    central = met.groupBy("node").agg(F.sum("n").alias("central"))
    buckets, met = met, stage(spark, met.join(central, "node"), "members")
    discard(buckets)

    wanted = stage(spark, met.select("node").distinct(), "wanted")
    near = texts.select("text", "node")
    small = wanted.count() * 16 <= BROADCAST_BYTES // 8
    near = near.join(F.broadcast(wanted) if small else wanted, "node", "left_semi")
    sets = stage(spark, near.mapInArrow(_sets, SETS).dropDuplicates(["node"]), "shingles")

    def pairs(members: DataFrame, *part) -> DataFrame:
        """Distinct pairs of each bucket's members and its most central member (of each part), if of different classes."""
        best = F.max(F.struct("central", "node", "class"))
        leaders = members.groupBy("key", *part).agg(best.alias("leader")).select(
            F.col("key").alias("_key"), F.col("leader.node").alias("leader"), F.col("leader.class").alias("other"))
        apart = members.join(leaders, (F.col("key") == F.col("_key")) & (F.col("class") != F.col("other")))
        return apart.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()

    # a sixth of the buckets first: their links settle most members of large groups
    early = F.pmod(F.xxhash64("key"), F.lit(6)) == 0
    first = stage(spark, pairs(met.where(early).withColumn("class", F.col("node"))), "pairs")
    links = _links(spark, first, sets, "links")
    label = components(spark, links)
    more = stage(spark, pairs(_with_class(met.where(~early), label, "node", "class")).join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.union(_links(spark, more, sets, "links"))
    label = components(spark, links)

    # buckets whose members are still of different classes
    members = _with_class(met, label, "node", "class")
    split = members.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("key")
    members = stage(spark, members.join(split, "key"), "split")
    few, many = members.where(F.col("n") <= SMALL_BUCKET), members.where(F.col("n") > SMALL_BUCKET)
    other = few.select(F.col("key").alias("_key"), F.col("node").alias("leader"), F.col("class").alias("other"))
    rest = (few.join(other, (F.col("key") == F.col("_key")) & (F.col("class") < F.col("other")))
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            .union(pairs(many.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(LEADERS))), "part")).distinct())
    done = more.union(first)
    tried = stage(spark, rest.join(done, ["a", "b"], "left_anti"), "pairs")
    links = links.union(_links(spark, tried, sets, "links"))
    label = components(spark, links)

    # large buckets whose members are still of different classes
    large = _with_class(members.where(F.col("n") > SMALL_BUCKET).drop("class"), label, "node", "class")
    split = large.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("key")
    unsettled = stage(spark, large.join(split, "key").select("node").distinct(), "unsettled")
    if unsettled.limit(1).count():
        rest = open_pairs(spark, sets.join(unsettled, "node", "left_semi"), label)
        links = links.union(_links(spark, rest.join(done.union(tried), ["a", "b"], "left_anti"), sets, "links"))
        label = components(spark, links)
        discard(rest)
    discard(first, more, tried, met, members, wanted, unsettled, sets)
    return rows.select("doc_id", "node"), links, label


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: class_id (the class's smallest id), rows in the class, links of its text, whether it stays."""
    spark = docs.sparkSession
    rows, links, label = text_links(docs)
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    rows = stage(spark, _with_class(rows, label, "node", "label").join(degree, "node", "left")
                 .select("doc_id", "node", "label", F.coalesce("links", F.lit(0)).cast("long").alias("links")), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    chosen = rows.groupBy("label").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(chosen, "label").select(
        "doc_id", F.col("stays.doc_id").alias("class_id"), "class_size", "links",
        (F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("node") == F.col("stays.node"))).alias("stays"),
        F.col("node").alias("text_hash"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns."""
    spark = docs.sparkSession
    found = stage(spark, near_duplicates(docs).select("doc_id", "text_hash", "stays"), "near")
    gone = stage(spark, found.where("not stays").select("doc_id", "text_hash").distinct(), "gone")
    if gone.count() * 64 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]) & (text_hash(docs["text"]) == gone["text_hash"]), "left_anti")
    stay = found.where("stays")
    if stay.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept
