"""Quality classifier (8): supervised subword embeddings.

Method: words, pairs of neighbouring words (two equal ones are one feature)
and runs of 3 and 4 bytes are hashed into ``BUCKETS`` learned vectors.  A
document is the average of its vectors (of each kind, then of the kinds); a
softmax layer scores it.  Vectors and layer are trained by stochastic gradient
descent in numpy, on a bounded sample of labelled documents.  The averages are
linear, so scoring a text needs one number a bucket.

The sample: of the labelled ids that are not held out, the ``TRAIN_ROWS``
first in hash order, of these the first with ``TRAIN_BYTES`` of text in total
(a text over ``TRAIN_TEXT`` is not learned from).  Every document is scored,
by its whole text alone.

Defined results: a null or empty text has the layer's bias as its score; ids
without a majority of labels, or with null ones only, are not learned from;
without documents of both labels all scores are the smoothed share of label 1;
a null id is not held out; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import discard, stage
from lakepipe.llm.words import U, Words, prefix, powers, slices, spread

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
BYTE_RUNS = (3, 4)
DIMENSIONS, EPOCHS, RATE, SEED = 8, 6, 1.0, 7
TRAIN_ROWS, TRAIN_BYTES, TRAIN_TEXT = 6000, 48 << 20, 256 << 10
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h * (spread(1, 300 + kind)[0] | U(1))) >> U(64 - BUCKET_BITS)).astype(np.int64)


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind: bucket of each feature, and the range of features of each row."""
    out = [(_bucket(words.hash, 0), words.off[:-1], words.off[1:])]
    h = words.hash
    pair = np.where(h[:-1] == h[1:], U(0x123456789), h[:-1] * U(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    out.append((_bucket(pair, 1), words.off[:-1], np.maximum(words.off[:-1], words.off[1:] - 1)))
    sums = prefix(spread(256, 9)[words.data], 9)
    for n in BYTE_RUNS:
        size = max(0, len(words.data) - n + 1)
        h = (sums[n: n + size] - sums[:size]) * powers(len(sums), 9)[1][:size]
        start = np.minimum(words.row_bytes[:-1], size)
        out.append((_bucket(h, n), start, np.minimum(np.maximum(start, words.row_bytes[1:] - n + 1), size)))
    return out


def _averages(words: Words, value: np.ndarray) -> np.ndarray:
    """Average over the kinds of the average value of a row's features."""
    total, kinds = np.zeros(words.n_rows), np.zeros(words.n_rows)
    for bucket, a, b in features(words):
        sums = np.concatenate([[0], np.cumsum(value[bucket])])
        total += (sums[b] - sums[a]) / np.maximum(b - a, 1)
        kinds += b > a
    return total / np.maximum(kinds, 1)


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their weights, which add up to 1, in 6 bytes a bucket."""
    got = [bucket[a[0]: b[0]] for bucket, a, b in features(Words(pa.array([text])))]
    got = [x for x in got if len(x)]
    every = np.concatenate(got) if got else np.zeros(0, dtype=np.int64)
    weight = np.concatenate([np.full(len(x), 1 / (len(x) * len(got))) for x in got]) if got else np.zeros(0)
    ids, at = np.unique(every, return_inverse=True)
    return ids.astype(np.uint16), np.bincount(at, weights=weight, minlength=len(ids)).astype(np.float32)


class Model:
    """Value of each bucket and bias; the score is the logistic of the text's average plus the bias."""

    def __init__(self, value: np.ndarray, bias: float):
        self.value, self.bias = value, bias

    def scores(self, column) -> np.ndarray:
        z = _averages(Words(column), self.value) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(texts: list[str], labels: list[int]) -> Model:
    y = np.array(labels, dtype=np.int64)
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), float(np.log(prior / (1 - prior))))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, 2)), np.log([1 - prior, prior])
    rows = [_sparse(t) for t in texts]
    steps = EPOCHS * len(rows)
    for epoch in range(EPOCHS):
        for n, i in enumerate(rng.permutation(len(rows))):
            rate = RATE * (1 - (epoch * len(rows) + n) / steps)
            ids, weight = rows[i]
            mean = weight @ vectors[ids]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= 0.05 * rate * p
            # every bucket moves by its weight; scaled so that a text's vectors move together by about the rate
            vectors[ids] -= rate * np.outer(weight / weight.max() if len(weight) else weight, back)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "quality") -> list[tuple[str, int]]:
    """Texts and labels to learn from, in the order of ids: a bounded number of bounded texts."""
    voted = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.avg(label).alias("vote")).where("vote <> 0.5")
             .select("doc_id", (F.col("vote") > 0.5).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    text = F.coalesce("text", F.lit(""))
    one = (docs.select("doc_id", text.alias("text")).where(F.octet_length("text") <= TRAIN_TEXT)
           .join(F.broadcast(voted), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    place = Window.orderBy(F.xxhash64("doc_id"), "doc_id")             # at most TRAIN_ROWS rows
    got = stage(docs.sparkSession, one.withColumn("reach", F.sum(F.octet_length("text")).over(place))
                .where(F.col("reach") <= TRAIN_BYTES), "train")
    sample = [(r["text"], r["label"]) for r in got.orderBy("reach", "doc_id").select("text", "label").toLocalIterator()]
    discard(got)
    return sample


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                score = model.scores(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score),
                     pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held_out, score, predicted (see the contract of op8)."""
    sample = training_sample(docs, labels)
    model = train([t for t, _ in sample], [y for _, y in sample])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return texts.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double, predicted int")
