"""Ranked search (11) against scoring every document."""
import math
from collections import Counter

import brute
import corpus
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import k2_treap, words
from lakepipe.llm.oracle import SQL


def scored(docs, items, top=10):
    """docs, items: (id, text); the best of each item, as (item, rank, doc, score)."""
    terms = [(i, Counter(brute.letters(t))) for i, t in docs]
    n = sum(bool(c) for _, c in terms)
    total = sum(sum(c.values()) for _, c in terms)
    df = Counter(x for _, c in terms for x in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in terms:
            score = 0
            for x in set(brute.letters(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                score += w * (1_000_000_000 * c[x] // (1000 * c[x] + 8 * (10 + 90 * sum(c.values()) * n // total)))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top])]
    return out


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return corpus.stored(spark, corpus.documents(spark), tmp_path_factory.mktemp("docs"))


def multiset(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def want():
    return Counter(scored(pairs(corpus.document_rows()), pairs(corpus.benchmark_rows())))


def test_against_all_scores(spark, docs, want):
    assert multiset(k2_treap.ranked(docs.withColumnRenamed("lang", "score"), corpus.benchmark(spark))) == want
    assert max(want.values()) == 2                        # an item that is there twice is ranked twice


def test_small_shards_blocks_and_slices(spark, docs, want, monkeypatch):
    monkeypatch.setattr(k2_treap, "BLOCK_BYTES", 900)
    monkeypatch.setattr(k2_treap, "STATE_CELLS", 500)
    monkeypatch.setattr(k2_treap, "BEAM", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert multiset(k2_treap.ranked(docs, corpus.benchmark(spark))) == want
        monkeypatch.setattr(k2_treap, "MOST_TERMS", 3)    # then the index holds all terms
        assert multiset(k2_treap.ranked(docs, corpus.benchmark(spark))) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_texts_in_pieces(docs, monkeypatch):
    batch = docs.select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    whole = next(iter(k2_treap._shards(None, 100, 1000)([batch])))
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    assert next(iter(k2_treap._shards(None, 100, 1000)([batch]))).equals(whole)


def test_ties_by_id(spark):
    texts = [(i, "common words of a copy") for i in (*range(400, 0, -1), None)] + [(i, f"another text {i} of words") for i in range(500, 900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    items = [(1, "a copy"), (2, "words"), (3, "nothing like it"), (4, "TEXT 555")]
    got = k2_treap.ranked(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert multiset(got) == Counter(scored(texts, items))


def test_sql(spark, docs, want, tmp_path):
    corpus.stored(spark, docs, tmp_path, "documents")
    corpus.stored(spark, corpus.benchmark(spark), tmp_path, "benchmark")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert Counter(con.sql(SQL["op11_k2_treap"]).fetchall()) == want


def test_treap_is_the_grid():
    rng = np.random.default_rng(2)
    cells = np.unique(rng.integers(0, 50, (600, 2)) * [1, 20], axis=0)
    value = rng.integers(1, 10**6, len(cells))
    treap = k2_treap.Treap.unpacked(*k2_treap.Treap.build(cells[:, 0], cells[:, 1], value).packed())
    got = {}
    for (r, c), v in zip(cells.tolist(), value.tolist(), strict=True):
        cell = 0
        for k in range(treap.height):
            shift = treap.height - 1 - k
            at = 4 * cell + 2 * (r >> shift & 1) + (c >> shift & 1)
            assert treap.bits[k][at]
            cell = int(treap.before[k][at])
            inside = (cells[:, 0] >> shift == r >> shift) & (cells[:, 1] >> shift == c >> shift)
            assert treap.best[k + 1][cell] == value[inside].max()
        got[r, c] = int(treap.best[-1][cell])
        assert got[r, c] == v


def test_empty_tables(spark, docs):
    items = corpus.benchmark(spark)
    assert k2_treap.ranked(docs.where("false"), items).count() == 0
    assert k2_treap.ranked(docs, items.where("false")).count() == 0
    assert k2_treap.ranked(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0
