"""Spelling variants (13) against all pairs of words."""
import random
import re
import zlib
from collections import Counter

import corpus
import duckdb
import numpy as np
import pytest

from lakepipe.llm import spelling, words
from lakepipe.llm.oracle import SQL


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, o in others.items():
        best = min(o, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return out


def rows():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcéÀ") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aabbaa", "ÿÿÿÿÿÿ", "×÷×÷×÷", "abcdefghijklmnop"]
    out = []
    for i in range(400):
        text = []
        for _ in range(rng.randrange(60)):
            w = base[min(int(rng.expovariate(0.08)), len(base) - 1)]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "a", "bé", "É"]) + w[k + rng.randrange(2):]
            text.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", "\n", "1", "-", "ж", "日"]).join(text)))
    out += [(None, out[3][1]), (None, None), (7, ""), (8, None), *[out[9]] * 6]           # repeated rows, nulls
    out += [(1000 + i, "x" * 5000 + " " + "y" * (3000 + i % 2)) for i in range(9)]              # long runs
    return out


@pytest.fixture(scope="module")
def docs(spark):
    made = [(i, t, "en", "hot", 1, *["z"] * 8) for i, t in rows()]
    return spark.createDataFrame(made, corpus.SCHEMA)


def test_against_all_pairs(docs):
    got = spelling.spelling_groups(docs.withColumnRenamed("lang", "word").withColumnRenamed("n_chars", "n"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_groups(rows())
    assert {tuple(r) for r in got.collect()} == want
    assert sum(w[1] is not None for w in want) > 10 and any(w[1] != w[2] and w[1] for w in want)
    assert any(w[0] == "x" * 5000 for w in want)


def test_sql(spark, docs, tmp_path):
    corpus.stored(spark, docs, tmp_path, "documents")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert set(con.sql(SQL["op13_trie_node_pairs"]).fetchall()) == brute_groups(rows())


def test_long_texts_in_pieces(docs, monkeypatch):
    want = {tuple(r) for r in spelling.word_counts(docs).collect()}
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    counted = Counter()
    batches = (b for b in docs.select(docs.doc_id.cast("string").alias("doc_id"), "text").toArrow().to_batches())
    for b in spelling._counted(batches):
        for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            counted[w] += n
    assert {(w, n) for w, n in counted.items() if n >= spelling.MIN_COUNT} == want


def test_crc():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    start = rng.integers(0, 2800, 200)
    end = start + rng.integers(0, 200, 200)
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(200)], dtype=np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(start, end, before, strict=True)]
    assert spelling.crc32(data, start, end, before).tolist() == want


def test_empty_table(docs):
    assert spelling.spelling_groups(docs.where("false")).count() == 0
    assert spelling.spelling_groups(docs.where("text is null")).count() == 0
