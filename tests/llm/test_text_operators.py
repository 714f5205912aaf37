"""Operators on texts, against brute force (4, 6, 7, 8, 9)."""
from collections import Counter, defaultdict

import brute
import corpus
import numpy as np
import pyarrow as pa
import pytest

from lakepipe.llm import fm_index, license_diagonals, recompress, repetition, subword, words


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return corpus.stored(spark, corpus.documents(spark), tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def rows(docs):
    return docs.select("doc_id", "text").collect()


def multiset(rows):
    return Counter(map(tuple, rows))


def test_words_of_a_slice(rows):
    texts = [r["text"] for r in rows]
    for lower, find in ((False, brute.plain), (True, brute.letters)):
        w = words.Words(pa.array(texts), lower=lower)
        assert w.count.tolist() == [len(find(t)) for t in texts]
        names = defaultdict(set)
        got = [x for t in texts for x in find(t)]
        for h, x in zip(w.hash, got, strict=True):
            names[x].add(int(h))
        assert all(len(v) == 1 for v in names.values())
        assert len({next(iter(v)) for v in names.values()}) == len(names)


def test_slices_hold_whole_rows(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 120, "b", None, "c" * 49, "d"])], names=["text"])
    parts = list(words.slices(batch))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert [len(p) for p in parts] == [1, 3, 1] or [len(p) for p in parts] == [1, 2, 2]


def test_repetition_rules(docs, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = repetition.repetition_rules(docs).collect()
    assert multiset([(r["doc_id"], *[r[n] for n in names]) for r in got]) == \
        multiset([(r["doc_id"], *brute.quality(r["text"])) for r in rows])
    whole = {r["text"]: r for r in rows}
    assert len(got) == len(rows) and whole
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None and r["doc_id"] not in (0, 5)}
    for r in rows:
        if r["doc_id"] in by_id:
            for n in repetition.COVER_LIMITS:
                assert by_id[r["doc_id"]][f"cover_{n}"] == pytest.approx(brute.cover(r["text"], n))
    kept = repetition.keep_documents(docs)
    assert kept.columns == docs.columns
    assert multiset([(r["doc_id"],) for r in kept.collect()]) == multiset([(r["doc_id"],) for r in got if r["kept"]])


@pytest.mark.parametrize("block", [fm_index.BLOCK_BYTES, 900])
def test_contamination(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", block)
    bench = corpus.benchmark(spark)
    want = brute.contamination([r["text"] for r in rows], [(r["item_id"], r["text"]) for r in bench.collect()])
    spans = fm_index.removal_spans(docs, bench, block)
    for r in spans.collect():
        assert r["n_hit"] == sum(b - a for a, b in zip(r["span_start"], r["span_end"], strict=True))
    if block == fm_index.BLOCK_BYTES or block == 900:
        got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in spans.collect()]
        assert multiset(got) == multiset([(r["doc_id"], *w[:3]) for r, w in zip(rows, want, strict=True)])
    got = fm_index.contamination(docs, bench).collect()
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert multiset([(r["doc_id"], *[r[n] for n in names]) for r in got]) == \
        multiset([(r["doc_id"], *w) for r, w in zip(rows, want, strict=True)])
    assert any(w[4] for w in want)
    clean = fm_index.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert multiset([(r["doc_id"], r["text"]) for r in clean.collect()]) == \
        multiset([(r["doc_id"], r["text"]) for r, w in zip(rows, want, strict=True) if not w[4]])


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 4, 400)
    text[rng.integers(0, 400, 30)] = 0
    text[-1] = 0
    index = fm_index.FMIndex(text, 3)
    for n in (1, 2, 5):
        phrases = np.unique(rng.integers(1, 4, (50, n)), axis=0)
        back = np.zeros((len(phrases), 13), dtype=np.int32)
        back[:, :n] = phrases[:, ::-1]
        which, lo, hi = index.search(back, np.full(len(phrases), n))
        found = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(which, lo, hi, strict=True)}
        for p, phrase in enumerate(phrases):
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == phrase).all()]
            assert found.get(p, []) == want


def test_without_benchmark_rows(spark, docs, rows):
    none = corpus.benchmark(spark).where("item_id < 0")
    got = fm_index.contamination(docs, none).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] or r["n_hit"] for r in got)
    assert fm_index.keep_clean(docs, none).count() == len(rows)


def test_repeats_removed(docs, rows):
    got = recompress.repeats_removed(docs).collect()
    want = brute.repeats([r["text"] for r in rows])
    assert multiset(got) == multiset([(r["doc_id"], *w) for r, w in zip(rows, want, strict=True)])
    assert sum(w[1] for w in want) > 1000
    kept = recompress.kept_texts(docs).collect()
    import hashlib
    assert multiset([(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in kept]) == \
        multiset([(r["doc_id"], w[2]) for r, w in zip(rows, want, strict=True)])


def test_equal_windows_take_equal_symbols():
    """Whatever stands around them; the runs and pairs of a window decide its symbol."""
    import random
    rng = random.Random(2)
    passage = " ".join(rng.choice("abc") for _ in range(40))
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))) + " " + passage + " "
             + " ".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(40)]
    w = words.Words(pa.array(texts))
    name, first, count, _ = recompress.anchors(w)
    at = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count, strict=True)])
    symbol = np.repeat(name, count)
    start, h = w.windows(recompress.WINDOW)
    assert sorted(at.tolist()) == start.tolist()
    of = dict(zip(at.tolist(), symbol.tolist(), strict=True))
    seen = {}
    for s, x in zip(start.tolist(), h.tolist(), strict=True):
        assert seen.setdefault(x, of[s]) == of[s]


def test_license_scan(docs, rows):
    got = license_diagonals.license_scan(docs).collect()
    assert len(got) == len(rows)
    want = []
    for r in rows:
        w = brute.letters(r["text"])
        places, labels = [], set()
        for phrase, label in license_diagonals.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        want.append((r["doc_id"], len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert multiset([tuple(r[n] for n in names) for r in got]) == multiset(want)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))
    texts = {r["doc_id"]: r["text"] for r in rows}
    labels = {r["doc_id"]: r["labels"] for r in got}
    of = lambda part: next(labels[i] for i, t in texts.items() if t and part in t)
    assert of("Released under the MIT") == "mit,mit-notice"
    assert of("Licensed under the Apache") == "apache,apache-2.0"
    assert of("GNU General Public License, version 3.") == "cc-by,cc-by-nc-4.0,gpl,gpl-3.0"


def test_license_span_with_words_put_in(spark):
    notice = next(t for name, t in license_diagonals.TEMPLATES if name == "mit-notice" and len(t) > 60).split()
    text = "before " + " ".join(notice[:9] + ["really", "quite"] + notice[9:]) + " after"
    df = spark.createDataFrame([(1, text, 7), (2, "permission is hereby granted", 8)], "doc_id long, text string, text_hash long")
    got = license_diagonals.spans(df).collect()
    assert [(r["doc_id"], r["label"], r["first_at"], r["last_at"]) for r in got] == [(1, "mit-notice", 1, len(notice) + 2)]


def test_quality_scores_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = subword.quality_scores(docs, labels)
    assert got.count() == docs.count()
    r = got.join(labels, "doc_id").where("held_out and quality is not null").select("score", "predicted", "quality").toPandas()
    good, bad = r[r.quality == 1].score.values, r[r.quality == 0].score.values
    auc = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    right = ((r.predicted == 1) == (r.quality == 1)).mean()
    print("held-out AUC", auc, "accuracy", right)
    assert auc > 0.9 and right > 0.9
    assert got.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_quality_scores_of_awkward_rows(spark, docs, rows):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (2, 1, "x"), (None, 1, "x"), (3, None, "x"), (61, 0, "x"), (70, 0, "x"), (7, 1, "x")],
                                   "doc_id long, quality int, text string")
    got = subword.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in subword.quality_scores(docs, labels.where("quality = 1")).collect()}) == 1
    import zlib
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


@pytest.mark.parametrize("run", [
    repetition.repetition_rules, recompress.repeats_removed, license_diagonals.license_scan,
    lambda d: fm_index.contamination(d, corpus.benchmark(d.sparkSession)),
    lambda d: subword.quality_scores(d, d.selectExpr("doc_id", "1 as quality"))])
def test_empty_tables(docs, run):
    assert run(docs.where("false")).collect() == []
