"""Near-duplicate classes (2) against all pairs."""
import subprocess
import sys
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import brute
import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import near_dup, words
from lakepipe.llm.frames import stage


def shingle_counts(text):
    w = brute.letters(text)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def weighted(a, b):
    """J_P by its definition."""
    share = []
    for counts in (a, b):
        w = {k: 1 + np.log(v) for k, v in counts.items()}
        share.append({k: v / sum(w.values()) for k, v in w.items()})
    p, q = share
    return sum(1 / sum(max(p.get(y, 0) / p[x], q.get(y, 0) / q[x]) for y in {*p, *q}) for x in {*p} & {*q})


def sim(a, b):
    if not a or not b:
        return 0.0
    return max(len(set(a) & set(b)) / len(set(a) | set(b)), weighted(a, b))


def brute_classes(texts):
    """Class of each distinct text by all pairs."""
    names = list(dict.fromkeys("" if t is None else t for t in texts))
    counts = [shingle_counts(t) for t in names]
    up = list(range(len(names)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = set()
    for i, j in combinations(range(len(names)), 2):
        if set(counts[i]) & set(counts[j]) and sim(counts[i], counts[j]) >= 0.8:
            links.add((i, j))
            up[top(i)] = top(j)
    return {t: top(i) for i, t in enumerate(names)}, {(names[i], names[j]) for i, j in links}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return corpus.stored(spark, corpus.documents(spark), tmp_path_factory.mktemp("docs"))


def test_similarity_by_definition():
    a = shingle_counts("a b c d e f g h i j a b c d e f k l m n")
    b = shingle_counts("a b c d e f g h i j x y z a b c d e f g h i j")
    every = sorted(set(a) | set(b))
    place = {k: i for i, k in enumerate(every)}
    side = lambda c: (np.array(sorted(place[k] for k in c)), np.array([c[every[i]] for i in sorted(place[k] for k in c)]))
    got = near_dup.similarity(*side(a), *side(b))
    assert got == pytest.approx(sim(a, b))
    assert near_dup.similarity(*side(a), *side(a)) == pytest.approx(1)


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(4)
    shared, one, two = rng.integers(0, 2**63, 300).astype(np.uint64), *rng.integers(0, 2**63, (2, 60)).astype(np.uint64)
    row = np.concatenate([np.zeros(360), np.ones(360), np.full(1, 2)]).astype(int)
    h = np.concatenate([shared, one, shared, two, shared[:1]])
    weight = np.concatenate([np.ones(360), np.ones(360), [3.0]])
    sig = near_dup.signatures(4, row, h, weight, 4000)
    assert abs((sig[0] == sig[1]).mean() - 300 / 420) < 0.03
    assert (sig[2] == shared[0]).all() and not sig[3].any()


def test_classes_equal_all_pairs(docs):
    rows = docs.select("doc_id", "text").collect()
    cls, links = brute_classes([r["text"] for r in rows])
    got = near_dup.near_duplicates(docs).join(
        docs.selectExpr("coalesce(text, '') as text").distinct().withColumn("text_hash", F.xxhash64("text")), "text_hash").collect()
    ids = defaultdict(list)
    for r in rows:
        ids[cls[r["text"] or ""]].append(r["doc_id"])
    want = {t: (min((x for x in ids[c] if x is not None), default=None), len(ids[c])) for t, c in cls.items()}
    for r in got:
        assert (r["class_id"], r["class_size"]) == want[r["text"]], r
    degree = Counter(t for pair in links for t in pair)
    assert all((r["links"] > 0) == (r["text"] in degree) and r["links"] <= degree[r["text"]] for r in got)


def test_one_of_each_class_stays(docs):
    found = near_dup.near_duplicates(docs).collect()
    kept = near_dup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    staying = {(r["doc_id"], r["text_hash"]) for r in found if r["stays"]}
    assert all(r["doc_id"] == r["class_id"] for r in found if r["stays"])
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == sorted(
        i if i is not None else -1 for i, _ in staying)
    assert len({r["text_hash"] for r in found if r["stays"]}) == len(staying)


def test_chain_of_links_is_one_class(spark):
    """Neighbours are similar, the ends are not."""
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(vocabulary[s:s + 200]) for s in range(0, 160, 10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["class_id"] for r in near_dup.near_duplicates(df).collect()} == {0}


def test_empty_table(docs):
    assert near_dup.near_duplicates(docs.where("false")).collect() == []
    assert near_dup.keep_one_of_each(docs.where("false")).count() == 0


def test_shingles_of_short_texts():
    row, h, n = near_dup.shingles(words.Words(pa.array(["a b", "A, b", "", "a b c d e a b c d e"]), lower=True))
    assert row.tolist()[:2] == [0, 1] and h[0] == h[1] and n[row == 3].max() == 2


def test_link_inside_a_large_family(spark):
    """Pages that share a passage, none similar enough to another, but for one pair in each family."""
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 2**40, n)]
    texts = []
    for _ in range(3):
        passage = word(104)
        texts += [" ".join(passage + word(tail)) for tail in [14] * 300 + [12] * 2]
    x, y, page = (shingle_counts(texts[i]) for i in (300, 301, 0))
    assert sim(x, y) >= 0.8 and max(sim(x, page), sim(y, page)) < 0.8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    assert {i: c for i, c in got.items() if i != c} == {301: 300, 603: 602, 905: 904}


def test_open_pairs_miss_no_link(spark):
    """Texts of a few common lines, repeated or not, with own words: every similar pair is among the pairs."""
    rng = np.random.default_rng(6)
    lines = [" ".join(f"l{i}w{j}" for j in range(9)) for i in range(12)]
    texts = []
    for i in range(120):
        own = " ".join(f"t{i}w{j}" for j in range(rng.integers(0, 10)))
        texts.append(" ".join([lines[k] for k in np.sort(rng.choice(12, 10, replace=False)) for _ in range(1 + 3 * (rng.random() < 0.1))] + [own]))
    _, links = brute_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sets = stage(spark, df.mapInArrow(near_dup._sets, near_dup.SETS), "test-sets")
    label = df.select("node", F.col("node").alias("label")).where("false")
    got = {(texts[r["a"]], texts[r["b"]]) for r in near_dup.open_pairs(spark, sets, label).collect()}
    assert len(links) > 20 and links <= got and len(got) < 120 * 119 / 2


def test_a_family_just_below_the_similarity_gives_few_pairs(spark, monkeypatch):
    """Edited copies of one text, each a link apart from the original and too far from one another; a few are links."""
    monkeypatch.setattr(near_dup, "PART_ROWS", 50)           # shingles of many texts are joined in parts
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(300):
        at = rng.choice(30, 4, replace=False) * 5
        texts.append(" ".join(f"e{i}x{j}" if j in at else w for j, w in enumerate(base)))
    texts += [t + " z" for t in texts[:20]]
    own = [set(shingle_counts(t)) for t in texts]                # no shingle is repeated: both similarities are the same
    links = {(texts[i], texts[j]) for i, j in combinations(range(len(texts)), 2) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])}
    assert links
    df = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sets = stage(spark, df.mapInArrow(near_dup._sets, near_dup.SETS), "test-sets")
    label = df.select("node", F.col("node").alias("label")).where("false")
    got = {(texts[r["a"]], texts[r["b"]]) for r in near_dup.open_pairs(spark, sets, label).collect()}
    assert links <= got and len(got) < 320 * 319 / 2 / 4


def test_repeated_shingles_hide_no_plain_link():
    """A page with a repeated menu and the clean page share a band, whatever the words."""
    rng = np.random.default_rng(7)
    lost = 0
    for _ in range(100):
        shared, one, two = ([f"w{i}" for i in rng.integers(0, 2**40, n)] for n in (104, 4, 12))
        clean, menu = " ".join(shared + two), " ".join(shared + (shared[:54] * 20)[:-4] + one)
        x, y = shingle_counts(clean), shingle_counts(menu)
        assert len({*x} & {*y}) / len({*x} | {*y}) >= 0.8 > weighted(x, y)
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "node": [1, 2], "text": [clean, menu]})
        a, b = next(near_dup._bands([batch])).column("bands").to_pylist()
        assert len(a) == near_dup.BANDS and len(b) == len({*b}) > near_dup.BANDS
        lost += not {*a} & {*b}
    assert not lost


def test_memory_of_the_band_pass_follows_bytes_not_rows():
    code = """
import resource, sys
sys.path.insert(0, {root!r})
import pyarrow as pa
from lakepipe.llm import near_dup
batch = lambda n: pa.RecordBatch.from_arrays(
    [pa.array(range(n)), pa.array([" ".join(f"w{{i * 17 + k}}" for k in range(14)) for i in range(n)]), pa.array(range(n))],
    names=["doc_id", "text", "node"])
list(near_dup._bands([batch(near_dup.SIGNED_ROWS)]))
few = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert sum(x.num_rows for x in near_dup._bands([batch(10_000)])) == 10_000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - few) // 1024)
""".format(root=str(Path(__file__).resolve().parents[2]))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 200      # MB
