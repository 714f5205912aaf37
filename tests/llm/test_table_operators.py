"""Operators that work on rows of tables (1, 3, 5, 10), against brute force."""
import re
import zlib
from collections import Counter, defaultdict

import brute
import corpus
import pytest

from lakepipe.llm import frames, mix_blocks, revisits, slots, url_trees


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return corpus.stored(spark, corpus.documents(spark), tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


# ------------------------------------------------------------ 1: URL filters

URLS = [
    "http://a.com/x/1", "http://example.com/en/1?q=1", "https://WWW.Example.com/en/2", "https://www.example.com/de/2",
    "http://m.www.example.com/en/", "http://x.example.com/en/7#top", "http://notexample.com/en/1", "http://foo.net/es/1",
    "http://foo.net/fr/1", "http://net/es/", "http://foo.net/de/1", "http://foo.org/en/1", "no scheme.com/en/", None, "", "://", "http://",
    "http://a.com", "http://a.com?x=/", "HTTP://B.COM/%20/x?a=1&b=2", "a://b://c.com/x", "http://ÄB.com/Ü", "http://x.net/es", "http://x.org/\n/a",
]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(brute.AZ)
    fits = []
    for rule in url_trees.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", 1.0, "x", "y") for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, score double, label string, suffix string")


def test_url_rules(spark):
    got = {r["page_id"]: r for r in url_trees.judge_urls(pages(spark, URLS + URLS[:3])).collect()}
    assert len(got) == len(URLS) + 3
    for i, url in enumerate(URLS + URLS[:3]):
        host, path, rule = brute_url(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] in ("allow", "block") and 0 <= got[i]["score"] <= 1
        if rule:
            assert got[i]["verdict"] == url_trees.RULES[rule]


def test_url_trees_learn_from_lexical_features(spark):
    """Long digit-rich hosts are blocked by a rule on one domain; the like elsewhere should be too."""
    rules = {"good.example/": "allow", "bad.example/": "block"}
    urls = [f"http://site{i}.good.example/page" for i in range(60)] + [f"http://{i * 7919}{i * 104729}.bad.example/a/b/{i}?x={i}&y=2" for i in range(60)]
    other = [f"http://name{i}.other.org/page" for i in range(20)] + [f"http://{i * 6007}{i * 99991}.some.org/a/b/{i}?x={i}&y=3" for i in range(1, 21)]
    got = {r["page_id"]: r["verdict"] for r in url_trees.judge_urls(pages(spark, urls + other), rules).collect()}
    verdicts = [got[i] for i in range(120, 160)]
    assert Counter(verdicts[:20])["allow"] >= 18 and Counter(verdicts[20:])["block"] >= 18
    again = {r["page_id"]: r["verdict"] for r in url_trees.judge_urls(pages(spark, urls + other), rules, train_rows=80).collect()}
    assert sum(again[i] == v for i, v in got.items()) >= 150


def test_urls_without_both_verdicts(spark):
    assert {r["verdict"] for r in url_trees.judge_urls(pages(spark, ["http://a.com/", "http://b.org/", None])).collect()} == {"allow"}
    assert {r["verdict"] for r in url_trees.judge_urls(pages(spark, ["http://a.net/es/", "http://b.org/"])).collect()} == {"block"}
    assert url_trees.judge_urls(pages(spark, URLS).where("false")).collect() == []


def test_entropy(spark):
    import math
    from pyspark.sql import functions as F
    for t, want in (("aab", -(2 / 3) * math.log2(2 / 3) - (1 / 3) * math.log2(1 / 3)), ("", 0.0), ("zz", 0.0), ("a.b/", 2.0)):
        got = spark.createDataFrame([(t,)], "t string").select(url_trees._entropy(F.col("t"))).first()[0]
        assert got == pytest.approx(want)


# --------------------------------------------------------------- 3: sharding

def test_shards(docs, rows):
    got = slots.shard_rows(docs).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == \
        Counter((r["doc_id"], size(r["text"]), zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)
    places, held, by_slot = defaultdict(list), [0] * 24, defaultdict(int)
    for r in got:
        places[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
        by_slot[r["virtual_slot"]] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(held) - min(held) <= max(by_slot.values())
    assert Counter((r["doc_id"], r["shard"]) for r in got) == Counter((r["doc_id"], r["shard"]) for r in slots.shard_rows(docs).collect())


def test_map_versions_and_rebalancing(spark, tmp_path):
    held = [(i * 37) % 101 + 1 for i in range(512)]
    first = slots.deal(held, 8)
    load = lambda m, n: [sum(b for b, s in zip(held, m, strict=True) if s == k) for k in range(n)]
    assert max(load(first, 8)) - min(load(first, 8)) <= max(held)
    held[5] += 900
    held[77] += 500
    edited = slots.rebalance(held, first, 8)
    assert max(load(edited, 8)) - min(load(edited, 8)) < max(load(first, 8)) - min(load(first, 8))
    assert sum(a != b for a, b in zip(first, edited, strict=True)) < 60
    more = slots.rebalance(held, edited, 9)
    assert min(load(more, 9)) > 0.8 * sum(held) / 9
    assert sum(a != b for a, b in zip(edited, more, strict=True)) < 512 / 4
    fewer = slots.rebalance(held, more, 6)
    assert set(fewer) == set(range(6))
    path = f"file://{tmp_path}/map"
    slots.write_map(spark, path, 1, first)
    slots.write_map(spark, path, 2, edited)
    assert slots.read_map(spark, path) == (2, edited) and slots.read_map(spark, path, 1) == (1, first)


def test_documents_with_shards(docs, rows):
    got = slots.with_shards(docs)
    assert set(got.columns) == {*docs.columns, "shard", "virtual_slot"}
    want = Counter((r["doc_id"], r["size"], r["shard"]) for r in slots.shard_rows(docs).collect())
    assert Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, r["shard"]) for r in got.collect()) == want
    assert slots.shard_rows(docs.where("false")).collect() == [] and slots.with_shards(docs.where("false")).collect() == []


# ---------------------------------------------------------------- 5: revisits

def brute_revisits(records):
    out = []
    for r in records:
        if r["kind"] != "revisit":
            continue
        earlier = [x for x in records if x["kind"] == "response" and x["canon"] is not None and x["canon"] == r["canon"]
                   and x["time"] is not None and r["time"] is not None and x["time"] < r["time"]]
        best = max(earlier, key=lambda x: (x["time"], x["record_id"]), default=None)
        plain = lambda t: re.sub(r'^"|"$', "", re.sub("^W/", "", t)) if t is not None else None
        if best is None:
            verdict = "missing"
        elif r["etag"] is not None:
            verdict = "resolved" if plain(r["etag"]) == plain(best["etag"]) else "changed"
        elif r["last_modified"] is not None:
            verdict = "resolved" if r["last_modified"] == best["last_modified"] else "changed"
        else:
            verdict = "resolved"
        merged = None
        if verdict == "resolved":
            new = {h["name"].lower() for h in r["headers"] or [] if h["name"].lower() in revisits.PERMITTED}
            merged = sorted([(h["name"], h["value"]) for h in best["headers"] if h["name"].lower() not in new]
                            + [(h["name"], h["value"]) for h in r["headers"] or [] if h["name"].lower() in new])
        out.append((r["record_id"], best["record_id"] if verdict == "resolved" else None, verdict, merged))
    return sorted(out, key=str)


def test_revisits(spark):
    import random
    rng = random.Random(8)
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit"])
        url = rng.choice(["http://a.com/", "https://www.A.com", "http://a.com:80/#x", "http://b.com/p?utm_source=f", "http://b.com/p",
                          "http://b.com/p?q=1", None, f"http://c{i % 9}.org/"])
        rows.append((i, kind, url, rng.choice([None, *range(0, 200000, 9000)]), rng.choice([None, '"t1"', 'W/"t1"', '"t2"']),
                     rng.choice([None, 1, 2]), [("Date", str(i)), ("Set-Cookie", "c"), ("ETag", "e")][: rng.randrange(4)], "extra"))
    rows += rows[:40]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, time long, etag string, last_modified long, "
                                     "headers array<struct<name:string,value:string>>, span string")
    canon = {r["record_id"]: r["c"] for r in df.select("record_id", revisits.canonical_url(df["url"]).alias("c")).collect()}
    assert {canon[r[0]] for r in rows if r[2] and "a.com" in r[2].lower()} == {"a.com"}
    assert {canon[r[0]] for r in rows if r[2] and r[2].startswith("http://b.com/p")} == {"b.com/p", "b.com/p?q=1"}
    records = [r.asDict(True) | {"canon": canon[r["record_id"]]} for r in df.collect()]
    for span in (3600, 100000, 10**9):
        got = [(r["record_id"], r["response_id"], r["verdict"],
                None if r["headers"] is None else sorted((h["name"], h["value"]) for h in r["headers"]))
               for r in revisits.resolve_revisits(df, span).collect()]
        assert sorted(got, key=str) == brute_revisits(records)
    assert {v for _, _, v, _ in brute_revisits(records)} == {"resolved", "changed", "missing"}
    assert revisits.resolve_revisits(df.where("false")).collect() == []


# ------------------------------------------------------------------ 10: mixing

def brute_targets(sizes):
    """Share by weight, stop at three times the source, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, left = {}, dict.fromkeys(names)
    while left:
        rest = sum(sizes.values()) - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] >= 3 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 3 * sizes[s]
            del left[s]
    return full


@pytest.mark.parametrize("broadcast", [True, False])
def test_mixture(docs, rows, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(mix_blocks, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(mix_blocks, "CHUNK", 7)
    got = mix_blocks.mixture(docs).collect()
    words = [len(brute.plain(r["text"])) for r in rows]
    sizes = Counter()
    for r, n in zip(rows, words, strict=True):
        sizes[r["source"]] += n
    want = brute_targets(dict(sizes))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], n) for r, n in zip(rows, words, strict=True))
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    ids = {r["doc_id"]: r["source"] for r in rows if r["doc_id"] not in (None, 5, 0)}
    by_size = {}
    for r in got:
        by_size.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
        if r["doc_id"] in ids:
            source = ids[r["doc_id"]]
            assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
    assert sum(t for _, t in by_size) == pytest.approx(sum(words))
    for (_, target), taken in by_size.items():
        assert abs(sum(taken) - target) <= 0.03 * target + mix_blocks.BLOCK_WORDS
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix_blocks.mixture(docs).collect()))


def test_mixed_documents(docs, rows):
    distinct = docs.dropDuplicates(["doc_id", "text"])
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in mix_blocks.mixture(distinct).collect()}
    out = mix_blocks.mixed_documents(distinct)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    texts = {(r["doc_id"], len(brute.plain(r["text"]))): r["text"] for r in distinct.collect()}
    words = Counter()
    for r in out.collect():
        key = next(k for k in texts if k[0] == r["doc_id"] and texts[k] and set(brute.plain(r["text"])) <= set(brute.plain(texts[k])))
        words[key] += len(brute.plain(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert words == Counter({k: n for k, n in taken.items() if n})
    assert mix_blocks.mixed_documents(docs).count() >= out.count() - 8
    empty = docs.where("false")
    assert mix_blocks.mixture(empty).collect() == [] and mix_blocks.mixed_documents(empty).collect() == []


def test_slots_permute_blocks(spark):
    sources = spark.createDataFrame([(0, 10, 30), (1, 7, 3), (2, 0, 0), (3, 1000, 1500)], "number int, blocks long, slots long")
    got = mix_blocks.slots(sources).collect()
    times = Counter((r["number"], r["block"]) for r in got)
    assert Counter(r["number"] for r in got) == {0: 30, 1: 3, 3: 1500}
    assert {times[0, b] for b in range(10)} == {3} and {times[3, b] for b in range(1000)} == {1, 2}
    assert len({r["shard"] for r in got}) > 100 and frames.BROADCAST_BYTES > 0


def test_mixed_rows_keep_their_own_source(spark, tmp_path):
    """Rows equal in id and text but not in source are two documents, each mixed with its source and columns."""
    text = " ".join(f"w{i}" for i in range(300))
    made = [(1, text, "a", "en"), (1, text, "b", "de"), (1, text, "b", "de"), (2, text + " z", None, "fr")]
    docs = corpus.stored(spark, spark.createDataFrame(made, "doc_id long, text string, source string, lang string"), tmp_path)
    got = Counter((r["doc_id"], r["source"], r["lang"]) for r in mix_blocks.mixed_documents(docs).collect())
    assert set(got) == {(1, "a", "en"), (1, "b", "de"), (2, None, "fr")}
    words = Counter()
    for r in mix_blocks.mixed_documents(docs).collect():
        words[r["source"]] += len(brute.plain(r["text"]))
    taken = Counter()
    for r, source in zip(mix_blocks.mixture(docs).orderBy("doc_id", "source_size").collect(), ["a", "b", "b", None], strict=True):
        taken[source] += r["taken"]
    assert words == taken
