"""Personal data (12) against plain regular expressions; message passing against all labellings."""
import hashlib
import itertools
import random
import re
import time
from collections import Counter

import corpus
import numpy as np
import pytest

from lakepipe.llm import skip_chain as sc

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = [int(c) for c in re.findall("[0-9]", m[0])]
            double = sum(d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(reversed(digits)))
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and double % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def texts():
    rng = random.Random(2)
    bits = ["a@b.co", "x.y%z+1@mail-1.example.com", "@", "@@", "a@b", "a@b@c.de", "a@b.com_x@c.de", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1",
            "01.002.3.0255", "4111 1111-1111 1111", "4111111111111111", "4111111111111112", "4111 1111 1111 1111 4111 1111 1111 1111", "5" * 60,
            "+1 (988) 555-2485", "+49.30.1234567", "+1", "+1+2 345 678 901 ", "+1 ((((", "988 555-2485", "é", "日本", "\n", "word", "9.", "ab12cd", " ", "+4111111111111111",
            "john.smith.42@mail.example.com", "john.smith.42", "(988)", "555-2485", "٣.٤.٥.٦", "a..b@c..d.e"]
    out = ["".join(rng.choice([" ", "", " ", ", "]) + rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(500)]
    out += [None, "", "no digits here", "7" * 3000, "x" * 3000 + "@", "1." * 2000, "+1" + " " * 3000, "a@" * 2000, "12 " * 2000]
    return out


@pytest.fixture(scope="module")
def rows():
    made = [(i, t, "en", "hot", 1, *["z"] * 8) for i, t in enumerate(texts())]
    return made + [(None, made[3][1], *made[3][2:])] + [made[4]] * 5 + [(None, None, *made[0][2:])]


@pytest.fixture(scope="module")
def found(spark, rows, tmp_path_factory):
    docs = corpus.stored(spark, spark.createDataFrame(rows, corpus.SCHEMA).repartition(3), tmp_path_factory.mktemp("d"))
    return sc.personal_data(docs.withColumnRenamed("lang", "spans").withColumnRenamed("slot", "n_ip")).collect()


def test_base_spans(rows, found):
    want = Counter()
    for i, t, *_ in rows:
        spans = plain_spans(t)
        n = Counter(k for k, _, _ in spans)
        name = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want[i, *[n[k] for k in RULES], name] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found) == want


def test_rules_are_linear_in_a_long_text():
    began = time.perf_counter()
    for t in ("7" * 400_000, "x" * 400_000 + "@", "1." * 200_000, "+1" + " " * 400_000, "a@" * 200_000, "1 " * 200_000, "a." * 200_000 + "@b"):
        sc.base_spans(t)
    assert time.perf_counter() - began < 10


def test_spans_keep_the_base_and_stay_apart(rows, found):
    text = {i: t for i, t, *_ in rows if i is not None}
    more = 0
    for r in found:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        spans = [(k, int(a), int(b)) for k, a, b in spans]
        if r["doc_id"] is None:
            continue
        base = plain_spans(text[r["doc_id"]])
        assert set(base) <= set(spans) and len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda s: ([*RULES].index(s[0]), s[1]))
        for k, a, b in set(spans) - set(base):
            more += 1
            assert all(b <= x or y <= a for _, x, y in base)
            assert len(re.findall("[0-9]", text[r["doc_id"]][a:b])) >= sc.ADDED_DIGITS[k]
    assert more > 10


def test_repeated_mentions_follow_the_first(spark):
    """A mention that no rule fits is labelled because a distant similar token is."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    some = [" ".join([*[word() for _ in range(20)], "+1 " + phone(), word(), f"{word()}.{rng.randrange(99):02}@mail.example.com", word(),
                      f"v{rng.randrange(99)}.{rng.randrange(9)}", word(), f"{rng.randrange(9999)}", word()]) for _ in range(300)]
    some += ["write to anna.weber.17@mail.example.com " + "word " * 40 + "or as anna.weber.17 there", "page 1234 of 5678, version 2.0 of 1999"]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in sc.personal_data(docs).collect()}
    a = some[300].index("anna.weber.17 there")
    assert got[300] == f"email:9:39,email:{a}:{a + 13}"
    assert got[301] == ""
    assert all(got[i].count(",") == 1 for i in range(300))


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(1)
    n, k = 6, 3
    unary, edges = rng.normal(size=(n, k)), np.array([[0, 1], [1, 2], [3, 1], [4, 3], [4, 5]])
    potential = rng.normal(size=(len(edges), k, k))
    want = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        p = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(potential[e, y[a], y[b]] for e, (a, b) in enumerate(edges)))
        for i in range(n):
            want[i, y[i]] += p
    assert np.allclose(sc.marginals(unary, edges, potential), want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_message_passing_on_a_loop_agrees_with_all_labellings():
    unary = np.array([[0.0, 2.0], [0.3, 0.0], [0.5, 0.0], [0.4, 0.0]])
    edges = np.array([[0, 1], [1, 2], [2, 3], [0, 3]])
    potential = np.broadcast_to(np.diag([0.5, 1.5]), (4, 2, 2))
    want = np.zeros((4, 2))
    for y in itertools.product(range(2), repeat=4):
        p = np.exp(sum(unary[i, y[i]] for i in range(4)) + sum(potential[e][y[a], y[b]] for e, (a, b) in enumerate(edges)))
        for i in range(4):
            want[i, y[i]] += p
    got = sc.marginals(unary, edges, potential)
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all() and np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=0.1)


def test_nothing_to_train_on(spark):
    docs = spark.createDataFrame([(1, "a 12 b"), (2, None), (3, "call 555-2485")], "doc_id long, text string")
    assert [r["spans"] for r in sc.personal_data(docs).collect()] == ["", "", ""]
    assert sc.personal_data(docs.where("false")).count() == 0
