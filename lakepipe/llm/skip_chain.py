"""Personal data (12): a skip-chain conditional random field over each document.

Base spans are found by the rules of op12's contract.  The method labels the
tokens around them: tokens (runs without whitespace) that hold a digit or an
at sign can be an email, ip, card or phone; all others are none of these.  A
token has potentials from its shape and its neighbours' shape, neighbouring
tokens share transition potentials, and distant tokens that are repeated or
similar (equal but for outer marks, the same last seven digits, the local part
of an address) are joined by skip edges that reward equal labels; each
occurrence is joined to the next one, so edges grow with the tokens.  Tokens of
base spans are clamped to their kind; loopy message passing gives the others'
marginals.  Runs of tokens of one kind with a marginal of ``ADD_AT`` or more,
and the digits that the kind needs, are added as spans; base spans stay.

The weights are trained by pseudo-likelihood on a bounded sample:
``TRAIN_DOCS`` documents (by hash) of at most ``TRAIN_CHARS`` characters that
hold a digit or an at sign, ``TRAIN_TOKENS`` tokens of each; labels are those
of the base rules.  Every token is also shown a second time without its shape,
joined to itself by a skip edge, so the weight of a repetition is learned.

Defined results: null texts are empty; repeated rows get equal results; without
a base span in the sample nothing is added; an empty table gives an empty
result.  Positions are code points.  Whole texts are scanned, each pattern in
time linear in the text; memory grows by some 500 bytes for each token that
holds a digit or an at sign.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm.words import slices

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
#: Marginal from which a token is labelled.
ADD_AT = 0.75
#: Digits that an added span of a kind needs at least.
ADDED_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 7}
TRAIN_DOCS, TRAIN_CHARS, TRAIN_TOKENS = 1000, 20_000, 100
TRAIN_STEPS, RATE, DECAY = 400, 0.1, 0.002
MOST_ROUNDS, SETTLED = 40, 1e-3

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits that fails at its start fails at its other places too.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SOME = re.compile("[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules, by kind and start."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            out.append((0, start, done))
        at = text.find("@", done)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


SHAPES = ["bias", "at", "plus", "bracket", "dash", "dots", "letter", "digits1", "digits4", "digits7", "digits9", "digits13", "digits20",
          "quad", "luhn", "local", "marks", "plus before", "bracket before", "bracket after", "dash after", "echo"]
N_SHAPES, N_LABELS = len(SHAPES), len(LABELS)
ECHO = N_SHAPES - 1
DIGIT_STEPS = [1, 4, 7, 9, 13, 20]
QUAD = re.compile(r"\D*\d{1,3}(?:\.\d{1,3}){3}\D*", re.ASCII)
LOCAL_SHAPE = re.compile(r"\W*[A-Za-z]+[._][A-Za-z0-9._]*[0-9]\W*", re.ASCII)


def _shape(token: str) -> list[float]:
    x = [0.0] * N_SHAPES
    x[0] = 1.0
    x[1], x[2] = "@" in token, token.startswith("+")
    x[3], x[4] = "(" in token or ")" in token, "-" in token
    x[5], x[6] = "." in token[1:-1], any(c.isalpha() for c in token)
    d = _digits(token)
    step = int(np.searchsorted(DIGIT_STEPS, len(d), side="right"))
    if step:
        x[6 + step] = 1.0
    x[13] = QUAD.fullmatch(token) is not None
    x[14] = 13 <= len(d) <= 19 and luhn(d)
    x[15] = LOCAL_SHAPE.fullmatch(token) is not None
    x[16] = any(c in "=:\"'/_" for c in token)
    return x


def _keys(token: str) -> set[str]:
    """Tokens of one document that share a key are joined by a skip edge."""
    core = re.sub(r"^\W+|\W+$", "", token).lower()
    keys = set()
    if len(core) >= 4:
        keys.add(core)
    local = core.partition("@")[0]
    if "@" in core and len(local) >= 4:
        keys.add(local)
    d = _digits(token)
    if len(d) >= 7:
        keys.add("#" + d[-7:])
    return keys


class Graph:
    """Tokens of several documents: shapes, base labels, chain and skip edges."""

    def __init__(self):
        self.shapes, self.base, self.doc, self.start, self.end = [], [], [], [], []
        self.chain, self.skip = [], []
        self.alone_left, self.alone_right = [], []

    def add(self, doc: int, text: str, spans: list[tuple[int, int, int]], most: int | None = None) -> None:
        owner = sorted((a, b, k) for k, a, b in spans)
        reach = np.maximum.accumulate([b for _, b, _ in owner]) if owner else []
        last, before, keyed = -2, None, defaultdict(list)
        first = len(self.shapes)
        for place, m in enumerate(TOKEN.finditer(text)):
            token, me = m[0], len(self.shapes)
            if not SOME.search(token):
                continue
            if most is not None and me - first >= most:
                break
            x = _shape(token)
            joined = last == place - 1
            if joined:
                x[17], x[18] = before[2], before[3]
                before[19], before[20] = x[3], x[4]
                self.chain.append((me - 1, me))
                self.alone_right[-1] = False
            label = 0
            i = int(np.searchsorted(reach, m.start(), side="right")) if len(owner) else 0
            while i < len(owner) and owner[i][0] < m.end():
                if owner[i][1] > m.start():
                    label = min(label or N_LABELS, owner[i][2] + 1)
                i += 1
            for key in _keys(token):
                if keyed[key]:
                    self.skip.append((keyed[key][-1], me))
                keyed[key].append(me)
            self.shapes.append(x)
            self.base.append(label)
            self.doc.append(doc)
            self.start.append(m.start())
            self.end.append(m.end())
            self.alone_left.append(not joined)
            self.alone_right.append(True)
            last, before = place, x

    def arrays(self):
        pairs = lambda x: np.array(sorted(set(x)), dtype=np.int64).reshape(-1, 2)
        return (np.array(self.shapes, dtype=np.float32).reshape(-1, N_SHAPES), np.array(self.base, dtype=np.int64),
                pairs(self.chain), pairs(self.skip))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _total(z: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exp along an axis"""
    top = z.max(axis=axis, keepdims=True)
    return np.log(np.exp(z - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(unary: np.ndarray, edges: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Loopy sum-product: the labels' marginals of each node; ``potential[e, x, y]`` of edge (a, b) is a log weight."""
    a, b = edges[:, 0], edges[:, 1]
    there, back = np.zeros((len(edges), unary.shape[1])), np.zeros((len(edges), unary.shape[1]))
    belief = unary.astype(float)
    for _ in range(MOST_ROUNDS if len(edges) else 0):
        new_there = _total((belief[a] - back)[:, :, None] + potential, 1)
        new_back = _total((belief[b] - there)[:, None, :] + potential, 2)
        new_there -= new_there.max(axis=1, keepdims=True)
        new_back -= new_back.max(axis=1, keepdims=True)
        moved = max(np.abs(new_there - there).max(), np.abs(new_back - back).max())
        there, back = new_there, new_back
        belief = unary.astype(float)
        np.add.at(belief, b, there)
        np.add.at(belief, a, back)
        if moved < SETTLED:
            break
    return _softmax(belief)


class Weights:
    """Shape weights, transitions, and the reward of equal labels at a skip edge (none, one of the kinds)."""

    def __init__(self):
        self.shape, self.step, self.same = np.zeros((N_SHAPES, N_LABELS)), np.zeros((N_LABELS, N_LABELS)), np.zeros(2)

    def skip(self) -> np.ndarray:
        return np.diag([self.same[0], *[self.same[1]] * len(KINDS)])


def train(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> Weights:
    """Pseudo-likelihood of each token's label given its neighbours' labels (``linked``: labels at its skip edges, counted)."""
    w = Weights()
    goal = np.eye(N_LABELS)[y]
    lefts, rights = np.eye(N_LABELS)[left], np.eye(N_LABELS)[right]
    parts = [w.shape, w.step, w.same]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for t in range(1, TRAIN_STEPS + 1):
        off = (_softmax(x @ w.shape + lefts @ w.step + rights @ w.step.T + linked @ w.skip()) - goal) / len(y)
        reward = linked * off
        slope = [x.T @ off, lefts.T @ off + off.T @ rights, np.array([reward[:, 0].sum(), reward[:, 1:].sum()])]
        for p, g, m, v in zip(parts, slope, first, second, strict=True):
            g = g + DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _examples(batches):
    for batch in batches:
        for part in slices(batch):
            graph = Graph()
            for i, text in enumerate(part.column("text").to_pylist()):
                graph.add(i, text, base_spans(text), TRAIN_TOKENS)
            x, y, chain, skip = graph.arrays()
            left, right = np.zeros(len(y), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
            left[chain[:, 1]], right[chain[:, 0]] = y[chain[:, 0]], y[chain[:, 1]]
            linked = np.zeros((len(y), N_LABELS), dtype=np.float32)
            np.add.at(linked, (skip[:, 0], y[skip[:, 1]]), 1)
            np.add.at(linked, (skip[:, 1], y[skip[:, 0]]), 1)
            floats = lambda z: pa.array(list(z.astype(np.float32)), type=pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([floats(x), pa.array(y), pa.array(left), pa.array(right), floats(linked)],
                                             names=["x", "y", "l", "r", "linked"])


def trained(docs: DataFrame) -> Weights | None:
    """Weights from the documented sample; None if no base span is in it."""
    some = docs.where((F.length("text") <= TRAIN_CHARS) & F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    # the lowest hashes first, so that only the sample's texts move, each of them once
    last = some.select("h").distinct().orderBy("h").limit(TRAIN_DOCS).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return None
    sample = some.where(F.col("h") <= last).dropDuplicates(["h"]).select("text")
    got = sample.mapInArrow(_examples, "x array<float>, y long, l long, r long, linked array<float>").toArrow()
    y = got.column("y").to_numpy()
    if not y.any():
        return None
    matrix = lambda c, n: got.column(c).combine_chunks().flatten().to_numpy().reshape(-1, n).astype(float)
    x, linked = matrix("x", N_SHAPES), matrix("linked", N_LABELS)
    order = np.lexsort([y, *x.T])                    # rows come in any order: one order gives one sum
    x, y, linked = x[order], y[order], linked[order]
    left, right = got.column("l").to_numpy()[order], got.column("r").to_numpy()[order]
    echo = np.zeros_like(x)
    echo[:, ECHO] = 1
    none = np.zeros(len(y), dtype=np.int64)
    return train(np.concatenate([x, echo]), np.concatenate([y, y]), np.concatenate([left, none]),
                 np.concatenate([right, none]), np.concatenate([linked, np.eye(N_LABELS)[y]]))


def added_spans(graph: Graph, weights: Weights, texts: dict[int, str]) -> dict[int, list[tuple[int, int, int]]]:
    """(kind, start, end) that the random field adds, by document."""
    x, base, chain, skip = graph.arrays()
    unary = x @ weights.shape
    unary += np.array(graph.alone_left)[:, None] * weights.step[0] + np.array(graph.alone_right)[:, None] * weights.step[:, 0]
    known = base > 0
    unary[known] = np.where(np.arange(N_LABELS) == base[known][:, None], 0, -60)
    edges = np.concatenate([chain, skip])
    potential = np.concatenate([np.broadcast_to(weights.step, (len(chain), N_LABELS, N_LABELS)),
                                np.broadcast_to(weights.skip(), (len(skip), N_LABELS, N_LABELS))])
    got = marginals(unary, edges, potential)
    label = np.where((got.max(axis=1) >= ADD_AT) & ~known, got.argmax(axis=1), 0)
    joined = np.zeros(len(label), dtype=bool)
    joined[chain[:, 1]] = label[chain[:, 1]] == label[chain[:, 0]]
    out = defaultdict(list)
    for i in np.flatnonzero((label > 0) & ~joined):
        j = i + 1
        while j < len(label) and joined[j]:
            j += 1
        text, kind = texts[graph.doc[i]], int(label[i]) - 1
        a, b = graph.start[i], graph.end[j - 1]
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and len(_digits(text[a:b])) >= ADDED_DIGITS[KINDS[kind]]:
            out[graph.doc[i]].append((kind, a, b))
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _found(weights: Weights | None):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                base, graph, texts = {}, Graph(), {}
                for i, text in enumerate(part.column("text").to_pylist()):
                    if text and SOME.search(text):
                        base[i] = base_spans(text)
                        if weights is not None:
                            graph.add(i, text, base[i])
                            texts[i] = text
                more = added_spans(graph, weights, texts) if graph.shapes else {}
                counts, names, spans = np.zeros((len(KINDS), part.num_rows), dtype=np.int64), [EMPTY] * part.num_rows, [""] * part.num_rows
                for i, found in base.items():
                    for k, _, _ in found:
                        counts[k, i] += 1
                    if found or i in more:
                        names[i] = hashlib.sha256(_joined(found).encode()).hexdigest()
                        spans[i] = _joined(found + more.get(i, []))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c) for c in counts], pa.array(names), pa.array(spans)],
                    names=[c.split()[0] for c in FOUND.split(", ")])
    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document (see the contract of op12)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_found(trained(texts)), FOUND)
