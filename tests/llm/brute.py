"""Plain Python versions of the operators' results, for small tables."""
from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {i: i + 32 for i in range(65, 91)}


def plain(text):
    return PLAIN.findall(text or "")


def letters(text):
    return LETTERS.findall((text or "").translate(AZ))


def quality(text):
    text = text or ""
    w = plain(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if plain(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside),
            len(w) < 20 or 100 * len(inside) > 30 * len(w))


def cover(text, n):
    w = plain(text)
    grams = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    inside = {j for i in range(len(w) - n + 1) if grams[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
    return sum(len(w[j]) for j in inside) / max(1, sum(map(len, w)))


def contamination(texts, items, window=13):
    """texts: list; items: list of (id, text)."""
    grams = defaultdict(set)
    for item, text in items:
        w = letters(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams[tuple(w[i:i + window])].add(item)
    lengths = sorted({len(g) for g in grams})
    out = []
    for text in texts:
        w, hit, found = letters(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        names = sorted(str(x) for x in found)
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def repeats(texts, window=35):
    starts = Counter(tuple(w[i:i + window]) for w in map(plain, texts) for i in range(len(w) - window + 1))
    out = []
    for text in texts:
        w = plain(text)
        gone = {j for i in range(len(w) - window + 1) if starts[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
