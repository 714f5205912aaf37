"""Small made-up tables with awkward rows: nulls, empty and long texts, copies, repeated rows, clashing column names."""
from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "text_hash string, node string, row string, label string, shard string, size string, _id string, slot string")
BENCH = "item_id long, text string, label string, text_hash string"


def prose(rng, n, vocabulary=4000):
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    for i in range(0, n, 11):
        words[i] = words[i].capitalize() + rng.choice([".", ",", "\n", "é!", ""])
    return " ".join(words)


def edited(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def benchmark_rows():
    rng = random.Random(5)
    rows = [(i, prose(rng, 30)) for i in range(20)]
    rows += [(20, "solo phrase"), (21, None), (22, ""), (23, rows[0][1]), (20, "solo phrase")]
    return [(i, t, "x", "y") for i, t in rows]


def texts(seed=3):
    rng = random.Random(seed)
    items = [t for _, t, *_ in benchmark_rows() if t]
    out = [prose(rng, rng.choice([5, 30, 120, 400])) for _ in range(60)]
    base = prose(rng, 300)
    out += [base] * 12 + [edited(rng, base, 0.01) for _ in range(10)]          # copies and near copies
    passage = prose(rng, 60)
    out += [prose(rng, 40) + " " + passage + "\n" + prose(rng, 50) for _ in range(15)]
    out += [prose(rng, 50) + " " + items[i].upper() + " " + prose(rng, 20) for i in range(6)]
    out += ["Solo phrase!", "say solo, phrase again and again", prose(rng, 600) + " " + items[3]]
    out += [None, "", " \t\n", None, "one", "a b c d", "A b, c D", "a b c d e", " ", "naïve café über", "x" * 5000]
    out += ["same " * 300, "lorem ipsum\n" * 80, prose(rng, 20) + "\r\n" + "tick tock " * 90]
    out += [prose(rng, 20000)]                                                 # very long
    out += ["Released under the MIT License.\n" + prose(rng, 40),
            "Licensed under the Apache License, Version 2.0. " + prose(rng, 30),
            prose(rng, 10) + " This work is licensed under the GNU General Public License, version 3. " + prose(rng, 10)
            + " Licensed under CC BY-NC 4.0.", "MIT License MIT license, the Apache License"]
    return out


def document_rows():
    rng = random.Random(9)
    rows = []
    for i, t in enumerate(texts()):
        source = None if i % 17 == 0 else "hot" if i % 3 == 0 else rng.choice(["a", "b", "ü", ""])
        rows.append((i, t, "en", source, len(t) if t is not None else None, *["z"] * 8))
    rows += [(None, rows[1][1], None, None, None, *[None] * 8)] * 2             # null ids, equal rows
    rows += [rows[0]] * 3                                                      # a row four times
    rows += [(5, "another text of a known id " * 4, "en", "hot", 0, *["z"] * 8), (None, None, None, None, None, *[None] * 8)]
    return rows


def documents(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(3)


def benchmark(spark):
    return spark.createDataFrame(benchmark_rows(), BENCH)


def stored(spark, df, tmp_path, name="docs"):
    """As read from a file, like a pipeline stage's documents."""
    df.write.mode("overwrite").parquet(f"file://{tmp_path}/{name}.parquet")
    return spark.read.parquet(f"file://{tmp_path}/{name}.parquet")
