"""License scans (4): diagonal voting of word k-grams against templates.

Method: the hashes of all rolling k-grams of words of all texts are joined by
Spark to the places of the same k-grams in the templates.  A text that quotes
a template has many such pairs on one diagonal (place in the text less place
in the template), so pairs are counted per text, template and diagonal;
neighbouring diagonals (words put in or left out) are merged, and the merged
span is verified: the template words proven equal must be a large enough part
of the template and of the span.

The templates are a fixed short list, so their table of k-gram places has a
fixed size and is broadcast; no text, and no word of a text without a match,
is shuffled.  Equality of k-grams is by two independent 64-bit hashes.

The base labels are places where a phrase's words stand consecutively.

Defined results: null texts are empty; texts without words have no labels and
score 0; rows equal in id and text get equal results; ids may be null; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.llm.frames import KEY, attach, stage, text_hash
from lakepipe.llm.words import Words, prefix, ranged, slices

K = 3
#: Diagonals that differ by so many words at most are merged.
NEAR = 4
#: Least part of a template's words, and of the words of the span in the text, that must be proven equal.
TEMPLATE_PART, SPAN_PART = 0.6, 0.5

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Template texts, the usual notices of public licences, by the label each gives.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
                "by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
                "by the free software foundation either version 2 of the license or at your option any later version"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files the software to deal in the software without restriction"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
]

GRAM = "doc_id long, text_hash long, row long, at int, one long, two long"


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, one = words.windows(K, None, 0)
    _, two = words.windows(K, None, 1)
    return at, one, two


def template_places(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """The places of all k-grams of the templates: label, template, size, place, hashes."""
    w = Words(pa.array([t for _, t in templates]), lower=True, seeds=(1, 2))
    at, one, two = _grams(w)
    return spark.createDataFrame(
        [(templates[r][0], int(r), int(w.count[r]), int(a - w.off[r]), int(x), int(y))
         for a, r, x, y in zip(at, w.row[at], one.view(np.int64), two.view(np.int64), strict=True)],
        "label string, template int, size int, place int, one long, two long")


def _text_grams(batches):
    for batch in batches:
        for part in slices(batch):
            w = Words(part.column("text"), lower=True, seeds=(1, 2))
            at, one, two = _grams(w)
            take = pa.array(w.row[at])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c).take(take) for c in (*KEY, "row")], pa.array((at - w.off[w.row[at]]).astype(np.int32)),
                 pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                names=[*KEY, "row", "at", "one", "two"])


def _base(phrases: dict[str, str]):
    names = list(phrases)

    def run(batches):
        p = Words(pa.array(names), lower=True, seeds=(1, 2))
        wanted = [[int(ranged(prefix(h, 11 + i), p.off[j: j + 1], p.off[j + 1: j + 2], 11 + i)[0])
                   for i, h in enumerate(p.hashes)] for j in range(len(names))]
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), lower=True, seeds=(1, 2))
                n = w.n_rows
                count, first, last = np.zeros(n, dtype=np.int64), np.full(n, -1), np.full(n, -1)
                labels: list[set] = [set() for _ in range(n)]
                places, owner = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
                for j, name in enumerate(names):
                    at, one = w.windows(int(p.count[j]), None, 0)
                    at = at[one == np.uint64(wanted[j][0])]
                    at, two = w.windows(int(p.count[j]), at, 1)
                    at = at[two == np.uint64(wanted[j][1])]
                    places.append(at)
                    owner.append(w.row[at])
                    for r in np.unique(w.row[at]):
                        labels[r].add(phrases[name])
                at, r = np.concatenate(places), np.concatenate(owner)
                order = np.argsort(at)
                at, r = at[order], r[order]
                count += np.bincount(r, minlength=n)
                last[r] = at - w.off[r]
                first[r[::-1]] = (at - w.off[r])[::-1]
                none = first < 0
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in KEY], pa.array(w.count.astype(np.int64)), pa.array(count),
                     pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([sorted(x) for x in labels], type=pa.list_(pa.string()))],
                    names=[*KEY, "n_words", "n_base", "first_word", "last_word", "base"])
    return run


def spans(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Verified quotations: doc_id, text_hash, label, template, first_at, last_at (words of the text), score.

    ``docs`` has doc_id, text and text_hash; rows equal in these give one set of spans.
    """
    places = F.broadcast(template_places(docs.sparkSession, templates))  # a fixed list
    numbered = docs.select(*KEY, "text", F.monotonically_increasing_id().alias("row"))
    pairs = numbered.mapInArrow(_text_grams, GRAM).join(places, ["one", "two"])
    votes = (pairs.withColumn("diagonal", F.col("at") - F.col("place"))
             .groupBy(*KEY, "row", "template", "label", "size", "diagonal")
             .agg(F.collect_set("place").alias("places"), F.min("at").alias("lo"), F.max("at").alias("hi")))
    # runs of diagonals, each near the one before (a text's own diagonals only, and few)
    of = Window.partitionBy(*KEY, "row", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(of) > NEAR).cast("int"), F.lit(0))
    merged = (votes.withColumn("new", new).withColumn("run", F.sum("new").over(of))
              .groupBy(*KEY, "row", "template", "label", "size", "run")
              .agg(F.flatten(F.collect_list("places")).alias("places"), F.min("lo").alias("first_at"),
                   (F.max("hi") + K - 1).alias("last_at")))
    words = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (K - 1))))))
    score = words / F.col("size")
    return (merged.withColumn("equal", words).withColumn("score", score)
            .where((F.col("score") >= TEMPLATE_PART) & (F.col("equal") >= SPAN_PART * (F.col("last_at") - F.col("first_at") + 1)))
            .select(*KEY, "label", "template", "first_at", "last_at", "score").distinct())


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: base places and labels, all labels, best template score (see the contract of op4)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash(F.col("text")).alias("text_hash"))
    found = stage(docs.sparkSession, spans(texts, templates).groupBy(*KEY).agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best")), "licenses")
    base = texts.mapInArrow(_base(phrases), "doc_id long, text_hash long, n_words long, n_base long, first_word long, "
                                            "last_word long, base array<string>")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", none))))
    return attach(base, found).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"))
