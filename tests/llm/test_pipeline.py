"""The pipeline's stages one after another, on awkward tables and on the smallest test data."""
import brute
import corpus
import pytest

import corpus_pipeline
from lakepipe.llm import near_dup
from lakepipe.llm.queries import QUERIES


def write_tables(spark, tmp_path, docs):
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    corpus.benchmark(spark).write.parquet(f"file://{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}"


def test_stages(spark, tmp_path):
    sf = write_tables(spark, tmp_path, corpus.documents(spark))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, apply in corpus_pipeline.STAGES:
        out = corpus.stored(spark, apply(spark, docs, sf), tmp_path, "stage-" + name.replace(" ", "-"))
        if name != "sharding":
            assert out.columns == docs.columns
        seen[name], docs = (docs, out), out
    before, after = seen["quality rules"]
    failed = {r["text"] for r in before.collect() if brute.quality(r["text"])[-1]}
    kept = {r["text"] for r in after.collect()}
    assert not failed & kept and any("MIT License.\n" in t for t in kept)
    before, after = seen["near dedup"]
    classes = near_dup.near_duplicates(before).select("class_id").distinct().count()
    assert after.count() == classes < before.count()
    before, after = seen["decontamination"]
    rows = before.collect()
    bad = brute.contamination([r["text"] for r in rows], [(r["item_id"], r["text"]) for r in corpus.benchmark(spark).collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r, b in zip(rows, bad, strict=True) if not b[4])
    before, after = seen["mixing"]
    total = lambda df: sum(len(brute.plain(r["text"])) for r in df.collect())
    assert total(after) == pytest.approx(total(before), rel=0.02)
    before, after = seen["sharding"]
    assert after.drop("shard", "virtual_slot").count() == before.count()
    held = [r["b"] for r in after.groupBy("shard").agg({"n_chars": "sum"}).withColumnRenamed("sum(n_chars)", "b").collect()]
    assert len(held) == 24


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 100 and {"doc_id", "text", "shard"} <= set(got.columns)


def test_empty_table(spark, tmp_path):
    sf = write_tables(spark, tmp_path, corpus.documents(spark).where("false"))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
