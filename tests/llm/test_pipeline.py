"""The pipeline over small tables, each stage against what its own rule says of its own input."""

import os

import pytest

import corpus_pipeline
from jobtide.llm import catalog, decontaminate, simhash, toxicity
from jobtide.session import kept

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_stages_hand_on_documents(spark):
    docs = catalog.table(spark, FOLDER, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = kept(stage(spark, docs, FOLDER), name)
        assert out.columns == columns
        seen[name] = (docs, out)
        docs = out
    before, after = seen["toxicity"]
    model = toxicity.train(before, catalog.table(spark, FOLDER, "labels"), catalog.F.lit(True))
    rows = before.select("doc_id", "text").collect()
    scores = model.scores([(r["text"] or "").encode() for r in rows])
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r, s in zip(rows, scores) if s < 0.5}
    before, after = seen["near_duplicates"]
    classes = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert {r["doc_id"] for r in after.collect()} == classes
    before, after = seen["decontamination"]
    held = {r["doc_id"] for r in decontaminate.find_passages(before, catalog.table(spark, FOLDER, "benchmark")).collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - held
    before, after = seen["personal_data"]
    assert after.count() == before.count()
    assert after.filter("text rlike '[A-Za-z0-9]@[A-Za-z0-9-]+[.][a-z]'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_take_no_documents(spark):
    docs = catalog.table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert kept(stage(spark, docs, FOLDER), name).count() == 0


def test_stages_pass_clashing_and_dotted_columns(spark):
    """Extra columns of any name, and rows of equal id, come through every stage as they are."""
    docs = catalog.table(spark, FOLDER, "documents")
    names = ["toxicity", "a.b", "fingerprint", "component_id", "key", "score", "_c0", "text2", "spans"]
    docs = docs.unionByName(docs.limit(3)).select("*", *[catalog.F.concat(catalog.F.lit(n), catalog.F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = kept(stage(spark, docs, FOLDER), name)
        assert out.columns == docs.columns
        for n in names:
            assert out.filter(catalog.F.col(f"`{n}`") != catalog.F.concat(catalog.F.lit(n), catalog.F.col("doc_id").cast("string"))).count() == 0
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.groupBy("sequence_id").agg(catalog.F.sum("length").alias("n")).filter("n > 2048").count() == 0
