"""The pipeline's stages against the operators they call."""

import corpus_pipeline as C
from llm_util import SF, awkward

from venuelens.llm import repetition, simhash, suffix_dedup


def test_stages_hand_on_documents_and_their_decisions_hold(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for k, (name, stage) in enumerate(C.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        assert after.columns == columns and 0 < after.count() <= count, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if k == 1:
            assert ids == {r.doc_id for r in repetition.judge(repetition.measure(docs)).where("kept").collect()}
        if k == 2:
            assert ids == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        if k == 3:
            kept = {r.doc_id: r.kept.decode("utf-8", "ignore") for r in suffix_dedup.deduplicate(docs).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == kept
        docs, count = after, after.count()
    pieces = C.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_run_gives_the_same_rows_twice(spark):
    one, two = (sorted(tuple(r) for r in C.run(spark, SF).collect()) for _ in range(2))
    assert one == two and one


def test_stages_take_awkward_rows(spark):
    docs, _ = awkward(spark)
    for _, stage in C.STAGES:
        stage(spark, docs, SF).count()
        stage(spark, docs.limit(0), SF).count()
