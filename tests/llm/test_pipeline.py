import corpus_pipeline
from assaywright.operators.storage import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs, counts = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        out = stored(stage(spark, docs, SF), [])
        if name != "token_files":
            assert out.columns == documents.columns
            assert out.join(docs, "doc_id", "left_anti").isEmpty()
        if name in ("quality_rules", "near_duplicates", "decontamination"):
            assert 0 < out.count() <= before and out.select("doc_id").distinct().count() == out.count()
        counts.append(out.count())
        docs = out
    assert counts[-1] == counts[-2] > 0
    at = 0
    for r in docs.orderBy("start").collect():
        assert r["start"] == at
        at += r["n_tokens"]
