import corpus_pipeline
from cellscope.llm import minhash_hamming, toxicity_knn
from cellscope.llm.common import table

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_stages_do_their_work(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= docs.count()
    larger = table(spark, LARGER, "documents")
    assert 0.8 * larger.count() < toxicity_knn.remove_toxic(larger, table(spark, LARGER, "labels")).count() < larger.count()
    kept = minhash_hamming.near_duplicates(docs).where("kept").count()
    assert minhash_hamming.keep_one(docs).count() == kept


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
