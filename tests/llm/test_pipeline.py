"""The pipeline's stages take effect on all rows and keep the columns."""

import corpus_pipeline
from merch.llm.queries import table
from merch.session import staged

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, SF), "stage")
        assert docs.columns == names
        old, new = before.select("doc_id").distinct(), docs.select("doc_id").distinct()
        assert new.join(old, "doc_id", "left_anti").count() == 0
        assert new.count() < old.count() or "mixing" in name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()


def test_odd_rows_pass(spark):
    rows = [(1, None, None, None, 0), (1, None, None, None, 0), (None, "", "en", "a", 0), (2, "word " * 30, "en", "a", 0)]
    docs = spark.createDataFrame([(*r, 5, "x", 1, 2, 3) for r in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, copies int, score string, _key_file int, _key_row int, block int")
    for frame in (docs, docs.where("false")):
        out = frame
        for _, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, out, "/root/testdata/sf0.001"), "odd")
        assert (out.count() == 0) == (frame is not docs)
