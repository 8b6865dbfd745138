"""The pipeline's stages on a small table, against what each must keep; registration."""

import corpus_pipeline
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == docs.columns, name
        assert out.join(seen, "doc_id", "left_anti").count() == 0
        seen = out.cache()
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert last.select("doc_id").exceptAll(seen.select("doc_id")).count() == 0 and last.count() == seen.count()
    assert corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").exceptAll(last.select("doc_id", "shard", "slot")).count() == 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 11 and names[-1] == "pipeline"
    assert set(entry.oracle_sql()) >= {"op3_chat_format", "op8_url_cascade"}
