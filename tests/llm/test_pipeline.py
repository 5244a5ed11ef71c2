"""The pipeline's stages on the edge rows and on a small table."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SD = "/root/testdata/sf0.01"


def test_stages_keep_columns(spark, docs, none):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for d in (docs, none):
            out = stage(spark, d, SD)
            assert out.dtypes == d.dtypes, name
            assert (out.count() == 0) == (d is none)


@pytest.fixture(scope="module")
def kept(spark):
    out, docs = {}, spark.read.parquet(f"{SD}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SD).cache()
        out[name] = docs
    return out


def test_each_stage_decides(kept):
    ids = {k: {r[0] for r in d.select("doc_id").collect()} for k, d in kept.items()}
    assert len(ids["quality_rules"]) < 1000
    assert ids["line_dedup"] == ids["quality_rules"]
    assert ids["near_dedup"] < ids["line_dedup"]
    assert ids["decontamination"] < ids["near_dedup"]
    changed = kept["line_dedup"].alias("a").join(kept["quality_rules"].alias("b"), "doc_id").filter("a.text != b.text")
    assert changed.count() and changed.filter(F.length("a.text") != F.col("a.n_chars")).count() == 0


def test_run_packs_what_is_left(spark, kept):
    got = {r[0] for r in corpus_pipeline.run(spark, SD).select("doc_id").collect()}
    assert got == {r[0] for r in kept["decontamination"].select("doc_id").collect()}
