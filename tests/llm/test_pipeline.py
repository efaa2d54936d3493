"""The pipeline's stages against the operators' own answers on the small tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakelens.llm import toxicity
from lakelens.llm.columns import written
from lakelens.llm.decontamination import contaminated
from lakelens.llm.mixing import mix
from lakelens.llm.near_duplicates import near_duplicates

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "source_mix", "token_ids"]


def test_effects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.orderBy("doc_id").limit(5)
    given = written(docs.unionByName(extra).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string"))), "given")
    kept = [given]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF), name))
        if name != "token_ids":
            assert kept[-1].columns == docs.columns
    clean, once, tested, mixed, coded = kept[1:]

    model = toxicity.train(given, spark.read.parquet(f"{SF}/labels.parquet"))
    ids = lambda df: sorted((r[0] for r in df.select("doc_id").collect()), key=str)
    assert ids(clean) == ids(given.where(toxicity.score(model, F.col("text")) < 0.5))

    groups = near_duplicates(clean, corpus_pipeline.NEAR).where("n_shingles > 0").collect()
    assert sorted(r["doc_id"] for r in once.where("length(text) > 0").collect()) == sorted({r["component_id"] for r in groups})

    assert set(ids(tested)) == set(ids(once)) - set(ids(contaminated(once, spark.read.parquet(f"{SF}/benchmark.parquet"))))
    expected = {r["doc_id"]: r["copies"] for r in mix(tested).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == expected
    assert ids(coded) == ids(mixed)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() > 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_empty(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, docs, SF).count() == 0


def test_clashing_columns(spark):
    """Columns named like the stages' own stay, in every spelling, with all their values."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = {name: F.concat(F.lit(f"{name}-"), F.col("doc_id")) for name in ("row_hash", "ROW", "its_row", "its_doc_id", "copies", "copy", "__row", "chosen")}
    given = written(docs.withColumns(extra), "given")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = written(stage(spark, given, SF), name)
        assert given.columns == [*docs.columns, *extra]
        assert given.where(" OR ".join(f"`{c}` <> concat('{c}-', doc_id)" for c in extra)).isEmpty() and not given.isEmpty()
