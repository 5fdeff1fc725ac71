"""The corpus pipeline: each stage on what the one before it kept."""

import pytest

import corpus_pipeline
from odd import no_docs, odd_docs
from pairpulse.llm import common

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = [before]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3]
    result = corpus_pipeline.run(spark, SMALL)
    assert result.count() == counts[-1]
    assert {r.shard for r in result.select("shard").collect()} == set(range(16))


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_stages_take_odd_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_row_keys_outlive_a_change_of_cores(spark, tmp_path):
    """Splits follow the number kept in the session, not the leaf parallelism at planning."""
    path = str(tmp_path / "t")
    spark.range(300_000).selectExpr("id", "md5(string(id)) as x").coalesce(1).write.option(
        "parquet.block.size", 1 << 20).parquet(path)
    common.with_row_key(spark.read.parquet(path), "k")
    kept = spark.conf.get("spark.sql.files.minPartitionNum")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 16)
    found = []
    try:
        for cores in ("2", "7"):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            rows = common.with_row_key(spark.read.parquet(path), "k").select("id", "k")
            found.append({r.id: r.k for r in rows.collect()})
            assert rows.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] and spark.conf.get("spark.sql.files.minPartitionNum") == kept
