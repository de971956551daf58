"""Registered corpus queries against their SQL, and the pipeline end to end."""

import corpus_pipeline
import oracle
import pytest

from eventmart.llm.oracles import oracle_statements
from eventmart.llm.queries import QUERIES


def test_each_number_is_registered_once():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(oracle_statements()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_statements()))
def test_query_equals_sql(spark, folder, name):
    problems, _, _, _ = oracle.compare(spark, oracle.connect(folder), name, folder)
    assert not problems


def test_pipeline_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        before = set(ids)
    stage = corpus_pipeline.STAGES[-1][1]
    packed = stage(spark, docs, folder).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == before
