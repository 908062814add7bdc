import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import difference, engine
from surveyloom.llm.queries import ORACLES, QUERIES


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), engine(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {
    "op10_latent_decontamination", "op12_learned_partitions", "op13_bit_sliced_whitening"}))
def test_query_has_a_row_per_document(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in ids.collect())


def test_stages(spark, sf_dir, documents):
    texts = [None, "", "plain words to keep here", "plain words to keep here", "x " * 500]
    docs = documents([(i, t, None if i == 2 else "s") for i, t in enumerate(texts)] + [(None, "no id", "s")])
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            if name != "tokens":
                assert out.columns == rows.columns
            assert out.count() <= 3 * max(rows.count(), 0)


def test_pipeline(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert got and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
