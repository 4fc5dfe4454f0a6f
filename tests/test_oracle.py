"""Every registered query against its DuckDB oracle on the same parquet
tables (the driver's correctness gate, run locally at a small scale)."""

import pytest

import __spark_entry__ as se
from oracle import compare, duck

QUERIES = se.queries()
ORACLE = se.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, con, key):
    res = compare(QUERIES[key](spark, sf_dir), con, ORACLE[key])
    assert res["ok"], res


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.count() > 0
    assert len(df.columns) >= 2


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["qid", "n_docs", "doc_ids", "context_chars", "best_score", "status", "answer"]
    assert df.count() == spark.read.parquet(f"{se.SF_SMOKE}/embeddings.parquet").count()


def test_every_survey_key_is_unique_and_named():
    for k in QUERIES:
        assert k == k.lower() and " " not in k
