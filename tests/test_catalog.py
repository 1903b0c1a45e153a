"""Every registered query, against SQL where it has a counterpart."""

from __future__ import annotations

import pytest
from conftest import plan_of, rows

import __spark_entry__
from staylens.catalog import ORACLES, QUERIES

# Queries that fit models before they return a plan.
FITTED = {"score_batch", "score_stream", "model_roundtrip", "model_comparison"} | {
    name for name in QUERIES if name.startswith(("job_", "cluster_", "classify_", "sentiment_lr", "sentiment_svm"))
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(result.columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str)
    assert rows(result) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_plan_has_no_python_and_no_product(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in plan


def test_entry(spark):
    stats = __spark_entry__.entry(spark)
    assert stats.count() > 0
    assert stats.columns[0] == "offering_id" and len(stats.columns) == 15


def test_registered_names_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
