"""Every registered query against its SQL on the given tables."""

import duckdb
import pytest

from sieveline.plans.catalog import QUERIES
from sieveline.plans.oracle import SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ROWS_ONLY = {"dataset_c", "recall_master_reranked"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(record[n] for n in order) for record in records), key=repr)


def test_sql_is_given_for_all_but_model_queries():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


def executed(spark, after=-1):
    """(number, plan) of all queries the session has run after one, those of staged tables and writes included."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    runs = [runs.apply(n) for n in range(runs.size())]
    return [(run.executionId(), run.physicalPlanDescription()) for run in runs if run.executionId() > after]


# The search, similarity, cluster and grouped block kernels are the only Python in a plan.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    last = max((number for number, _ in executed(spark)), default=-1)
    found = QUERIES[name](spark, sf_dir)
    got = rows(found.columns, map(tuple, found.collect()))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = executed(spark, last)
    assert plans
    for _, text in plans:
        assert not [node for node in ("CartesianProduct", "NestedLoopJoin", *PYTHON_NODES) if node in text]
    result = duck.execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert got == rows(columns, result.fetchall())


def test_pruned_parts_are_not_read(spark, sf_dir, plan):
    assert "PartitionFilters: [isnotnull(updated_date" in plan(QUERIES["parts_pruned"](spark, sf_dir))


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
