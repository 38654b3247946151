"""Lookup of works by id in files clustered by id."""

import pytest
from pyspark.sql import functions as F

from sieveline.operators import candidates, work_index
from sieveline.staging import staged_path

ROWS = 60_000


@pytest.fixture(scope="module")
def works(spark):
    n = F.col("id")
    return spark.range(ROWS).select(
        F.concat(F.lit("W"), n * 7).alias("id"),
        F.concat(F.lit("10.1/"), n).alias("doi"),
        F.when(n % 5 > 0, F.repeat(F.sha2(n.cast("string"), 256), 4)).alias("title"),
        F.lit(None).cast("string").alias("abstract"),
    )


@pytest.fixture(scope="module")
def index(spark, works):
    layout = {"group_bytes": 256 * 1024, "page_rows": 200, "files": 6}
    path = staged_path(spark, "index")
    nulls = works.limit(3).withColumn("id", F.lit(None).cast("string"))
    built = work_index.create_work_index(spark, path, works.where("doi < '10.1/5'").unionByName(nulls), **layout)
    return built.append(works.where("NOT doi < '10.1/5'"), **layout)


def ids(spark, values):
    return spark.createDataFrame([(value,) for value in values], "id string")


def found(df):
    return sorted(map(tuple, df.collect()))


def read_rows(spark, run):
    """What `run` returns, and the number of rows that scans of the index gave while it ran."""
    status = spark._jsparkSession.sharedState().statusStore()
    last = max((status.executionsList().apply(n).executionId() for n in range(status.executionsList().size())), default=-1)
    result = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total, runs = 0, status.executionsList()
    for run in (runs.apply(n) for n in range(runs.size())):
        if run.executionId() > last and "/works" in run.physicalPlanDescription():
            values = status.executionMetrics(run.executionId())
            nodes = status.planGraph(run.executionId()).allNodes()
            for node in (nodes.apply(n) for n in range(nodes.size())):
                if node.name().startswith("Scan parquet"):
                    for metric in (node.metrics().apply(n) for n in range(node.metrics().size())):
                        if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                            total += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return result, total


@pytest.mark.parametrize("most", [20_000, 0])
@pytest.mark.parametrize("values", [200, 3])
def test_same_as_enrichment(spark, works, index, most, values):
    wanted = ids(spark, ["W7", "W7", None, "", "W8", "X", "W419993", *[f"W{n * 7 * 911}" for n in range(60)]])
    merged = spark.createDataFrame([("W8", "W14"), ("W21", "W28"), (None, "W35")], "old_id string, new_id string")
    for gone in (None, merged):
        assert found(index.lookup(wanted, merged=gone, most=most, values=values)) == found(
            candidates.enrich(wanted, works, merged=gone)
        )


def test_few_rows_are_read(spark, index):
    wanted = ids(spark, [f"W{n * 7 * 2_003}" for n in range(25)])
    result, rows = read_rows(spark, lambda: index.lookup(wanted, ("id", "title")))
    assert result.count() == 25
    # At most a page of each delivery for an id.
    assert 25 <= rows <= 25 * 2 * 200
    _, every = read_rows(spark, lambda: index.lookup(wanted, ("id", "title"), most=0).collect())
    # The whole table, and the ids it is joined with.
    assert every == ROWS + 25


def test_absent_ids_read_nothing(spark, index):
    result, rows = read_rows(spark, lambda: index.lookup(ids(spark, ["A", "Z", None])))
    assert result.collect() == [] and rows == 0
    assert result.columns == ["id", "doi", "title", "abstract"]
    # Between ids that are there: the Bloom filters of the row groups hold none of them.
    absent = ids(spark, [f"W{n * 7 * 1_999 + 3}" for n in range(1, 25)])
    result, rows = read_rows(spark, lambda: index.lookup(absent))
    assert result.collect() == [] and rows <= 2 * 200


def test_setting_is_put_back(spark, index):
    before = spark.conf.get(work_index.IN_VALUES)
    index.lookup(ids(spark, ["W7"]))
    assert spark.conf.get(work_index.IN_VALUES) == before


def test_empty_table_and_copies(spark, works):
    built = work_index.create_work_index(spark, staged_path(spark, "index"), works.limit(0))
    assert built.lookup(ids(spark, ["W7"])).collect() == []
    twice = built.append(works.limit(2)).append(works.limit(2))
    assert found(twice.lookup(ids(spark, ["W7"]), ("id",))) == [("W7",), ("W7",)]
