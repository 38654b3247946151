"""Raw works are joined and dealt as texts; the inverted index, several times as large, is made after that."""

import pytest

from sieveline.plans import catalog, standins


@pytest.fixture
def tables(spark, tmp_path):
    texts = [(1, "b a b"), (2, None), (3, ""), (4, "c\nd"), (None, "e"), (5, "f")]
    spark.createDataFrame([(n, text, "en") for n, text in texts], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    # Keys come twice and are null.
    days = [(1, "1994-05-06"), (1, "1995-01-01"), (4, "1994-12-31"), (None, "1996-02-02"), (5, None)]
    orders = spark.createDataFrame(days, "o_orderkey long, day string").selectExpr("o_orderkey", "cast(day as timestamp_ntz) o_orderdate")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_rows(spark, tables):
    rows = standins.raw_works(spark, tables).collect()
    index = lambda row: row.abstract_inverted_index and tuple(sorted((word, tuple(at)) for word, at in row.abstract_inverted_index.items()))
    twice = (("a", (1,)), ("b", (0, 2)))
    assert {(row.id and row.id[-2:], row.publication_year, row.updated_date, index(row)) for row in rows} == {
        ("W1", 1994, "1994-01-01", twice),
        ("W1", 1995, "1995-01-01", twice),
        ("W2", None, "1970-01-01", None),
        ("W3", None, "1970-01-01", (("", (0,)),)),
        ("W4", 1994, "1994-01-01", (("c", (0,)), ("d", (1,)))),
        (None, None, "1970-01-01", (("e", (0,)),)),
        ("W5", None, "1970-01-01", (("f", (0,)),)),
    }
    assert len(rows) == 7


def test_index_is_made_after_the_join(spark, tables):
    shown = standins.raw_works(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("map_from_arrays") < shown.index("Join LeftOuter")


def test_files_are_written_as_before(spark, tables):
    read = spark.read.json(catalog._json_works(spark, tables))
    assert read.count() == 7
    assert sorted({str(row.updated_date) for row in read.select("updated_date").collect()}) == ["1970-01-01", "1994-01-01", "1995-01-01"]
