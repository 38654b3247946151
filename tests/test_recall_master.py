import pytest
from pyspark.sql import functions as F

from sieveline import settings
from sieveline.operators import master, recall, seeds
from sieveline.staging import number_rows

HITS = "query_pos long, query_id string, rank int, id string"


@pytest.fixture
def hits(spark):
    return spark.createDataFrame(
        [(0, "q0", 9, "X"), (1, "q1", 2, "X"), (2, "q2", 2, "X"), (0, "q0", 0, "A"), (1, "q1", 5, "B")], HITS
    )


def test_lists_and_lowest_rank(hits):
    rows = {r.id: r for r in recall.rank_lists(hits).collect()}
    assert [tuple(e) for e in rows["X"].inclusions_recall_data] == [(9, "q0"), (2, "q1"), (2, "q2")]
    assert (rows["X"].inclusions_min_rank, rows["X"].inclusions_min_rank_id) == (2, "q1")
    best = {r.id: (r.min_rank, r.min_rank_id) for r in recall.best_rank(hits).collect()}
    assert best == {"X": (2, "q1"), "A": (0, "q0"), "B": (5, "q1")}


def test_attribution_keeps_records_found_nowhere(spark, hits):
    prefix = settings.ID_PREFIX
    table = spark.createDataFrame(
        [("M1", prefix + "X"), ("M2", prefix + "Z"), ("M3", None)], "MID string, openalex_id string"
    )
    similar = spark.createDataFrame([("M1", "q1", 0.9)], "MID string, query_id string, similarity double")
    criteria = spark.createDataFrame([("M1", 0.5)], "MID string, criteria_similarity double")
    reranked = spark.createDataFrame(
        [(prefix + "A", 0.9), (prefix + "X", 0.9), (prefix + "B", 0.95)], "id string, relevance_score double"
    )
    near = spark.createDataFrame([("X", 4)], "id string, rank int")
    rows = {r.MID: r for r in recall.attribute(table, hits, near, similar, criteria, reranked).collect()}
    assert len(rows) == 3
    x = rows["M1"]
    assert (x.criteria_rank, x.logistic_rank, x.logistic_score, x.inclusions_similarity) == (4, 2, 0.9, 0.9)
    for mid in ("M2", "M3"):
        row = rows[mid].asDict()
        assert all(value is None for key, value in row.items() if key not in ("MID", "openalex_id"))


def test_recall_curve(spark, hits):
    relevant = spark.createDataFrame([("X",), ("X",), ("B",), ("never",), (None,)], "id string")
    curve = recall.recall_curve(hits, relevant, 10).orderBy("rank").collect()
    assert [r.n_found for r in curve] == [0, 0, 1, 1, 1, 2, 2, 2, 2, 2]
    assert {r.n_relevant for r in curve} == {3}
    assert curve[-1].recall == pytest.approx(2 / 3)


def test_flags_never_multiply_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "openalex_id string")
    others = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    flagged = master.flag_members(rows, others, "hit", on="openalex_id")
    assert sorted((r.openalex_id or "", r.hit) for r in flagged.collect()) == [
        ("", False), ("a", True), ("a", True), ("b", False),
    ]
    assert tuple(master.coverage(flagged, F.col("hit")).first()) == (4, 2)


def test_upsert_numbers_all_incoming_rows(spark):
    table = spark.createDataFrame(
        [("M10", "k", None, "own title", None, 1), ("M2", None, "d", "t", "a", None)],
        "MID string, openalex_id string, doi string, title string, abstract string, Data_0_Synergy int",
    )
    incoming = spark.createDataFrame(
        [("n1", "d1", "t1", "a1", 0), ("k", "dk", "tk", "ak", 1), ("n3", None, "t3", None, 2)],
        "id string, doi string, title string, abstract string, rank int",
    )
    rows = {r.MID: r for r in master.upsert(table, incoming).collect()}
    assert sorted(rows) == ["M10", "M11", "M13", "M2"]
    assert (rows["M10"].doi, rows["M10"].title, rows["M10"].abstract) == ("dk", "own title", "ak")
    assert {mid: (r.Data_3b, r.Data_0_Synergy) for mid, r in rows.items()} == {
        "M10": (1, 1), "M2": (0, 0), "M11": (1, 0), "M13": (1, 0),
    }
    assert rows["M13"].openalex_id == "n3"


def test_upsert_keeps_earlier_flags(spark):
    old = settings.MASTER_OLD_FLAG
    table = spark.createDataFrame(
        [("M1", "a", "d", "t", "x", 1, 1), ("M2", "b", "d", "t", "x", 0, None)],
        f"MID string, openalex_id string, doi string, title string, abstract string, Data_3b int, `{old}` int",
    )
    incoming = spark.createDataFrame(
        [("b", None, None, None, 0)], "id string, doi string, title string, abstract string, rank int"
    )
    rows = {r.MID: (r.Data_3b, r.Data_3b_old) for r in master.upsert(table, incoming).collect()}
    assert rows == {"M1": (1, 1), "M2": (1, 0)}


def test_number_rows(spark):
    values = [(n * 37 % 1000, f"i{n % 7}") for n in range(1000)]
    rows = spark.createDataFrame(values, "a int, b string").repartition(5)
    numbered = number_rows(rows, "n", F.col("a").desc(), "b", start=5).collect()
    assert [r.n for r in sorted(numbered, key=lambda r: -r.a)] == list(range(5, 1005))


def test_numbering_runs_in_many_tasks(spark):
    rows = spark.range(10_000).select(F.col("id"), F.lit("hot").alias("k"))
    numbered = number_rows(rows, "n", "k", "id")
    assert numbered.filter(F.col("n") != F.col("id")).count() == 0


REVIEW = "id string, doi string, label_included int"


def test_seeds(spark):
    review = spark.createDataFrame(
        [("1", "https://doi.org/10.1/AB", 1), ("2", "10.1/ab", 1), ("3", None, 1), ("4", "10.2/c", 1), ("5", "x", 0)],
        REVIEW,
    )
    assert sorted(r.id for r in seeds.included(review, ["10.1/aB"]).collect()) == ["3", "4"]
    first = {r.id: r.label_included for r in seeds.relabel_excluded(review, ["10.1/aB"]).collect()}
    assert first == {"1": 0, "2": 1, "3": 1, "4": 1, "5": 0}
    every = {r.id: r.label_included for r in seeds.relabel_excluded(review, ["10.1/aB"], first_only=False).collect()}
    assert every == {"1": 0, "2": 0, "3": 1, "4": 1, "5": 0}
    with pytest.raises(ValueError):
        seeds.relabel_excluded(review, ["10.9/none"])


def test_positions_of_a_long_dataset(spark):
    rows = spark.range(7_100).select(F.col("id").cast("string").alias("id"), (F.col("id") * 1.0).alias("relevance_score"))
    placed = recall.dataset_positions(rows)
    assert placed.count() == 7_100
    assert placed.filter(F.col("position") != 7_099 - F.col("relevance_score")).count() == 0


def test_curves_are_as_deep_as_the_hits(spark):
    from sieveline.operators import responses

    deep = spark.range(6_000).select(
        F.lit(0).cast("long").alias("query_pos"), F.lit("q").alias("query_id"), F.col("id").cast("int").alias("rank"), F.col("id").cast("string").alias("id")
    )
    assert responses.discovery_curve(deep).count() == 6_000
    assert tuple(responses.choose_cutoff(deep, 5_500).first()) == (5_500, 5_500, 5_500, 5_500)
    assert recall.recall_curve(deep, deep.select("id")).agg(F.max("n_found")).first()[0] == 6_000
    for curve in (responses.discovery_curve, lambda hits, depth: recall.recall_curve(hits, hits, depth)):
        with pytest.raises(ValueError):
            curve(deep, 5_000)


def test_null_keys_do_not_meet_in_one_task(spark):
    rows = spark.range(8_000).select(F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("openalex_id"), F.col("id").alias("n"))
    others = spark.range(0, 8_000, 20).select(F.col("id").cast("string").alias("id"))
    flagged = master.flag_members(rows.repartition(8), others, "hit", on="openalex_id")
    assert flagged.filter("hit").count() == 400 and flagged.count() == 8_000
    sizes = flagged.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(row["count"] for row in sizes) < 4_000


def test_many_lists_are_an_error(spark, hits, monkeypatch):
    from sieveline.operators import responses

    monkeypatch.setattr(settings, "MOST_LISTS", 2)
    with pytest.raises(ValueError):
        responses.overlap(hits, hits)


def test_membership_of_ids_without_a_list(spark, hits):
    from sieveline.operators import responses

    other = spark.createDataFrame([("A",), ("A",), ("Z",), (None,)], "id string")
    found = {r.query_id: tuple(r)[1:] for r in responses.membership(hits, {"in_other": other, "in_none": other.limit(0)}, "query_id").collect()}
    assert found == {"q0": (2, 1, 0), "q1": (2, 0, 0), "q2": (1, 0, 0)}


def test_common_ids_of_many_lists(spark, monkeypatch):
    from sieveline.operators import responses

    rows = [(f"W{n}", q) for q in range(40) for n in range(30) if (n * q) % 7 == 1 or n == 0 or q == n]
    many = spark.createDataFrame(rows, "id string, query_pos int")
    dense = {tuple(r) for r in responses.overlap(many, many).collect()}
    monkeypatch.setattr(settings, "MOST_LISTS", 5)
    monkeypatch.setattr(settings, "LIST_BLOCK", 6)
    found = responses.common_ids(many, many)
    assert found.columns == ["query_a", "query_b", "n_common"]
    result = [tuple(r) for r in found.collect()]
    assert len(result) == 1_600 and set(result) == dense
    assert min(n for _, _, n in result) == 1 and all(type(n) is int for row in result for n in row)
    apart = spark.createDataFrame([(f"W{q}", q) for q in range(20)], "id string, query_pos int")
    assert {tuple(r) for r in responses.common_ids(apart, apart).collect()} == {(a, b, int(a == b)) for a in range(20) for b in range(20)}


def test_registered_overlap_beyond_the_guard(spark, monkeypatch):
    from sieveline.plans import catalog

    small = "/root/testdata/sf0.001"
    dense = {tuple(r) for r in catalog.QUERIES["resp_overlap"](spark, small).collect()}
    monkeypatch.setattr(settings, "MOST_LISTS", 2)
    assert len(dense) > 4 and {tuple(r) for r in catalog.QUERIES["resp_overlap"](spark, small).collect()} == dense
