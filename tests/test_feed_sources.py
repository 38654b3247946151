import gzip
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline import staging
from sieveline.operators import feed, profile
from sieveline.plans import corpus
from sieveline.sources import manifest, readers, writers
from sieveline.staging import fingerprint, materialize_known
from sieveline.streaming import ingest, upsert

WORKS = [
    {"id": "https://openalex.org/W1", "title": "One", "abstract_inverted_index": {"b": [1], "a": [0]}, "publication_year": 2016},
    {"id": "https://openalex.org/W2", "title": None, "abstract_inverted_index": None, "publication_year": 2016},
    {"id": "https://openalex.org/W3", "title": "", "abstract_inverted_index": None, "publication_year": None},
]


def write_part(folder, date, part, works):
    path = folder / f"updated_date={date}"
    path.mkdir(parents=True, exist_ok=True)
    with gzip.open(path / f"part_{part}.gz", "wt") as out:
        out.writelines(json.dumps(work) + "\n" for work in works)


def test_read_works(spark, tmp_path):
    write_part(tmp_path, "2023-01-01", "000", WORKS)
    write_part(tmp_path, "2023-01-02", "001", WORKS[1:2])
    (tmp_path / "updated_date=2023-01-02" / "other.gz").write_bytes(b"")
    raw = readers.read_works(spark, str(tmp_path))
    assert raw.count() == 4
    works = readers.prepare_works(raw).orderBy("id").collect()
    assert [(w.id, w.title, w.abstract, w.updated_date, w.part) for w in works] == [
        ("W1", "One", "a b", "2023-01-01", "000"),
        ("W3", "", None, "2023-01-01", "000"),
    ]


def test_folders_are_pruned(spark, tmp_path):
    for date in ("2023-01-01", "2023-01-02"):
        write_part(tmp_path, date, "000", WORKS)
    later = readers.with_part(
        spark.read.schema(readers.dated(readers.RAW_WORK)).option("pathGlobFilter", "part_*.gz").json(str(tmp_path))
    ).filter(F.col("updated_date") > "2023-01-01")
    assert later.count() == 3
    assert "PartitionFilters: [isnotnull(updated_date" in later._jdf.queryExecution().toString()


def test_completeness(spark, tmp_path):
    write_part(tmp_path, "2023-01-01", "000", WORKS)
    write_part(tmp_path, "2023-01-02", "000", WORKS)
    write_part(tmp_path, "2023-01-03", "000", WORKS)
    (tmp_path / "manifest").write_text(
        json.dumps(
            {
                "entries": [
                    {"url": f"data/works/updated_date={date}/part_000.gz", "meta": {"content_length": 1, "record_count": n}}
                    for date, n in (("2023-01-02", 4), ("2023-01-01", 3), ("2023-01-09", 1))
                ],
                "meta": {"content_length": 3, "record_count": 8},
            },
            indent=1,
        )
    )
    entries = manifest.read_manifest(spark, str(tmp_path / "manifest"))
    paths = [r.path for r in manifest.file_paths(entries, "save").collect()]
    assert paths == [f"save/updated_date=2023-01-{day}/part_000.gz" for day in ("01", "02", "09")]
    raw = spark.read.schema(readers.dated(readers.RAW_WORK)).option("pathGlobFilter", "part_*.gz").json(str(tmp_path))
    state = {r.file[13:23]: r.state for r in manifest.completeness(entries, manifest.file_counts(raw)).collect()}
    assert state == {
        "2023-01-01": "complete", "2023-01-02": "differs", "2023-01-03": "undeclared", "2023-01-09": "missing",
    }


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", 'say "hi",\nthen go', ["x", "y,z"], 1), ("b", "", [], None), ("c", None, None, 3)]
    schema = "id string, text string, refs array<string>, n int"
    table = spark.createDataFrame(rows, schema)
    writers.write_csv(table, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv"), T._parse_datatype_string(schema))
    assert sorted(map(tuple, back.collect())) == [rows[0], ("b", None, [], None), rows[2]]
    fewer = readers.read_csv(spark, str(tmp_path / "csv"), T._parse_datatype_string("n int, id string"))
    assert fewer.columns == ["n", "id"] and fewer.count() == 3
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "csv"), T._parse_datatype_string("missing int"))


def test_master_table_formats(spark, tmp_path):
    schema = T._parse_datatype_string("MID string, Data_3b int")
    table = spark.createDataFrame([("M1", 1), ("M2", None)], schema)
    writers.write_csv(table, str(tmp_path / "m.csv"))
    writers.write_parquet(table, str(tmp_path / "m"))
    for path in ("m.csv", "m"):
        assert sorted(map(tuple, readers.read_master(spark, str(tmp_path / path), schema).collect())) == [("M1", 1), ("M2", None)]


def test_read_vector(spark, tmp_path):
    (tmp_path / "v.json").write_text("[0.5, -1, 2e-1]")
    assert readers.read_vector(spark, str(tmp_path / "v.json")).first().embedding == pytest.approx([0.5, -1, 0.2])
    rows = readers.literal_table(spark, [(34, 4)], "n_responses int, n_records int")
    assert tuple(rows.first()) == (34, 4)


def test_split_write(spark, tmp_path):
    works = spark.createDataFrame(
        [("W1", "t", None, 2016, [1.0], "2023-01-01", "000"), ("W2", "t", None, 2010, [2.0], "2023-01-02", "000")],
        "id string, title string, abstract string, publication_year int, embedding array<float>, updated_date string, part string",
    )
    texts, vectors = str(tmp_path / "t"), str(tmp_path / "v")
    writers.write_parts(works, texts, vectors)
    by_join = feed.recent(spark.read.parquet(vectors), spark.read.parquet(texts))
    by_scan = feed.recent(spark.read.parquet(vectors))
    assert [r.id for r in by_join.collect()] == [r.id for r in by_scan.collect()] == ["W1"]


def test_materialize_computes_once(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert staging.materialize(spark.range(3), path).count() == 3
    assert staging.materialize(spark.range(99), path).count() == 3


VECTORS = "id string, embedding array<float>, updated_date string, part string"


def test_split_valid(spark):
    rows = spark.createDataFrame(
        [("a", [1.0, 2.0], "d", "0"), (None, [1.0, 2.0], "d", "0"), ("b", [1.0], "d", "0"), ("c", None, "d", "0")], VECTORS
    )
    accepted, rejected = feed.split_valid(rows, 2)
    assert [r.id for r in accepted.collect()] == ["a"]
    assert sorted((r.id or "", r.reason) for r in rejected.collect()) == [
        ("", "missing id"), ("b", "wrong length"), ("c", "missing embedding"),
    ]


@pytest.mark.parametrize("bound", [100, 0])
def test_keep_latest(spark, bound):
    rows = [("a", [1.0], "2023-01-01", "000"), ("a", [2.0], "2023-01-02", "000"), ("a", [3.0], "2023-01-02", "001")]
    rows += [("d", [7.0], "2023-01-01", None), ("d", [8.0], None, None), ("d", [9.0], "2023-01-01", None)]
    rows += [("b", [4.0], "2023-01-01", "000"), ("c", [5.0], "2023-01-01", "000"), ("c", [6.0], "2023-01-01", "000")]
    kept = feed.keep_latest(spark.createDataFrame(rows, VECTORS), bound=bound)
    assert {r.id: r.embedding for r in kept.collect()} == {"a": [3.0], "b": [4.0], "c": [6.0], "d": [9.0]}
    assert kept.columns == ["id", "embedding", "updated_date", "part"] or bound == 0


def test_a_filtered_newer_version_leaves_the_older(spark):
    rows = spark.createDataFrame(
        [("a", [1.0], "2023-01-01", "000", 2016), ("a", [2.0], "2023-01-02", "000", 2001)], VECTORS + ", publication_year int"
    )
    assert feed.keep_latest(feed.recent(rows)).first().embedding == [1.0]


def test_streams(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    write_part(tmp_path / "in", "2023-01-01", "000", WORKS)

    def run():
        ingest.ingest_stream(spark, source, out, state).awaitTermination()
        return sorted((r.id, r.abstract, r.part) for r in spark.read.schema(ingest.PREPARED).parquet(out).collect())

    assert run() == [("W1", "a b", "000"), ("W3", None, "000")]
    assert run() == [("W1", "a b", "000"), ("W3", None, "000")]
    write_part(tmp_path / "in", "2023-01-02", "000", WORKS[:1])
    assert run() == [("W1", "a b", "000"), ("W1", "a b", "000"), ("W3", None, "000")]


def test_stream_with_embedding(spark, tmp_path):
    write_part(tmp_path / "in", "2023-01-01", "000", WORKS)
    out = str(tmp_path / "out")
    running = ingest.ingest_stream(
        spark, str(tmp_path / "in"), out, str(tmp_path / "state"), embed=lambda works: corpus.embed_works(works)
    )
    running.awaitTermination()
    assert [len(r.embedding) for r in spark.read.parquet(out).collect()] == [384, 384]


def test_build_and_searchable(spark, tmp_path):
    write_part(tmp_path / "in", "2023-01-01", "000", WORKS)
    write_part(tmp_path / "in", "2023-01-02", "000", [dict(WORKS[0], title="New"), dict(WORKS[2], publication_year=2001)])
    texts, vectors = str(tmp_path / "texts"), str(tmp_path / "vectors")
    corpus.build(spark, str(tmp_path / "in"), texts, vectors)
    kept, refused = corpus.searchable(spark.read.parquet(vectors))
    assert [(r.id, str(r.updated_date), len(r.embedding)) for r in kept.collect()] == [("W1", "2023-01-02", 384)]
    assert refused.count() == 0
    assert spark.read.parquet(texts).count() == 4
    by_join, _ = corpus.searchable(
        spark.read.parquet(vectors).drop("publication_year"), spark.read.parquet(texts)
    )
    assert [r.id for r in by_join.collect()] == ["W1"]


def test_upsert_stream(spark, tmp_path):
    source, table, rejected, state = (str(tmp_path / name) for name in ("in", "table", "rejected", "state"))

    def add(rows):
        spark.createDataFrame(rows, VECTORS).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(VECTORS).parquet(source)
        upsert.upsert_stream(arriving, table, rejected, state, 1).awaitTermination()
        return {r.id: r.embedding for r in upsert.current(spark, table).collect()}

    assert add([("a", [1.0], "2023-01-02", "000"), ("b", [2.0], "2023-01-01", "000")]) == {"a": [1.0], "b": [2.0]}
    late = [("a", [9.0], "2023-01-01", "000"), ("b", [3.0], "2023-01-03", "000"), ("c", [1.0, 2.0], "2023-01-03", "000")]
    assert add(late) == {"a": [1.0], "b": [3.0]}
    assert [r.reason for r in spark.read.parquet(rejected).collect()] == ["wrong length"]
    # A later row of the same version is a correction.
    assert add([("a", [0.5], "2023-01-02", "000")]) == {"a": [0.5], "b": [3.0]}
    before = len(list((tmp_path / "table").rglob("*.parquet")))
    upsert.vacuum(spark, table)
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 2 < before
    assert {r.id: r.embedding for r in upsert.current(spark, table).collect()} == {"a": [0.5], "b": [3.0]}
    assert add([("d", [4.0], "2023-01-01", "000")]) == {"a": [0.5], "b": [3.0], "d": [4.0]}


def bytes_of(folder):
    return sum(file.stat().st_size for file in folder.rglob("*.parquet"))


def test_small_batches_write_little(spark, tmp_path):
    source, table, rejected, state = (str(tmp_path / name) for name in ("in", "table", "rejected", "state"))
    schema = VECTORS + ", gone boolean"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        before = bytes_of(tmp_path / "table") if (tmp_path / "table").exists() else 0
        arriving = spark.readStream.schema(schema).parquet(source)
        upsert.upsert_stream(arriving, table, rejected, state, 50, buckets=4).awaitTermination()
        return bytes_of(tmp_path / "table") - before

    rng = random.Random(3)
    expected = {f"W{n}": [rng.random() for _ in range(50)] for n in range(5_000)}
    whole = add([(i, v, "2024-01-01", "0", False) for i, v in expected.items()])
    for day in range(2, 8):
        changed = {f"W{rng.randrange(6_000)}": [float(day)] * 50 for _ in range(20)}
        dead = {f"W{rng.randrange(6_000)}" for _ in range(10)} - changed.keys()
        rows = [(i, v, f"2024-01-0{day}", "0", None) for i, v in changed.items()]
        rows += [(i, None, f"2024-01-0{day}", "0", True) for i in dead] + [(None, None, "2024-01-09", "0", True)]
        assert add(rows) < whole / 10
        expected = {i: v for i, v in (expected | changed).items() if i not in dead}
    # Small versions were merged with each other, the large one stayed.
    assert len(upsert._spans(spark, table)) < 4
    found = {r.id: r.embedding for r in upsert.current(spark, table).collect()}
    assert found.keys() == expected.keys() and all(found[i] == pytest.approx(v) for i, v in expected.items())
    assert not set(expected) & {r.id for r in upsert.gone(spark, table).collect()}
    assert {r.reason for r in spark.read.parquet(rejected).collect()} == {"missing id"}
    # A row that is older than a tombstone stays hidden, whether merged or not.
    one = upsert.gone(spark, table).orderBy("id").first().id
    add([(one, [9.0] * 50, "2024-01-01", "0", False)])
    assert one not in {r.id for r in upsert.current(spark, table).collect()}
    upsert.vacuum(spark, table)
    assert {r.id for r in upsert.current(spark, table).collect()} == set(expected)


def test_fingerprint_follows_the_input(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).write.parquet(path)
    read = lambda: spark.read.schema("id long").parquet(path)
    first = fingerprint(read().where("id > 1"))
    assert first and first == fingerprint(read().where("id > 1")) != fingerprint(read().where("id > 2"))
    spark.range(2).write.mode("append").parquet(path)
    assert fingerprint(read().where("id > 1")) != first
    assert fingerprint(spark.createDataFrame([(1,)], "id long")) is None
    kept = str(tmp_path / "kept")
    assert materialize_known(read().groupBy().count(), kept).first()[0] == 7
    assert materialize_known(read().groupBy().count(), kept).first()[0] == 7 and len(list((tmp_path / "kept").iterdir())) == 1
    spark.range(1).write.mode("append").parquet(path)
    assert materialize_known(read().groupBy().count(), kept).first()[0] == 8


def test_snapshot_delta(spark, tmp_path):
    schema = "url string, content_length long, record_count long"
    before = [("x/d=1/a.gz", 5, 1), ("x/d=1/b.gz", 5, None), ("x/d=2/a.gz", 5, 2), ("x/d=2/a.gz", 6, 2), ("x/d=3/a.gz", None, 1), (None, 1, 1)]
    after = [("y/d=1/a.gz", 5, 1), ("y/d=1/b.gz", 5, 3), ("y/d=2/a.gz", 6, 2), ("y/d=4/a.gz", 1, 1)]
    delta = manifest.snapshot_delta(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)).cache()
    states = {row.file: row.state for row in delta.collect()}
    assert states == {"d=1/a.gz": "same", "d=1/b.gz": "changed", "d=2/a.gz": "same", "d=3/a.gz": "vanished", "d=4/a.gz": "new"}
    held = [("W1", "d=1/a.gz"), ("W2", "d=1/b.gz"), ("W3", "d=1/b.gz"), ("W4", "d=3/a.gz"), ("W5", "d=3/a.gz"), ("W1", "d=3/a.gz"), (None, "d=3/a.gz")]
    fresh = spark.createDataFrame([("W2",), ("W5",), (None,)], "id string")
    gone = manifest.retracted(spark.createDataFrame(held, "id string, file string"), delta, fresh)
    assert sorted(row.id for row in gone.collect()) == ["W3", "W4"]
    for name in ("a", "b"):
        (tmp_path / "d=1").mkdir(exist_ok=True)
        (tmp_path / "d=1" / f"{name}.gz").write_bytes(gzip.compress(json.dumps({"id": f"W{name}"}).encode()))
    rows = spark.read.schema("id string").json(str(tmp_path))
    assert [row.id for row in manifest.delta_rows(rows, delta).collect()] == ["Wb"]


def test_profiles(spark):
    works = spark.createDataFrame(
        [("a", "x", 2016), ("b", None, 2015), ("c", "y", 2001), ("d", "z", None)],
        "id string, abstract string, publication_year int",
    )
    assert tuple(profile.corpus_counts(works).first()) == (4, 3, 2, 1)
    assert [tuple(r) for r in profile.column_profile(works).collect()] == [
        ("id", "string", 4, 4), ("abstract", "string", 4, 3), ("publication_year", "int", 4, 3),
    ]


def test_fed_counts(spark):
    rows = spark.createDataFrame([("d1", "0"), ("d1", "1"), ("d2", "0"), ("d1", "0")], "updated_date string, part string")
    found = {(r.updated_date, r.part): r.n_rows for r in feed.fed_counts(rows).collect()}
    assert found == {
        ("d1", "0"): 2, ("d1", "1"): 1, ("d2", "0"): 1, ("d1", None): 3, ("d2", None): 1, (None, None): 4,
    }


def test_shared_folder_is_the_one_of_the_session(spark):
    folder = staging.shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert staging.staged_path(spark, "x").startswith(f"{staging.run_folder(spark)}/x-")
    assert staging.run_folder(spark).startswith(folder.rstrip("/") + "/")
    assert staging.stage(spark.range(5)).count() == 5


def test_a_folder_has_to_be_named():
    class Nothing:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        staging.shared_dir(Nothing)


def test_columns_reach_the_scan(spark, sf_dir, plan):
    from sieveline.plans import standins

    text = plan(profile.corpus_counts(standins.dated_works(spark, sf_dir)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    kept = plan(feed.recent(standins.corpus(spark, sf_dir), standins.dates(spark, sf_dir), on=("id",)))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in kept


def test_cells_that_cannot_be_read_are_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,n,x,d\na,1.0,2,2020-01-01\nb,,1e-3,\nc,-7,"",2020-02-29\n')
    schema = T._parse_datatype_string("id string, n int, x double, d date")
    rows = sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "t.csv"), schema).select("id", "n", "x").collect()))
    assert rows == [("a", 1, 2.0), ("b", None, 0.001), ("c", -7, None)]
    for cell in ("1.5", "one", "99999999999"):
        (tmp_path / "bad.csv").write_text(f"id,n,x,d\na,{cell},,\n")
        with pytest.raises(Exception, match="n is not int"):
            readers.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_partition_columns_are_kept_and_prune(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, updated_date string").write.partitionBy("updated_date").parquet(path)
    table = readers.read_parquet_parts(spark, path)
    assert sorted(map(tuple, table.select("id", "updated_date").collect())) == [("a", "x"), ("b", "y")]
    assert "PartitionFilters: [isnotnull(updated_date" in table.filter("updated_date = 'x'")._jdf.queryExecution().toString()


def test_one_large_gzip_file_is_dealt_anew(spark, tmp_path):
    many = [dict(WORKS[0], id=f"https://openalex.org/W{n}", title="t" * 50 + str(n)) for n in range(2000)]
    write_part(tmp_path, "2023-01-01", "000", many)
    works = readers.read_works(spark, str(tmp_path))
    assert "RebalancePartitions" in works._jdf.queryExecution().optimizedPlan().toString()
    assert works.count() == 2000


def test_staged_tables_of_a_run_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "run_folder", lambda spark: str(tmp_path / "run"))
    staging.stage(spark.range(3))
    assert (tmp_path / "run").exists()
    staging.drop_run(spark)
    assert not (tmp_path / "run").exists()


@pytest.mark.parametrize("bound", [100, 0])
def test_rows_without_a_key_are_no_versions(spark, bound):
    rows = [(None, [1.0], "2023-01-01", "000"), (None, [2.0], "2023-01-02", "000"), ("a", [3.0], "2023-01-01", "000")]
    kept = feed.keep_latest(spark.createDataFrame(rows, VECTORS), bound=bound)
    assert [r.id for r in kept.collect()] == ["a"]


def test_every_fault_of_a_vector(spark):
    nan, inf = float("nan"), float("inf")
    cases = {"a": [1.0, 2.0], "b": [1.0], "c": None, "d": [1.0, None], "e": [nan, 1.0], "f": [1.0, -inf], "g": []}
    rows = spark.createDataFrame([(i, v, "d", "0") for i, v in cases.items()], VECTORS)
    accepted, rejected = feed.split_valid(rows, 2)
    assert [r.id for r in accepted.collect()] == ["a"]
    assert {r.id: r.reason for r in rejected.collect()} == {
        "b": "wrong length", "c": "missing embedding", "d": "missing value", "e": "not a number", "f": "not a number", "g": "wrong length",
    }
