"""The batch job on small five-entity snapshots."""

import glob
import hashlib
import logging
import os
import subprocess
import sys

import pytest

import scholarlake
from scholarlake import ENTITIES, TABLES, entity_table, read_lines, run
from scholarlake.__main__ import main
from scholarlake.plans import job
from scholarlake.sinks import sizing
from test_tables import AUTHOR, WORK


def fill(snapshot):
    for entity, record in {
        "authors": AUTHOR,
        "institutions": {"id": "I1", "geo": {"city": "c"}},
        "publishers": {"id": "P1"},
        "topics": {"id": "T1", "keywords": ["k"]},
        "works": WORK,
    }.items():
        more = [{**record, "id": f"{entity}{n}"} for n in range(30)]
        snapshot.add(entity, "2024-01-01", "part_000.gz", record, "", *more, more[0])
        snapshot.add(entity, "2024-01-02", "part_000.gz", {"id": record["id"]}, *more[:10], {"id": 5})


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{name}.parquet")


def multiset(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_all_entities(spark, snapshot, options):
    fill(snapshot)
    report = run(spark, snapshot.root, snapshot.out, **options)
    assert report.records == dict.fromkeys(ENTITIES, 31)
    assert report.files == dict.fromkeys(ENTITIES, 2)
    assert report.files_processed == 10
    assert report.citation_edges == 31 * 3
    for entity, tables in ENTITIES.items():
        lines = read_lines(spark, snapshot.root, entity)
        for table in tables:
            written = read(spark, snapshot.out, table.name)
            direct = entity_table(lines, table.name)
            assert written.dtypes == direct.dtypes
            assert multiset(written) == multiset(direct)
            assert written.count() == report.rows[table.name]
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/_stage-*")


def test_children_have_parents_and_snappy_is_used(spark, snapshot):
    fill(snapshot)
    run(spark, snapshot.root, snapshot.out)
    for tables in ENTITIES.values():
        parent = read(spark, snapshot.out, tables[0].name)
        for child in tables[1:]:
            rows = read(spark, snapshot.out, child.name)
            orphans = rows.join(parent, rows[child.id_column] == parent["id"], "left_anti")
            assert orphans.count() == 0
    files = glob.glob(f"{snapshot.out}/works.parquet/*.parquet")
    assert files and all(".snappy." in f for f in files)


def test_overwrite_and_file_limit(spark, snapshot):
    fill(snapshot)
    assert run(spark, snapshot.root, snapshot.out, ["topics"]).records == {"topics": 31}
    snapshot.add("topics", "2023-01-01", "part_000.gz", {"id": "only"})
    report = run(spark, snapshot.root, snapshot.out, ["topics"], files_per_entity=1)
    assert report.files == {"topics": 1}
    assert [r.id for r in read(spark, snapshot.out, "topics").collect()] == ["only"]


def test_entity_names(spark, snapshot, caplog):
    fill(snapshot)
    with caplog.at_level(logging.WARNING):
        report = run(spark, snapshot.root, snapshot.out, [" topics", "topics ", "sources"])
    assert report.records == {"topics": 31}
    assert "unknown entity: sources" in caplog.text
    assert os.listdir(snapshot.out) == ["topics.parquet"]


def test_nothing_to_read_gives_empty_tables(spark, snapshot):
    os.makedirs(f"{snapshot.root}/works")
    report = run(spark, snapshot.root, snapshot.out)
    assert report.files_processed == 0 and report.citation_edges == 0
    assert report.rows == dict.fromkeys(TABLES, 0)
    lines = read_lines(spark, snapshot.root, "sources")
    for name in TABLES:
        written = read(spark, snapshot.out, name)
        assert written.dtypes == entity_table(lines, name).dtypes
        assert written.count() == 0


def test_malformed_line_fails_the_run(spark, snapshot):
    fill(snapshot)
    snapshot.add("works", "2024-01-03", "part_000.gz", '{"id":"x"')
    with pytest.raises(Exception, match="MALFORMED"):
        run(spark, snapshot.root, snapshot.out, ["topics", "works"])
    assert not os.path.exists(f"{snapshot.out}/works.parquet")


def test_stage_folder(spark, snapshot, tmp_path):
    fill(snapshot)
    stage = tmp_path / "stage"
    run(spark, snapshot.root, snapshot.out, ["authors"], stage_dir=str(stage))
    assert stage.exists() and not list(stage.iterdir())


def test_command_line(spark, snapshot, capsys):
    fill(snapshot)
    main(["-i", snapshot.root, "-o", snapshot.out, "-e", "topics,publishers", "-f", "1"])
    out = capsys.readouterr().out
    assert "topics: 31 records" in out and "files: 2" in out
    help_text = subprocess.run(
        [sys.executable, "-m", "scholarlake", "--help"],
        capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(__file__)), check=True,
    ).stdout
    assert "--files-per-entity" in help_text


def test_session_settings_are_taken_back(spark, snapshot):
    fill(snapshot)
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "4321")
    try:
        run(spark, snapshot.root, snapshot.out, ["topics"])
        assert spark.conf.get(key) == "4321"
    finally:
        scholarlake.configure(spark)


def test_shuffle_files_go_with_their_job(spark, snapshot, monkeypatch):
    fill(snapshot)
    (key,) = job.FREED
    seen = []
    monkeypatch.setattr(
        job, "table_rows", lambda r, t, rows=job.table_rows: seen.append(spark.conf.get(key)) or rows(r, t)
    )
    before = spark.conf.get(key)
    run(spark, snapshot.root, snapshot.out, ["works"], broadcast_bytes=0)
    assert set(seen) == {"true"} and spark.conf.get(key) == before


def test_the_first_failure_ends_the_run(spark, snapshot):
    fill(snapshot)
    snapshot.add("topics", "2024-01-03", "part_000.gz", '{"id":"x"')
    many = [{**WORK, "id": f"W{n}"} for n in range(3000)]
    for n in range(8):
        snapshot.add("works", f"2024-02-0{n}", "part_000.gz", *many)
    with pytest.raises(Exception, match="MALFORMED"):
        run(spark, snapshot.root, snapshot.out, ["topics", "works"])


def test_the_stage_of_a_failed_run_is_named(spark, snapshot, tmp_path, caplog):
    fill(snapshot)
    snapshot.add("works", "2024-01-03", "part_000.gz", "]")
    stage = tmp_path / "stage"
    with pytest.raises(Exception, match="MALFORMED"):
        run(spark, snapshot.root, snapshot.out, ["works"], stage_dir=str(stage))
    assert str(stage) in caplog.text


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_splittable_files(spark, snapshot, options):
    """Plain text is dealt out to several tasks; the first copy wins all the same."""
    folder = f"{snapshot.root}/works/updated_date=2024"
    os.makedirs(folder)
    records = [
        f'{{"id":"W{n % 5000}","title":"line {n}","referenced_works":["R{n}"]}}' for n in range(15_000)
    ]
    with open(f"{folder}/part_0.txt", "w") as f:
        f.write("\n".join(records) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        lines = read_lines(spark, snapshot.root, "works", pattern="updated_date*/part_*")
        assert lines.select("file_key").distinct().count() > 5
        run(spark, snapshot.root, snapshot.out, ["works"], pattern="updated_date*/part_*", **options)
        direct = entity_table(lines, "works")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {f"W{n}": f"line {n}" for n in range(5000)}
    for df in (read(spark, snapshot.out, "works"), direct):
        rows = df.collect()
        assert {r.id: r.title for r in rows} == want and len(rows) == 5000
    edges = read(spark, snapshot.out, "works_citations").collect()
    assert sorted(map(tuple, edges)) == sorted((f"W{n}", f"R{n}") for n in range(5000))


@pytest.fixture
def many_files(spark, snapshot):
    """A hundred files of works whose tables differ in bytes; returns the records."""
    records = [
        {
            "id": f"W{n}",
            "title": hashlib.sha256(str(n).encode()).hexdigest(),
            "referenced_works": [f"R{n * 31 % 7919}-{k}" for k in range(20)],
            "open_access": {"is_oa": True} if n % 2 else {"oa_url": f"http://x/{n}"},
        }
        for n in range(20_000)
    ]
    for f in range(100):
        snapshot.add("works", f"2024-{f:03}", "part_000.gz", *records[f::100])
    return records


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_files_of_child_tables_have_the_wanted_size(spark, snapshot, many_files, options):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    target = 200_000
    try:
        report = run(
            spark, snapshot.root, snapshot.out, ["works"], file_bytes=target, **options
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert report.citation_edges == 20 * len(many_files)
    counts = {}
    for table in ENTITIES["works"][1:]:
        sizes = [os.path.getsize(f) for f in glob.glob(f"{snapshot.out}/{table.name}.parquet/*.parquet")]
        counts[table.name] = len(sizes)
        assert max(sizes) < 3 * target
        assert len(sizes) <= 1 + 2 * sum(sizes) // target
    assert counts["works_citations"] > 3 and counts["works_locations"] == 1


def test_small_tables_are_one_file(spark, snapshot):
    fill(snapshot)
    run(spark, snapshot.root, snapshot.out, ["works", "authors"])
    for name in ("works_citations", "works_topics", "authors_ids"):
        assert len(glob.glob(f"{snapshot.out}/{name}.parquet/*.parquet")) == 1


def test_the_pilot_is_bounded(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000, numPartitions=200).selectExpr("id", "uuid() AS name").write.parquet(path)
    stored = sizing.stored(spark, path)
    assert stored.files == 200 and len(stored.pilot) == sizing.PILOT_FILES
    assert stored.size == sum(map(os.path.getsize, glob.glob(f"{path}/*.parquet")))
    few = spark.read.parquet(path).coalesce(3)
    few.write.parquet(f"{path}-few")
    assert not sizing.stored(spark, f"{path}-few").pilot
    # Few files, or records that fit one file, are not measured.
    most = -(-sizing.stored(spark, f"{path}-few").size // 1000)
    for where, target, expected in (("-few", 1000, most), ("-few", 1 << 30, 1), ("", 1 << 30, 1)):
        assert sizing.files_of(spark, sizing.stored(spark, path + where), None, target) == expected
    # Half the columns, a fraction of the bytes.
    half = sizing.files_of(spark, stored, lambda r: r.select("id"), 50_000)
    whole = sizing.files_of(spark, stored, lambda r: r, 50_000)
    assert abs(whole - stored.size / 50_000) < 0.1 * whole and half < 0.5 * whole


def test_target_bytes(spark):
    for text, size in (("64MB", 64 << 20), ("1m", 1 << 20), ("5kb", 5 << 10), ("300", 300), ("2g", 2 << 30), ("7b", 7)):
        spark.conf.set(sizing.TARGET, text)
        try:
            assert sizing.target_bytes(spark) == size
        finally:
            spark.conf.unset(sizing.TARGET)
