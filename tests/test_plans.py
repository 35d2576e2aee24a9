"""What the plans look like, since that decides how they scale."""

import pytest

from scholarlake import ENTITIES, TABLES, entity_table, read_lines
from scholarlake.operators import dedup
from scholarlake.operators.records import table_rows
from scholarlake.plans.job import stage_records
from workloads import lines as workload_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def scanned(spark, snapshot):
    snapshot.add("works", "2024", "part_0.gz", {"id": "a"})
    return read_lines(spark, snapshot.root, "works")


@pytest.mark.parametrize("name", TABLES)
def test_one_shuffle_one_parse(scanned, name):
    text = plan(entity_table(scanned, name))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange") == 1  # no file list is joined to the lines
    # The typed parse, and the strict one for lines that need it.
    assert text.count("from_json(") == 2
    # Every task drops its own later copies before the shuffle.
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_read_keys_are_parsed(scanned):
    text = plan(entity_table(scanned, "works_citations"))
    assert "referenced_works" in text
    assert "abstract_inverted_index" not in text and "authorships" not in text


def test_stage_is_written_without_a_shuffle(scanned):
    text = plan(stage_records(scanned, ENTITIES["works"]))
    assert "hashpartitioning" not in text and "SinglePartition" not in text
    assert text.count("from_json(") == 2


@pytest.fixture
def stage(spark, scanned, tmp_path):
    path = str(tmp_path / "stage")
    stage_records(scanned.union(scanned), ENTITIES["works"]).write.parquet(path)
    return spark.read.parquet(path)


def test_duplicates_are_found_from_narrow_columns(stage):
    text = plan(dedup.duplicated_ids(stage))
    assert "ReadSchema: struct<id:string,file_key:string,line_no:bigint>" in text
    assert text.count("Exchange") == 1
    # The first half of the aggregation is before the shuffle.
    assert text.index("partial_min") > text.index("Exchange") > text.index("functions=[min")


def test_tables_from_the_stage_shuffle_nothing(spark, stage, tmp_path):
    path = str(tmp_path / "duplicated")
    dedup.duplicated_ids(stage).write.parquet(path)
    kept = dedup.keep_first(stage, spark.read.parquet(path), str(tmp_path / "losers"))
    for table in ENTITIES["works"]:
        text = plan(table_rows(kept, table))
        assert "hashpartitioning" not in text
        scan = next(part for part in text.split("ReadSchema: ")[1:] if "line_no" in part)
        assert set(table.shape) <= {k for k in table.shape if k in scan}
        others = {k for t in ENTITIES["works"] for k in t.shape} - set(table.shape)
        assert not [k for k in others if f"{k}:" in scan.splitlines()[0]]


def test_many_duplicates_are_matched_by_rank(spark, stage, tmp_path):
    path = str(tmp_path / "duplicated")
    dedup.duplicated_ids(stage).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = dedup.keep_first(stage, spark.read.parquet(path), str(tmp_path / "losers"), 0)
        text = plan(table_rows(kept, TABLES["works_citations"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [file_key" in text and "LeftAnti" in text
    assert "hashpartitioning(id" not in text and text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", [t.name for t in ENTITIES["works"]])
def test_sized_tables_shuffle_nothing(stage, name):
    """Read splits are packed into tasks; no row moves for the size of files."""
    text = plan(table_rows(stage, TABLES[name]).coalesce(3))
    assert "Exchange" not in text and "Coalesce 3" in text
    assert text.index("Coalesce") < text.index("FileScan")


def test_the_file_list_is_not_collected(spark, snapshot, monkeypatch):
    from scholarlake.sources import snapshot as source

    snapshot.add("works", "2024", "part_0.gz", {"id": "a"})
    monkeypatch.setattr(source, "list_files", None)
    assert read_lines(spark, snapshot.root, "works").count() == 1


def test_workload_scans_are_pruned(spark):
    lines = workload_lines.work_lines(spark, "/root/testdata/sf0.001")
    text = plan(entity_table(lines, "works_topics"))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "l_shipdate" in schema and "l_tax" not in schema and "l_extendedprice" not in schema
