"""What grows with the input must not go through the driver, one task or many shuffles."""

from pyspark.sql import functions as F

from scholarlake import ENTITIES, TABLES
from scholarlake.functions import json_numbers as numbers
from scholarlake.operators import dedup
from scholarlake.operators.records import parse_records, table_rows
from scholarlake.plans import job
from workloads import lines as workload_lines
from workloads.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stage(spark, tmp_path):
    """Records of which every id occurs twice, and their duplicated ids."""
    rows = [(f"f{n % 2}", n, f'{{"id":"W{n // 2}","referenced_works":["R{n}"]}}') for n in range(200)]
    lines = spark.createDataFrame(rows, "file_key string, line_no long, value string")
    job.stage_records(lines, ENTITIES["works"]).write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    dedup.duplicated_ids(records).write.parquet(str(tmp_path / "duplicated"))
    return records, spark.read.parquet(str(tmp_path / "duplicated"))


def test_many_duplicates_are_not_broadcast_for_their_small_files(spark, tmp_path):
    records, duplicated = stage(spark, tmp_path)
    kept = dedup.keep_first(records, duplicated, str(tmp_path / "losers"), 0)
    assert "Broadcast" not in plan(kept)


def test_many_duplicates_shuffle_records_once(spark, tmp_path):
    records, duplicated = stage(spark, tmp_path)
    kept = dedup.keep_first(
        records, duplicated, str(tmp_path / "losers"), 0, str(tmp_path / "kept"), 3
    )
    for table in ENTITIES["works"]:
        text = plan(table_rows(kept, table))
        assert "Exchange" not in text and "Join" not in text
    edges = table_rows(kept, TABLES["works_citations"]).collect()
    assert sorted(map(tuple, edges)) == sorted((f"W{n}", f"R{2 * n}") for n in range(100))


def test_tables_share_the_bytes_that_may_be_broadcast(spark, tmp_path, monkeypatch):
    seen = []

    def keep_first(records, duplicated, losers, limit, *more):
        seen.append(limit)
        return records

    monkeypatch.setattr(job.dedup, "keep_first", keep_first)
    rows = spark.createDataFrame([("f", 0, '{"id":"a"}')], "file_key string, line_no long, value string")
    job._staged(rows, ENTITIES["works"], str(tmp_path / "s"), 600, 1 << 20)
    assert seen == [600 // len(ENTITIES["works"])]


def test_bytes_of_a_line_are_validated_once(spark):
    rows = spark.createDataFrame([("f", 0, "{}")], "file_key string, line_no long, value string")
    text = plan(parse_records(rows, [TABLES["works_citations"]]))
    assert text.count("validateUTF8String") + text.count("validate_utf8") == 1


def test_zero_is_seen_in_the_value(spark):
    texts = {"0": True, '{"a":[0,2]}': True, '{"a":10}': False, '["x",0.5]': False, "[1,0]": True}
    df = spark.createDataFrame([(t, w) for t, w in texts.items()], "t string, want boolean")
    assert df.where(numbers.zero(F.col("t")) != F.col("want")).collect() == []


def test_text_of_a_snapshot_is_not_shuffled(spark):
    text = plan(workload_lines.work_lines(spark, SMALL, in_order=True))
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange rangepartitioning")


def test_narrow_rows_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(workload_lines, "ROWS_PER_TASK", 10)
    for lines in (workload_lines.topic_lines, workload_lines.work_lines):
        assert "REPARTITION_BY_NUM" in plan(lines(spark, SMALL))
    assert "REPARTITION_BY_NUM" in plan(QUERIES["json_text_sorted_keys"](spark, SMALL))


def test_what_is_parsed_is_computed_before_the_parser(spark):
    rows = spark.createDataFrame([("f", 0, "{}")], "file_key string, line_no long, value string")
    records = parse_records(rows, [TABLES["works_citations"]])
    text = records._jdf.queryExecution().optimizedPlan().toString()
    steps = [" ".join(step.split()) for step in text.split("Project [")]
    parsers = [step for step in steps if "from_json(" in step]
    assert len(parsers) == 2
    # No validation and no concatenation stands in the argument of a parser.
    assert not any("validateUTF8String" in step or "concat({" in step for step in parsers)
    # Blank lines and values that are no objects, which the parser would fail on, stay out.
    assert any("CASE WHEN StartsWith(ltrim(value" in step and "concat({" in step for step in steps)


def test_records_that_stay_are_shuffled_once_and_not_sorted(spark, tmp_path):
    records, _ = stage(spark, tmp_path)
    losers = records.where("line_no % 2 = 1").select(*dedup.PLACE)
    kept = dedup._unmatched(records.repartition(3, *dedup.PLACE), losers)
    text = plan(kept)
    # The records and the places, once each.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Exchange") == 2
    assert "Sort" not in text and "ShuffledHashJoin" in text
    assert kept.columns == records.columns
    assert sorted(r.line_no for r in kept.collect()) == list(range(0, 200, 2))


def test_a_part_has_files_for_all_that_runs_at_a_time(spark, tmp_path, monkeypatch):
    seen = []

    def keep_first(records, duplicated, losers, limit, kept, files, parts):
        seen.append(parts)
        return records

    monkeypatch.setattr(job.dedup, "keep_first", keep_first)
    monkeypatch.setattr(job, "PART_BYTES", 1)
    files = 3 * spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame(
        [(f"f{n}", 0, f'{{"id":"W{n}"}}') for n in range(files)],
        "file_key string, line_no long, value string",
    ).repartitionByRange(files, "file_key")
    job._staged(rows, ENTITIES["works"], str(tmp_path / "s"), 600, 1 << 20)
    assert 1 <= seen[0] <= 3


def test_rows_are_sorted_before_they_become_text(spark):
    text = plan(workload_lines.work_texts(spark, SMALL))
    assert text.count("Sort [") == 1 and "Generate" not in text
    assert text.index("concat(") < text.index("Sort [")
    lines = workload_lines.work_lines(spark, SMALL).select(
        workload_lines.month(F.date_from_unix_date(F.col("file_key").cast("int"))), "value"
    )
    texts = workload_lines.work_texts(spark, SMALL)
    split = texts.select("month", F.explode(F.split("value", "\n")).alias("value"))
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, lines.collect()))


def test_null_objects_are_told_from_missing_ones_without_another_parse(spark):
    """Whether a key is there is all that is read again, escaped keys included."""
    values = {
        "a": '{"id":"a","open_access":null}',
        "b": '{"id":"b"}',
        "c": '{"id":"c","title":"\\u0041"}',
        "d": '{"id":"d","open_\\u0061ccess":null}',
        "e": '{"id":"e","title":"\\"open_access\\":"}',
        "f": '{"id":"f","open_access":{"is_oa":true}}',
        "g": '{"id":"g","x":{"open_access":null}}',
        "h": '{"id":"h","open_access":{"is_oa":true},"open_access":null}',
        "i": '{"id":"i","open_access":[1]}',
        "j": '{"id":"j","open_access":""}',
    }
    rows = spark.createDataFrame(
        [("f", n, v) for n, v in enumerate(values.values())],
        "file_key string, line_no long, value string",
    )
    records = parse_records(rows, ENTITIES["works"])
    text = records._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 2
    found = {r.work_id: r.is_oa for r in table_rows(records, TABLES["works_open_access"]).collect()}
    assert found == {"a": None, "d": None, "f": True, "h": None, "i": None, "j": None}


def test_a_record_is_read_again_as_a_whole_without_exceptions_for_each_value(spark):
    assert job.SETTINGS["spark.sql.json.enablePartialResults"] == "false"
    value = (
        '{"id":"a","cited_by_count":"7","authorships":[{"author":{"id":"A"},'
        '"institutions":[7,null,{"id":5},{"id":"I"}]},"x",null,{"author":{"id":7}}]}'
    )
    rows = spark.createDataFrame([("f", 0, value)], "file_key string, line_no long, value string")
    with job.settings(spark, job.SETTINGS):
        records = parse_records(rows, ENTITIES["works"])
        found = table_rows(records, TABLES["works_authorships"]).collect()
        work = table_rows(records, TABLES["works"]).first()
    assert [(r.author_id, r.institution_id) for r in found] == [("A", "I")]
    assert work.cited_by_count == 0
