"""First record per id, in both physical forms."""

import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from scholarlake import TABLES, entity_table
from scholarlake.operators import dedup
from scholarlake.operators.records import parse_records, table_rows
from scholarlake.plans import job


def make(spark, rows):
    """rows of (file_key, line_no, id, references)."""
    return spark.createDataFrame(
        [
            (f"{f:02}", n, f'{{"id":"{i}","referenced_works":{[f"{f}-{n}"] * r}}}'.replace("'", '"'))
            for f, n, i, r in rows
        ],
        "file_key string, line_no long, value string",
    )


def sample(seed, size=3000):
    """A third of all lines has one id; half of the others occur once."""
    rng = random.Random(seed)
    rows = []
    for n in range(size):
        id = "hot" if n % 3 == 0 else f"u{n}" if n % 3 == 1 else f"r{rng.randrange(200)}"
        rows.append((rng.randrange(20), n, id, rng.randrange(3)))
    return rows


def expected(rows):
    first = {}
    for f, n, i, r in sorted(rows):
        first.setdefault(i, (f, n, r))
    return sorted((i, f"{f}-{n}") for i, (f, n, r) in first.items() for _ in range(r))


def staged(spark, rows, tmp_path, broadcast_bytes):
    table = TABLES["works_citations"]
    path = str(tmp_path / "records")
    parse_records(make(spark, rows), [table]).drop("arrival").write.parquet(path)
    records = spark.read.parquet(path)
    dedup.duplicated_ids(records).write.parquet(str(tmp_path / "duplicated"))
    duplicated = spark.read.parquet(str(tmp_path / "duplicated"))
    return table_rows(
        dedup.keep_first(records, duplicated, str(tmp_path / "losers"), broadcast_bytes), table
    )


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_window_form(spark, seed):
    rows = sample(seed)
    assert result(entity_table(make(spark, rows), "works_citations")) == expected(rows)


@pytest.mark.parametrize("broadcast_bytes", [dedup.BROADCAST_BYTES, 0])
def test_stored_forms(spark, tmp_path, broadcast_bytes):
    rows = sample(3)
    df = staged(spark, rows, tmp_path, broadcast_bytes)
    assert result(df) == expected(rows)
    assert (tmp_path / "losers").exists() == (broadcast_bytes == 0)


def test_stored_form_without_duplicates(spark, tmp_path):
    rows = [(0, n, f"u{n}", 1) for n in range(50)]
    assert result(staged(spark, rows, tmp_path, 1)) == expected(rows)


def test_order_of_lines_in_partitions_does_not_matter(spark):
    rows = sample(4, 600)
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = make(spark, rows).repartition(seed * 3, F.rand(seed))
        assert result(entity_table(df, "works_citations")) == expected(rows)


def test_children_of_dropped_records_do_not_appear(spark):
    rows = [(0, 0, "a", 0), (0, 1, "a", 2), (1, 0, "b", 1), (1, 1, "b", 2)]
    assert result(entity_table(make(spark, rows), "works_citations")) == [("b", "1-0")]


def twice(lines):
    """Two files with an id on each line number; the copies in the second one are lost."""
    return [(f, n, f"u{n}", 1) for f in (0, 1) for n in lines]


def stored(spark, rows, tmp_path, files=1):
    table = TABLES["works_citations"]
    path = str(tmp_path / "records")
    parsed = parse_records(make(spark, rows), [table]).drop("arrival")
    parsed.repartition(files, "line_no").write.parquet(path)
    records = spark.read.parquet(path)
    dedup.duplicated_ids(records).write.parquet(str(tmp_path / "duplicated"))
    return table, records, spark.read.parquet(str(tmp_path / "duplicated"))


def test_many_duplicates_are_told_by_a_bit_per_line(spark, tmp_path):
    """Their ids do not fit, their lines do: records are neither shuffled nor stored again."""
    edges = [*range(2000), 32766, 32767, 32768, 32769, 65535, 65536, 8_000_000_000]
    rows = [*twice(edges), (1, 7_777, "once", 2), (1, 40_000, "u5", 1)]
    table, records, duplicated = stored(spark, rows, tmp_path)
    limit = 60_000
    assert duplicated.count() * dedup.BYTES_PER_ROW > limit
    kept_path = tmp_path / "kept"
    kept = dedup.keep_first(
        records, duplicated, str(tmp_path / "losers"), limit, str(kept_path), 3
    )
    assert kept.columns == records.columns and not kept_path.exists()
    df = table_rows(kept, table)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert result(df) == expected(rows)


def shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = env.blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_records_are_shuffled_in_parts_that_leave_nothing(spark, tmp_path, monkeypatch):
    rows = twice(range(500))
    table, records, duplicated = stored(spark, rows, tmp_path, 12)
    read = []
    repartition = type(records).repartition

    def seen(df, *args):
        read.append(df.count())
        return repartition(df, *args)

    monkeypatch.setattr(type(records), "repartition", seen)
    before = shuffle_files(spark)
    with job.settings(spark, job.FREED):
        kept = dedup.keep_first(
            records, duplicated, str(tmp_path / "losers"), 0, str(tmp_path / "kept"), 6, 3
        )
    assert len(read) == 3 and sum(read) == len(rows) and max(read) < len(rows)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert result(table_rows(kept, table)) == expected(rows)
