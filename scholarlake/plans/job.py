"""The batch job: a snapshot directory in, Parquet tables out.

Per entity:

1. scan, parse and type every line once, without a shuffle, and store the
   records as Parquet in the stage folder;
2. find the ids that occur twice from two narrow columns of the stage;
3. write every table from the columns it needs, without the later copies.

The stage lies in shared storage, so a lost executor costs its running tasks
and nothing else.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from scholarlake.operators import dedup
from scholarlake.operators.records import RecordTable, parse_records, table_rows
from scholarlake.plans.entities import ENTITIES
from scholarlake.sinks import scratch, sizing
from scholarlake.sinks.parquet import table_path, write_table
from scholarlake.sources.snapshot import FILE_PATTERN, count_files, read_lines

log = logging.getLogger(__name__)

T = TypeVar("T")


@dataclass
class RunReport:
    """What a run did."""

    files: dict[str, int] = field(default_factory=dict)  # per entity
    rows: dict[str, int] = field(default_factory=dict)  # per table

    @property
    def files_processed(self) -> int:
        return sum(self.files.values())

    @property
    def records(self) -> dict[str, int]:
        return {entity: self.rows[entity] for entity in self.files}

    @property
    def citation_edges(self) -> int:
        return self.rows.get("works_citations", 0)

    def lines(self) -> list[str]:
        return [
            *(f"{entity}: {n} records" for entity, n in self.records.items()),
            f"citation edges: {self.citation_edges}",
            f"files: {self.files_processed}",
        ]


# Session settings for the parser.
SETTINGS = {
    # Of a repeated key the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Records have many columns: a whole stage in one method grows beyond what
    # the JVM compiles (8000 bytes) and would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A record with a value of an unexpected type is read again as a whole: what else the
    # first reading finds in it is not used, and costs an exception for every such value.
    "spark.sql.json.enablePartialResults": "false",
}

# Settings of a run: what is shuffled becomes files of a size, not as many as cores, and
# shuffle files go with the job that wrote them, not when the driver collects its garbage.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
RUN_SETTINGS = {
    **SETTINGS,
    **FREED,
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}

# Where records are shuffled, that is done in parts, one after the other: of so many bytes of
# the stage, which are about fifteen times as many in shuffle files, and at most so many.
PART_BYTES = 16 << 20
PARTS = 16


def configure(spark: SparkSession) -> SparkSession:
    """Set what lazy tables need; ``run`` does it by itself and takes it back."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The settings hold inside and are taken back behind."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    entities: Iterable[str] = tuple(ENTITIES),
    files_per_entity: int = 0,
    pattern: str = FILE_PATTERN,
    stage_dir: str | None = None,
    broadcast_bytes: int = dedup.BROADCAST_BYTES,
    file_bytes: int | None = None,
) -> RunReport:
    """Convert the entities; unknown names are skipped with a warning.

    ``stage_dir`` must be shared by all executors.  It defaults to
    spark.checkpoint.dir, or to the output directory where that is unset.
    ``file_bytes`` is about what a file of a child table has; it defaults to
    spark.sql.adaptive.advisoryPartitionSizeInBytes.
    """
    names = [name.strip() for name in entities]
    for name in names:
        if name not in ENTITIES:
            log.warning("unknown entity: %s", name)
    known = [name for name in dict.fromkeys(names) if name in ENTITIES]

    base = stage_dir or spark.conf.get("spark.checkpoint.dir", None) or output_dir
    stage = f"{base.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    report = RunReport()

    def convert(entity: str) -> None:
        lines = read_lines(spark, input_dir, entity, files_per_entity, pattern)
        tables = ENTITIES[entity]
        target = file_bytes or sizing.target_bytes(spark)
        if len(tables) == 1:
            records, stored = dedup.first_per_id(parse_records(lines, tables)), None
        else:
            records, stored = _staged(
                lines, tables, f"{stage}/{entity}", broadcast_bytes, target
            )

        def write(table: RecordTable) -> None:
            files = None
            # The first table has most of a record's bytes; the others are narrow.
            if stored and table is not tables[0]:
                files = sizing.files_of(spark, stored, lambda r: table_rows(r, table), target)
            path = table_path(output_dir, table.name)
            report.rows[table.name] = write_table(table_rows(records, table), path, files)

        _together(spark, write, tables)
        files = count_files(spark, input_dir, entity, pattern)
        report.files[entity] = min(files, files_per_entity) if files_per_entity > 0 else files

    try:
        with settings(spark, RUN_SETTINGS):
            _together(spark, convert, known)
    except BaseException:
        log.error("the intermediate tables of the failed run are kept in %s", stage)
        raise
    scratch.remove(spark, stage)
    # Threads finish in any order.
    report.files = {name: report.files[name] for name in known}
    return report


def stage_records(lines: DataFrame, tables: Sequence[RecordTable]) -> DataFrame:
    """What the stage holds: every line parsed, with its place."""
    return parse_records(lines, tables).drop("arrival")


def _staged(
    lines: DataFrame,
    tables: Sequence[RecordTable],
    path: str,
    broadcast_bytes: int,
    file_bytes: int,
) -> tuple[DataFrame, sizing.Stored]:
    """First records, from all records stored once; and what is stored."""
    spark = lines.sparkSession
    # Read a few times and then removed: what it takes on disk counts, but dictionaries, which
    # most of the strings are too many for, cost more time than they save bytes.
    stage = stage_records(lines, tables).write.option("compression", "zstd")
    stage.option("parquet.enable.dictionary", "false").parquet(f"{path}/records")
    # Filtered here and not above, see parse_records.
    staged = spark.read.parquet(f"{path}/records").where("id is not null")
    dedup.duplicated_ids(staged).write.parquet(f"{path}/duplicated")
    duplicated = spark.read.parquet(f"{path}/duplicated")
    stored = sizing.stored(spark, f"{path}/records")
    # A table's files are packed from whole files of records, so these are no larger.
    files = max(1, stored.files, -(-stored.size // file_bytes))
    # A part has files for all tasks that run at a time.
    at_a_time = spark.sparkContext.defaultParallelism
    parts = max(1, min(PARTS, stored.files // at_a_time, stored.size // PART_BYTES))
    # Every table sends its own copy, side by side.
    kept = dedup.keep_first(
        staged, duplicated, f"{path}/losers", broadcast_bytes // len(tables),
        f"{path}/kept", files, parts,
    )
    if scratch.exists(spark, f"{path}/kept"):
        scratch.remove(spark, f"{path}/records")
        stored = sizing.stored(spark, f"{path}/kept")
    return kept, stored


def _together(spark: SparkSession, task: Callable[[T], None], over: Sequence[T]) -> None:
    """Submit Spark jobs side by side; the first failure cancels the others and is raised."""
    if not over:
        return
    context = spark.sparkContext
    tag = f"scholarlake-{uuid.uuid4().hex}"

    def tagged(item: T) -> None:
        context.addJobTag(tag)
        task(item)

    with ThreadPoolExecutor(len(over)) as pool:
        submitted = [pool.submit(inheritable_thread_target(spark)(tagged), item) for item in over]
        done, others = wait(submitted, return_when=FIRST_EXCEPTION)
        failed = next((future for future in done if future.exception()), None)
        if failed is not None:
            context.cancelJobsWithTag(tag)
            for future in others:
                future.cancel()
    if failed is not None:
        failed.result()
