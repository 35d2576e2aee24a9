"""How many files a table gets: as many as its bytes need, known before it is written.

A table cut out of stored records is written by the tasks that read them, without a
shuffle.  How many read splits one task takes follows from the bytes the table has per
byte of the records, which a pilot measures: the same rows cut out of a few files of
the records, chosen by hash, written beside them.  The pilot reads one file in
sixteen, at least one and at most four; small records and few files need none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlake.sinks import scratch

TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PILOT_FILES = 4
PILOT_SHARE = 16  # one file in so many
FEW_FILES = 4  # below that a pilot would be a great part of the work


@dataclass(frozen=True)
class Stored:
    """Stored records: their bytes, their number of files, and those for the pilot."""

    path: str
    size: int
    files: int
    pilot: tuple[str, ...]
    pilot_size: int


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of a table's files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length")


def target_bytes(spark: SparkSession) -> int:
    """The size a file should have about: Spark's own target for a partition."""
    text = spark.conf.get(TARGET).strip().lower()
    number = text.rstrip("kmgtib")
    unit = text[len(number) :][:1]
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def stored(spark: SparkSession, path: str) -> Stored:
    listed = _listed(spark, path)
    files, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    most = 0 if files < FEW_FILES else max(1, min(PILOT_FILES, files // PILOT_SHARE))
    chosen = listed.orderBy(F.xxhash64("path"), "path").limit(most).collect() if most else []
    return Stored(path, size, files, tuple(r.path for r in chosen), sum(r.length for r in chosen))


def files_of(
    spark: SparkSession,
    records: Stored,
    rows: Callable[[DataFrame], DataFrame],
    target: int,
) -> int:
    """The number of files for ``rows`` of all these records.

    A table has hardly more bytes than the records it is cut out of, so where these fit
    one file nothing is measured, and without a pilot their bytes count.
    """
    most = max(1, -(-records.size // target))
    if most == 1 or not records.pilot_size:
        return most
    path = f"{records.path}-pilot-{uuid.uuid4().hex}"
    rows(spark.read.parquet(*records.pilot)).write.option("compression", "snappy").parquet(path)
    written = _listed(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    scratch.remove(spark, path)
    return max(1, -(-written * records.size // (records.pilot_size * target)))
