"""What several operators share: stored tables, row keys, names, hash splits."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scholarlake.sinks import scratch

SLICE_ROWS = 512


def shipped_code(spark: SparkSession) -> None:
    """Send this package to the workers, once per session.

    So that they can import it wherever they run; a job that was submitted with
    --py-files has it already.
    """
    if spark.conf.get("scholarlake.shipped", None):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="scholarlake-"), "scholarlake.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    spark.conf.set("scholarlake.shipped", "true")


def stored(df: DataFrame) -> DataFrame:
    """Write a table into the folder that the cluster shares and read it back.

    Cuts the lineage: what follows is recomputed from the files if executors are
    lost.  The files go when the session ends.
    """
    path = scratch.new_folder(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, changed where the table has them already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two non-null longs that tell rows apart: the id, and a hash of the text.

    Rows that agree in both are repeated rows; every operator gives them equal
    results.
    """
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)),
        F.xxhash64(F.col(text), F.col(text).isNull(), F.col(doc_id).isNull()),
    )


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a null id."""
    return F.crc32(F.col(doc_id).cast("string")).cast("long") % modulus


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for low in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(low, SLICE_ROWS)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str
) -> DataFrame:
    """Arrow batches through ``fn``, which returns the columns of ``schema``.

    A batch (spark.sql.execution.arrow.maxRecordsPerBatch rows) is handed on in
    slices, so that a worker holds the Python objects of few rows at a time.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict(fn(part), schema=arrow)

    return df.mapInArrow(over, schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, size: int, learnable: Column
) -> DataFrame:
    """(doc_id, text, label), stored: at most ``size`` texts of either label, chosen by hash.

    ``learnable`` says of a doc_id whether its label may be used.  Only the
    chosen ids, at most twice ``size``, are broadcast.  Of repeated labels the
    smallest counts, of several texts of an id the one of the smallest hash.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learnable)
        .groupBy("doc_id")
        .agg(F.min(F.col(label).cast("int")).alias("label"))
    )
    parts = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        for value in (0, 1)
    ]
    chosen = parts[0].unionAll(parts[1])
    found = docs.where("text IS NOT NULL").select("doc_id", "text")
    # Combined in each task first: an id with many rows sends one per task.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    rows = found.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(one)
    return stored(rows.select("doc_id", "one.text", "label"))
