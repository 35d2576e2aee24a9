"""First record per id, exact and over all files.

"First" is the order of (file_key, line_no): the sorted paths, then the lines of
a file.  Later records are dropped with all their child rows.

There are two physical forms.  ``first_per_id`` suits one result from records
that are read once; it shuffles what it is given, for works with every
abstract.  ``duplicated_ids`` with ``keep_first`` suits stored records that feed
several tables: it shuffles ids and places only, never whole records, unless
nothing that tells later copies may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to here the duplicated ids are broadcast, or else the lines of later copies as
# bitmaps; above, records are matched by their unique place in a shuffle join.
BROADCAST_BYTES = 64 << 20
BYTES_PER_ROW = 64  # overhead of a row in a broadcast table, on the high side

BITMAP_BYTES = 4096  # one of Spark's bitmaps, for 32,768 lines

PLACE = ("file_key", "line_no")  # unique per record


def first_per_id(records: DataFrame) -> DataFrame:
    """The records that have an id, once each; one shuffle on id.

    Before it, every task keeps just its own first record per id (Spark's
    window group limit), so an id that fills a third of the input sends one
    record per task.
    """
    order = Window.partitionBy("id").orderBy(*PLACE, "arrival")
    return (
        records.where("id is not null")
        .withColumn("nth", F.row_number().over(order))
        .where("nth = 1")
        .drop("nth", *PLACE, "arrival")
    )


def duplicated_ids(records: DataFrame) -> DataFrame:
    """Ids that occur more than once, with the place of the record to keep.

    One shuffle of narrow columns, combined in each task first.
    """
    return (
        records.groupBy("id")
        .agg(F.min(F.struct(*PLACE)).alias("keep"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("id", "keep")
    )


def keep_first(
    records: DataFrame,
    duplicated: DataFrame,
    losers_path: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    kept_path: str | None = None,
    kept_files: int = 1,
    parts: int = 1,
) -> DataFrame:
    """The first record of every id.  ``duplicated`` must be stored, it is measured here.

    No duplicates: nothing to do.  Few duplicated ids: a broadcast join drops
    the later copies where they are read, however many there are.  Many: the
    places of later copies are stored at ``losers_path``, once for all tables.  As
    bitmaps of the lines of a file they take a bit per line, and are broadcast if these
    fit.  Otherwise records are matched by place, which is unique, so no id can overload
    a task.  With a ``kept_path`` the records that stay are stored there, so that they
    are shuffled once and not for every table; by the hash of the place, in at least so many
    files and at least one per shuffle partition.
    ``parts``: the files of the records are dealt out to so many jobs, one after the
    other, so that only a part of the records lies in shuffle files at a time (if Spark
    removes these after a job).
    """
    ids, id_bytes = duplicated.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length("id") + F.octet_length("keep.file_key")), F.lit(0)),
    ).first()
    if ids == 0:
        return records
    place = F.struct(*PLACE)
    if id_bytes + ids * BYTES_PER_ROW <= broadcast_bytes:
        first = F.col("keep").isNull() | (F.col("keep") == place)
        return records.join(F.broadcast(duplicated), "id", "left").where(first).drop("keep")
    # Stored places take a few bytes each, in memory hundreds: Spark goes by the former and
    # would send them through the driver, for every table.
    # Files of other parts are not read, nor later copies in them.
    part_of = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(parts))
    in_parts = kept_path is not None and parts > 1
    place_of = [*PLACE, part_of.alias("part")] if in_parts else [*PLACE]
    places = records.select("id", *place_of).join(duplicated.hint("merge"), "id").where(
        place != F.col("keep")
    )
    places.drop("id", "keep").write.mode("overwrite").parquet(losers_path)
    spark = records.sparkSession
    losers = spark.read.parquet(losers_path)
    if broadcast_bytes and _bitmap_bytes(losers) <= broadcast_bytes:
        _bitmaps(losers).write.mode("overwrite").parquet(f"{losers_path}-bitmaps")
        return _without(records, spark.read.parquet(f"{losers_path}-bitmaps"))
    if kept_path is None:
        return records.join(losers.hint("merge"), list(PLACE), "left_anti")
    for part in range(parts):
        own = records.where(part_of == part) if in_parts else records
        lost = losers.where(F.col("part") == part).select(*PLACE) if in_parts else losers
        kept = _unmatched(own.repartition(-(-kept_files // parts), *PLACE), lost)
        kept.write.mode("append").option("parquet.enable.dictionary", "false").parquet(kept_path)
    return spark.read.parquet(kept_path)


def _unmatched(records: DataFrame, losers: DataFrame) -> DataFrame:
    """The records, dealt out by their place, that are no losers.

    Places are narrow: they are hashed, so that records need not be sorted.  An outer join,
    since Spark would do an anti join before records are dealt out, and shuffle them for it.
    """
    lost = losers.withColumn("lost", F.lit(True)).hint("shuffle_hash")
    joined = records.join(lost, list(PLACE), "left")
    return joined.where("lost is null").select(*records.columns)


def _chunk() -> Column:
    """The number of the bitmap a line is in."""
    return F.bitmap_bucket_number(F.col("line_no") + 1)


def _bit() -> Column:
    """The bit of a line there."""
    return F.bitmap_bit_position(F.col("line_no") + 1)


def _bitmap_bytes(losers: DataFrame) -> int:
    """What the bitmaps of all losers take in memory, on the high side."""
    size = F.octet_length("file_key") + F.lit(BITMAP_BYTES + BYTES_PER_ROW)
    chunks = losers.select("file_key", _chunk().alias("chunk")).distinct()
    return chunks.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]


def _bitmaps(losers: DataFrame) -> DataFrame:
    """(file_key, chunk, bits): a bit for every line that is a later copy."""
    return losers.groupBy("file_key", _chunk().alias("chunk")).agg(
        F.bitmap_construct_agg(_bit()).alias("bits")
    )


def _without(records: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The records whose bit is not set; nothing is shuffled."""
    byte = F.substring("bits", (F.shiftright(_bit(), 3) + 1).cast("int"), F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    lost = F.getbit(number, _bit().bitwiseAND(7).cast("int")) == 1
    joined = records.withColumn("chunk", _chunk()).join(
        F.broadcast(bitmaps), ["file_key", "chunk"], "left"
    )
    return joined.where(F.col("bits").isNull() | ~lost).select(*records.columns)
