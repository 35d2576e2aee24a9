"""Packing documents into bins of fixed capacity: best fit under conflicts.

A bin holds at most one piece of a source and at most one of a duplicate
cluster.  Documents longer than a bin are cut: full pieces fill a bin each, the
rest is packed like a document.  Pieces are placed by falling length into the
bin with the least sufficient room whose bitmaps of sources and of clusters do
not have theirs; if that bin is taken, the search goes on to its successor in
the order of room, until one fits or a bin is opened.

Packing is done in groups of about ``group_size`` documents, dealt out by hash:
a hot source or cluster spreads over all groups, and a group's rows are only ids
and numbers.  How a group is packed does not depend on the partitions.

Documents of length 0 (null or empty texts) take no room and are in no bin.
Null sources and null clusters conflict with nothing.  Repeated rows are pieces
of their own that conflict with each other through their cluster.
"""

from __future__ import annotations

import hashlib
from bisect import insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.common import map_batches, stored
from scholarlake.llm.tokens import bytes_of

CAPACITY = 2048  # words
GROUP_SIZE = 4096  # documents
GROUP_BITS = 20  # of a bin's number; the rest is the group's
COPIES = 4096  # of a repeated row that one task deals out at a time


def best_fit(
    lengths: list[int], sources: list[int], clusters: list[int], capacity: int
) -> list[int]:
    """The bin of each piece.  Pieces come by falling length; -1 conflicts with nothing.

    Sources and clusters are small numbers, bits of a bin's bitmaps.
    """
    bins: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins, oldest first
    rooms = 0  # bit r is set if some bin has room r
    has_source: list[int] = []
    has_cluster: list[int] = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        chosen = -1
        left = rooms >> length
        room = length
        while left:
            step = (left & -left).bit_length() - 1
            room += step
            for number in by_room[room]:
                if not has_source[number] & source_bit and not has_cluster[number] & cluster_bit:
                    chosen = number
                    break
            if chosen >= 0:
                break
            left >>= step + 1
            room += 1
        if chosen < 0:
            chosen, room = len(has_source), capacity
            has_source.append(0)
            has_cluster.append(0)
        else:
            by_room[room].remove(chosen)
            if not by_room[room]:
                rooms &= ~(1 << room)
        has_source[chosen] |= source_bit
        has_cluster[chosen] |= cluster_bit
        room -= length
        if room:
            insort(by_room[room], chosen)
            rooms |= 1 << room
        bins.append(chosen)
    return bins


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, length, cluster) of (doc_id, text, source).

    The length is in words of ASCII white space.  A cluster is a hash of the text
    without white space, lower-cased in ASCII: copies, up to case and layout.
    """

    def measure(batch: pa.RecordBatch) -> dict:
        lengths, clusters = [], []
        for text in bytes_of(batch.column("text")):
            words = text.lower().split()
            lengths.append(len(words))
            clusters.append(hashlib.blake2b(b"".join(words), digest_size=16).digest())
        kept = {c: batch.column(c) for c in ("doc_id", "source")}
        return kept | {"length": lengths, "cluster": clusters}

    return map_batches(
        docs.select("doc_id", F.col("source").cast("string"), "text"),
        measure,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string,"
        " length bigint, cluster binary",
    )


def packed(
    items: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE
) -> DataFrame:
    """Per piece of (doc_id, length, source, cluster): where it is packed.

    doc_id, piece, start and length of the piece in the document, bin (a number
    unique over all groups), room (what its bin has left in the end).
    """
    # Repeated rows are counted first and dealt out one by one; of a row with many
    # copies, ranges of them are dealt out first, so that no task makes them all.
    counted = stored(
        items.where("length > 0").groupBy("doc_id", "length", "source", "cluster").agg(
            F.count(F.lit(1)).alias("copies")
        )
    )

    def copies(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last)).alias("copy")

    row = ("doc_id", "length", "source", "cluster")
    few = counted.where(F.col("copies") <= COPIES).select(*row, copies(F.lit(1), F.col("copies")))
    ranges = counted.where(F.col("copies") > COPIES).select(
        *row,
        "copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("begin"),
    )
    many = ranges.repartition("doc_id", "begin").select(
        *row, copies(F.col("begin") + 1, F.least(F.col("begin") + COPIES, "copies"))
    )
    single = few.unionAll(many)
    total = counted.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_size))
    dealt = single.select(
        F.pmod(F.xxhash64("doc_id", "length", "source", "cluster", "copy"), F.lit(groups)).alias(
            "group"
        ),
        "doc_id",
        "copy",
        F.col("length").cast("long").alias("length"),
        F.xxhash64("source").alias("source_hash"),
        F.col("source").isNull().alias("no_source"),
        F.xxhash64("cluster").alias("cluster_hash"),
        F.col("cluster").isNull().alias("no_cluster"),
    )

    def pack(key: tuple[int], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["doc_id", "length", "source_hash", "cluster_hash", "copy"], ignore_index=True
        )
        full = rows.loc[rows.index.repeat(rows["length"] // capacity)]
        full = full.assign(piece=full.groupby(level=0).cumcount(), size=capacity)
        rest = rows[rows["length"] % capacity > 0]
        rest = rest.assign(piece=rest["length"] // capacity, size=rest["length"] % capacity)
        rest = rest.sort_values("size", ascending=False, kind="stable")

        def bits(name: str) -> list[int]:
            codes = pd.factorize(rest[f"{name}_hash"])[0]
            codes[rest[f"no_{name}"].to_numpy(bool)] = -1
            return codes.tolist()

        rest["bin"] = best_fit(rest["size"].tolist(), bits("source"), bits("cluster"), capacity)
        opened = int(rest["bin"].max()) + 1 if len(rest) else 0
        full["bin"] = range(opened, opened + len(full))
        out = pd.concat([rest, full])
        room = capacity - out.groupby("bin")["size"].transform("sum")
        return pd.DataFrame(
            {
                "doc_id": out["doc_id"],
                "piece": out["piece"],
                "start": out["piece"] * capacity,
                "length": out["size"],
                "bin": (int(key[0]) << GROUP_BITS) + out["bin"],
                "room": room,
            }
        )

    kind = items.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("group").applyInPandas(
        pack,
        f"doc_id {kind}, piece bigint, start bigint, length bigint, bin bigint, room bigint",
    )


def packed_documents(
    docs: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE
) -> DataFrame:
    """``packed`` for (doc_id, text, source): length in words, clusters of equal texts."""
    return packed(stored(measured(docs)), capacity, group_size)
