"""Documents whose word n-grams are similar: MinHash bands, then exact Jaccard.

1.  One scan turns a text into its set of word n-grams (lower-cased in ASCII;
    a text of fewer words is one n-gram) and a MinHash signature.  Texts with
    equal sets are one class member from here on, however many there are.
2.  Bands and rows follow from the target recall; sets that share a band are
    candidates.  Each set is linked to the first one of its band, so a band of m
    sets gives m rows, never m * m.
3.  Candidates that hang together are compared on their full sets.  A large
    group is cut into blocks by hash; every pair of blocks is one task's work,
    done by matrix products in memory, and gives one row per set: how many
    documents it is linked to and the first set it hangs together with.
4.  What hangs together by verified links is one class.

No link between different texts is lost by this: all pairs of a candidate group
are compared, whichever bands they share.

Null texts and texts without words have no n-grams: they are a class of their
own, without links.  Repeated rows are documents like others.  The class id is
the smallest non-null doc_id of the class.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.common import fresh, map_batches, row_key, stored
from scholarlake.llm.components import components
from scholarlake.llm.tokens import blocks, bytes_of, mix, words

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
MAX_HASHES = 128
# What one task compares with as much again: sets, and n-grams in them.
BLOCK_SETS = 1024
BLOCK_NGRAMS = 1 << 21


def bands_and_rows(
    similarity: float = SIMILARITY, recall: float = RECALL, most: int = MAX_HASHES
) -> tuple[int, int]:
    """(bands, rows): the most rows, hence fewest strangers, that reach the recall.

    Two sets of Jaccard similarity s share a band with probability
    1 - (1 - s**rows)**bands.
    """
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-(similarity**rows)))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"{most} hashes do not reach a recall of {recall}")
    return best


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20)
    return (
        random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1),
        random.integers(0, 1 << 63, n, np.uint64),
    )


def _sets(texts: list[bytes], n: int):
    """The sorted set of n-gram hashes of each text; empty without words."""
    for low, high in blocks(texts):
        w = words(texts[low:high])
        hashes, begin = w.shingles(n)
        cuts = np.searchsorted(begin, w.first)
        for i in range(high - low):
            own = hashes[cuts[i] : cuts[i + 1]]
            if not len(own) and w.counts[i]:
                own = mix(w.hash[w.first[i] : w.first[i + 1]].cumsum())[-1:]
            yield np.unique(own)


def _digest(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def signatures(docs: DataFrame, bands: int, rows: int, n: int = WORDS) -> DataFrame:
    """(doc_id, k1, k2, set, size, bands): the set's digest and the hash of each band."""

    def scan(batch: pa.RecordBatch) -> dict:
        a, b = _permutations(bands * rows)
        digests, sizes, hashes = [], [], []
        for grams in _sets(bytes_of(batch.column("text")), n):
            digests.append(_digest(grams))
            sizes.append(len(grams))
            if not len(grams):
                hashes.append([])
                continue
            # A block of n-grams at a time: memory does not grow with the text.
            least = np.full(len(a), ~np.uint64(0))
            for low in range(0, len(grams), 256):
                part = grams[low : low + 256, None] * a
                part += b
                np.minimum(least, part.min(axis=0), out=least)
            banded = mix(least).reshape(bands, rows)
            joined = np.zeros(bands, np.uint64)
            for row in banded.T:
                joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + row)
            hashes.append(joined.view(np.int64))
        return {
            "doc_id": batch.column("doc_id"),
            "k1": batch.column("k1"),
            "k2": batch.column("k2"),
            "set": digests,
            "size": sizes,
            "bands": hashes,
        }

    k1, k2 = row_key()
    return map_batches(
        docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2")),
        scan,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, k1 bigint, k2 bigint,"
        " set binary, size bigint, bands array<bigint>",
    )


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(set, group): sets that share bands, directly or through others."""
    banded = sets.select("set", F.posexplode("bands").alias("band", "hash"))
    # Stored, so that the join has a shuffle on either side and Spark can split
    # what a hot band makes of the left one.
    first = stored(
        banded.groupBy("band", "hash")
        .agg(F.min("set").alias("first"), F.count(F.lit(1)).alias("sets"))
        .where("sets > 1")
        .drop("sets")
    )
    edges = banded.join(first, ["band", "hash"]).select(
        F.col("set").alias("a"), F.col("first").alias("b")
    )
    found = components(edges)
    roots = found.select(F.col("root").alias("set"), F.col("root").alias("group")).distinct()
    return found.select(F.col("node").alias("set"), F.col("root").alias("group")).unionAll(roots)


def shared_counts(grams: list[np.ndarray]) -> np.ndarray:
    """How many n-grams every two of these sets share."""
    n = len(grams)
    owner = np.repeat(np.arange(n), [len(g) for g in grams])
    _, of, counts = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    order = np.argsort(of, kind="stable")
    owner, counts_of = owner[order], np.repeat(counts, counts)
    out = np.zeros((n, n), np.float32)
    # Rare n-grams: add up their few pairs.  Common ones: matrix products.
    flat = np.zeros(n * n, np.int64)
    for times in range(2, 17):
        owners = owner[counts_of == times].reshape(-1, times)
        for i in range(times):
            for j in range(i + 1, times):
                flat += np.bincount(owners[:, i] * n + owners[:, j], minlength=n * n) if len(
                    owners
                ) else 0
    out += flat.reshape(n, n)
    out += out.T.copy()
    common = counts_of > 16
    columns = np.cumsum(np.r_[True, np.diff(np.sort(of)[common]) != 0])[: common.sum()] - 1
    owners = owner[common]
    for low in range(0, int(columns[-1]) + 1 if len(columns) else 0, 2048):
        part = (columns >= low) & (columns < low + 2048)
        matrix = np.zeros((n, 2048), np.float32)
        matrix[owners[part], columns[part] - low] = 1
        out += matrix @ matrix.T
    np.fill_diagonal(out, [len(g) for g in grams])
    return out


def _compared(similarity: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """The links between two blocks of a group, or inside one of them."""
        _, left, right = key
        rows = rows.sort_values("set", ignore_index=True)
        grams = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
        sizes = np.array([len(g) for g in grams], np.float64)
        shared = shared_counts(grams).astype(np.float64)
        linked = shared / (sizes[:, None] + sizes - shared) >= similarity
        block = rows["block"].to_numpy()
        if left != right:
            linked &= block[:, None] != block
        np.fill_diagonal(linked, False)
        links = linked @ rows["documents"].to_numpy(np.float64)
        # The first set that each one hangs together with, in these blocks.
        root = np.arange(len(rows))
        np.fill_diagonal(linked, True)
        while True:
            least = np.where(linked, root, len(rows)).min(axis=1)
            least = least[least]
            if (least == root).all():
                break
            root = least
        return pd.DataFrame(
            {
                "set": rows["set"],
                "links": links.astype(np.int64),
                "root": rows["set"].to_numpy()[root],
            }
        )

    return compare


def links(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    n: int = WORDS,
    recall: float = RECALL,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """Per row of (doc_id, text): doc_id, class_id, n_links and the row's key (k1, k2).

    n_links is the number of other documents of at least this similarity;
    documents that are linked, directly or through others, share a class.
    """
    bands, rows = bands_and_rows(similarity, recall)
    signed = stored(signatures(docs, bands, rows, n))
    sets = stored(
        signed.where("set IS NOT NULL")
        .groupBy("set")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.min("size").alias("size"),
            F.min("doc_id").alias("least_id"),
            F.first("bands").alias("bands"),
            # A row from which to read the set again.
            F.min(F.struct("k1", "k2")).alias("row"),
        )
    )
    groups = stored(candidate_groups(sets))
    members = groups.join(sets.drop("bands", "least_id"), "set")
    cut = (
        members.groupBy("group")
        .agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / block_sets), F.ceil(F.sum("size") / BLOCK_NGRAMS)
            ).cast("int").alias("blocks")
        )
    )
    blocked = members.join(cut, "group").select(
        "group",
        "set",
        "documents",
        "blocks",
        F.pmod(F.xxhash64("set"), "blocks").cast("int").alias("block"),
        F.col("row.k1").alias("k1"),
        F.col("row.k2").alias("k2"),
    )

    def read(batch: pa.RecordBatch) -> dict:
        kept = ("group", "set", "documents", "blocks", "block")
        grams = [g.tobytes() for g in _sets(bytes_of(batch.column("text")), n)]
        return {c: batch.column(c) for c in kept} | {"grams": grams}

    # One of the repeated rows is enough to read a set.
    k1, k2 = row_key()
    texts = docs.select("text", k1.alias("k1"), k2.alias("k2")).join(blocked, ["k1", "k2"])
    full = map_batches(
        texts,
        read,
        "group binary, set binary, documents bigint, blocks int, block int, grams binary",
    )
    pairs = full.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "group",
        "set",
        "documents",
        "block",
        "grams",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
    )
    compared = stored(
        pairs.dropDuplicates(["group", "left", "right", "set"])
        .groupBy("group", "left", "right")
        .applyInPandas(_compared(similarity), "set binary, links bigint, root binary")
    )
    classes = components(
        compared.where("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b"))
    )
    counted = compared.groupBy("set").agg(F.sum("links").alias("links"))
    placed = stored(
        sets.select("set", "documents", "least_id")
        .join(counted, "set", "left")
        .join(classes.withColumnRenamed("node", "set"), "set", "left")
        .select(
            "set",
            "least_id",
            (F.col("documents") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "set").alias("class"),
        )
    )
    class_ids = placed.groupBy("class").agg(F.min("least_id").alias("class_id"))
    # Rows per set, whatever the number of its documents, until the last join.
    of_sets = placed.drop("least_id").join(class_ids, "class")
    return signed.select("doc_id", "k1", "k2", "set").join(of_sets, "set", "left").select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "class",
        "k1",
        "k2",
    )


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, n: int = WORDS) -> DataFrame:
    """The documents, one of each class: the one with the smallest id.

    All columns stay.  Documents without words are a class each; repeated rows
    are one document.
    """
    k1, k2 = fresh(docs, "k1", "k2")
    found = links(docs, similarity, n)
    first = (
        found.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(F.struct("k1", "k2")).alias("row"))
        .select(F.col("row.k1").alias(k1), F.col("row.k2").alias(k2))
    )
    alone = found.where("class IS NULL").select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    one, two = row_key()
    kept = first.unionAll(alone).distinct()
    return (
        docs.withColumns({k1: one, k2: two})
        .join(kept, [k1, k2], "left_semi")
        .dropDuplicates([k1, k2])
        .select(*docs.columns)
    )
