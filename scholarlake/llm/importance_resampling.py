"""Importance resampling: which documents look like the target, drawn by Gumbel top-k.

Two generative models of hashed words and word pairs (whatever stands between
white space) are counted: one over the target texts, one over all raw texts, both
over the whole tables.  A document's log weight is the sum of the log ratios of
its features.  With independent Gumbel noise added, the k largest keys are a
sample without replacement in proportion to the weights.

Rows are dealt into two halves by hash, and either is weighed with the models of
the other one, so that no document speaks for itself.

Target texts are found by a filter of fixed size over the ids, then exactly by a
join that moves only what the filter let through.

The noise follows from the row's key and a seed, so a retried task draws the
same.  k is exact: the threshold is found by counting keys in ranges that get
narrower, no keys are sorted globally.  Rows with equal keys at the threshold
are all kept, as repeated rows have one draw.

Texts that are null or have no words have log weight 0.  With no target texts
the models are the same and the sample is a uniform one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.bitmap import bitmap, found
from scholarlake.llm.common import map_batches, row_key, slices, stored
from scholarlake.llm.tokens import SPACED, Words, blocks, bytes_of, words

BITS = 16
ADDED = 1.0  # to the count of every bucket
# Ranges are narrowed until so few keys are left that they can be compared.
FEW = 4096
RANGES = 1024


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and pair of words."""
    pairs, begin = w.shingles(2)
    of = w.of
    hashes = np.concatenate([w.hash, pairs])
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([of, of[begin]])


def counted(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in (text, half): a row for either half."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            raw = bytes_of(batch.column("text"))
            second = batch.column("half").to_numpy() == 1
            for low, high in blocks(raw):
                bucket, of = features(words(raw[low:high], SPACED))
                other = second[low + of]
                total[0] += np.bincount(bucket[~other], minlength=1 << BITS)
                total[1] += np.bincount(bucket[other], minlength=1 << BITS)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"bucket": some, "n0": total[0, some], "n1": total[1, some]}
        )

    rows = (
        texts.select("text", "half")
        .mapInArrow(count, "bucket bigint, n0 bigint, n1 bigint")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    out = np.zeros((2, 1 << BITS), np.int64)
    for half in (0, 1):
        out[half, rows["bucket"].to_numpy()] = rows[f"n{half}"].to_numpy()
    return out


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids``."""
    known = docs.sparkSession.sparkContext.broadcast(
        bitmap(ids.select(F.xxhash64(F.col("doc_id").cast("long")).alias("hash")), "hash")
    )

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        return pd.Series(found(known.value, hashes.to_numpy(np.int64).view(np.uint64)))

    likely = docs.where(passes(F.xxhash64(F.col("doc_id").cast("long"))))
    # The same plan at every size, with a shuffle on either side.
    return likely.join(ids.hint("merge"), "doc_id", "left_semi")


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket log(p_target / p_raw); zero everywhere without a target."""
    if not target.sum():
        return np.zeros(len(raw))
    # The target model leans on the raw one where it has seen little.
    background = (raw + ADDED) / (raw.sum() + ADDED * len(raw))
    weight = len(raw) * ADDED
    p = (target + weight * background) / (target.sum() + weight)
    return np.log(p) - np.log(background)


def gumbel(seed: int, *key: str) -> Column:
    """Standard Gumbel noise from a hash of these columns."""
    hashed = F.xxhash64(F.lit(seed), *key)
    # 52 bits, and half a step, so that it is never 0 or 1.
    uniform = (F.shiftrightunsigned(hashed, 12).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def weighted(docs: DataFrame, ratios: np.ndarray, seed: int = 8) -> DataFrame:
    """Per row of (doc_id, text, k1, k2, half): doc_id, log_weight, key.

    ``ratios`` has the log ratios of either half's models.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batch: pa.RecordBatch) -> dict:
        ratios = shipped.value
        raw = bytes_of(batch.column("text"))
        half = batch.column("half").to_numpy()
        out = np.zeros(len(raw))
        for low, high in blocks(raw):
            bucket, of = features(words(raw[low:high], SPACED))
            told = ratios[1 - half[low + of], bucket]
            out[low:high] = np.bincount(of, told, high - low)
        return {c: batch.column(c) for c in ("doc_id", "k1", "k2")} | {"log_weight": out}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_batches(docs, score, f"doc_id {kind}, k1 bigint, k2 bigint, log_weight double")
    key = F.col("log_weight") + gumbel(seed, "k1", "k2")
    return scored.select("doc_id", "log_weight", key.alias("key"))


def threshold(keys: DataFrame, k: int) -> float:
    """The k-th largest of a column ``key`` of doubles; infinity for k = 0."""
    low, high, total = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or not total:
        return float("inf")
    if k >= total:
        return low
    above = 0  # keys greater than all that are left
    left, held = keys, total
    while held > FEW and low < high:
        width = (high - low) / RANGES
        place = F.least(F.lit(RANGES - 1), F.floor((F.col("key") - low) / width))
        ranges = sorted(
            left.groupBy(place.alias("range"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("key").alias("low"),
                F.max("key").alias("high"),
            )
            .collect(),
            key=lambda r: -r["range"],
        )
        for r in ranges:
            if above + r["n"] >= k:
                break
            above += r["n"]
        if r["n"] == held:
            break  # nothing was told apart
        low, high, held = r["low"], r["high"], r["n"]
        left = keys.where(F.col("key").between(low, high))
    # Few keys, or many of very few values: count the values.
    values = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("key"))
    for value, n in values.limit(FEW).collect():
        above += n
        if above >= k:
            return value
    return low


def resampled(
    docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 8
) -> DataFrame:
    """doc_id, log_weight, key and kept of every row of (doc_id, text).

    Target texts are those of quality 1 in (doc_id, quality).  k is ``share`` of
    all documents, by default the share of quality 1 among the labelled ones.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    if share is None:
        share = good.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    k1, k2 = row_key()
    keyed = docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))
    half = F.pmod(F.xxhash64(F.lit("half"), "k1", "k2"), F.lit(2)).cast("int")
    keyed = keyed.withColumn("half", half)
    target = counted(with_ids(keyed, good.where("quality = 1").select("doc_id")))
    ratios = np.stack([log_ratios(*models) for models in zip(target, counted(keyed), strict=True)])
    keys = stored(weighted(keyed, ratios, seed))
    k = round(share * keys.count())
    return keys.withColumn("kept", F.col("key") >= F.lit(threshold(keys, k)))
