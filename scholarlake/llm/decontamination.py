"""Benchmark passages in documents: a prefix-filtered set join, verified exactly.

A window is a run of ``window`` consecutive words of a benchmark item; an item
with fewer words, but not none, is one window.  A document word inside any
occurrence of a window is hit.

1.  Shingles are runs of five words (all words of a shorter window).  One scan
    of the documents keeps the places of those that a filter of fixed size finds
    among the benchmark's, with the words around them.
2.  Shingles are ordered by the number of documents that have them.  A document
    can hold a window only if it holds its rarest shingle, so that prefix of
    length one is all that is joined.
3.  A candidate must have as many words as the window (length) and room for it
    before and behind the shingle's place (position).  Then the window's words
    are compared one by one.

Null and empty texts have no words and no hits.  Repeated rows, and rows that
share an id, are counted each for itself.  Repeated items count once; items with
no words cannot occur.  Items with a null id occur only with ``unnamed``, as the query
and the pipeline call it: all of them are one item, which the hash of ids leaves out.
Empty tables give empty results, or no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.bitmap import bitmap, found
from scholarlake.llm.common import fresh, map_batches, row_key, stored
from scholarlake.llm.tokens import blocks, bytes_of, span_hashes, words

WINDOW = 10
SHINGLE = 5


def windows(items: DataFrame, window: int = WINDOW, unnamed: bool = False) -> DataFrame:
    """(item_id, window, n, shingles): the windows of (item_id, text), words joined by spaces."""

    def cut(batch: pa.RecordBatch) -> dict:
        texts, ids = bytes_of(batch.column("text")), batch.column("item_id").to_pylist()
        out: dict[str, list] = {"item_id": [], "window": [], "n": [], "shingles": []}
        for low, high in blocks(texts):
            w = words(texts[low:high])
            spelled = [w.kept[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]
            for i in range(high - low):
                first, count = int(w.first[i]), int(w.counts[i])
                n = min(window, count)
                size = min(SHINGLE, n)
                for at in range(first, first + count - n + 1) if n else ():
                    begin = np.arange(at, at + n - size + 1)
                    hashes = span_hashes(w.hash, begin, begin + size)
                    out["item_id"].append(ids[low + i])
                    out["window"].append(b" ".join(spelled[at : at + n]).decode())
                    out["n"].append(n)
                    out["shingles"].append(hashes.view(np.int64).tolist())
        return out

    return map_batches(
        items.where(F.col("item_id").isNotNull() | F.lit(unnamed)).select(F.col("item_id").cast("string"), "text"),
        cut,
        "item_id string, window string, n int, shingles array<bigint>",
    )


def places(docs: DataFrame, known: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """(doc_id, k1, k2, n_words, places): where these shingles may be the benchmark's.

    A place has its shingle's hash, the number of the shingle's first word, the
    words that a window around it could have, and how many of them come before.
    """

    def scan(batch: pa.RecordBatch) -> dict:
        texts = bytes_of(batch.column("text"))
        counts = np.zeros(len(texts), np.int64)
        at: list[list[dict]] = [[] for _ in texts]
        for low, high in blocks(texts):
            w = words(texts[low:high])
            counts[low:high] = w.counts
            of = w.of
            for size in sizes:
                hashes, begin = w.shingles(size)
                hit = np.flatnonzero(found(known, hashes))
                for shingle, i in zip(
                    hashes[hit].view(np.int64).tolist(), begin[hit].tolist(), strict=True
                ):
                    doc = int(of[i])
                    reach = window - size if size == SHINGLE else 0
                    a = max(int(w.first[doc]), i - reach)
                    b = min(int(w.first[doc + 1]), i + size + reach)
                    around = b" ".join(
                        w.kept[s:e].tobytes() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)
                    )
                    at[low + doc].append(
                        {
                            "shingle": shingle,
                            "place": i - int(w.first[doc]),
                            "before": i - a,
                            "around": around.decode(),
                        }
                    )
        return {
            "doc_id": batch.column("doc_id"),
            "k1": batch.column("k1"),
            "k2": batch.column("k2"),
            "n_words": counts,
            "places": at,
        }

    return map_batches(
        docs,
        scan,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()},"
        " k1 bigint, k2 bigint, n_words bigint,"
        " places array<struct<shingle: bigint, place: int, before: int, around: string>>",
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, unnamed: bool = False
) -> DataFrame:
    """Hits of (item_id, text) in (doc_id, text).

    Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256 (of the
    item ids, sorted as strings, joined by commas), contaminated, and the row's
    key (k1, k2).
    """
    k1, k2 = row_key()
    keyed = docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))
    # Stored tables are small beside the documents: all items' windows, and
    # documents without their texts.
    cut = stored(windows(items, window, unnamed))
    shingles = cut.select("window", "n", F.posexplode("shingles").alias("offset", "shingle"))
    known = bitmap(shingles, "shingle")
    # A shingle is shorter than five words only if its whole window is.
    short = cut.where(F.col("n") < SHINGLE).select("n").distinct().collect()
    sizes = sorted({SHINGLE, *(row.n for row in short)})

    scanned = stored(places(keyed, known, sizes, window))
    held = scanned.where(F.size("places") > 0)
    spread = held.select("k1", "k2", "n_words", F.explode("places").alias("at")).select(
        "k1", "k2", "n_words", "at.*"
    )
    documents_with = (
        held.select(F.explode(F.array_distinct("places.shingle")).alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    rarest = (
        shingles.distinct()
        .join(documents_with, "shingle")
        .groupBy("window", "n")
        .agg(
            F.count_distinct("offset").alias("there"),
            F.min(F.struct("documents", "offset", "shingle")).alias("prefix"),
        )
        # Every shingle of a window that occurs is in some document.
        .where(F.col("there") == F.greatest(F.lit(1), F.col("n") - SHINGLE + 1))
        .select("window", "n", "prefix.offset", "prefix.shingle")
    )
    start = F.col("place") - F.col("offset")
    inside = F.slice(
        F.split("around", " "), F.col("before") - F.col("offset") + 1, F.col("n")
    )
    occurrences = (
        spread.join(rarest, "shingle")
        .where((F.col("n_words") >= F.col("n")) & (start >= 0))
        .where((start + F.col("n") <= F.col("n_words")) & (F.col("before") >= F.col("offset")))
        .where(F.array_join(inside, " ") == F.col("window"))
        .select("k1", "k2", "window", start.alias("start"), (start + F.col("n")).alias("end"))
    )
    occurrences = stored(occurrences)
    hit = occurrences.groupBy("k1", "k2").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'to', 0),"
        " (a, s) -> named_struct('n', a.n + greatest(0, s.end - greatest(s.start, a.to)),"
        " 'to', greatest(a.to, s.end))).n"
    )
    of_items = (
        occurrences.select("k1", "k2", "window")
        .distinct()
        .join(cut.select("window", "item_id").distinct(), "window")
        .groupBy("k1", "k2")
        .agg(
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.max(F.col("item_id").isNull().cast("int")).alias("others"),
        )
    )
    found_in = hit.select("k1", "k2", covered.alias("n_hit")).join(of_items, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return scanned.join(found_in, ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        (F.size(listed) + F.coalesce("others", F.lit(0))).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "k1",
        "k2",
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, unnamed: bool = False
) -> DataFrame:
    """The rows of ``docs`` that hold no window, with all their columns."""
    k1, k2 = fresh(docs, "k1", "k2")
    bad = contamination(docs, items, window, unnamed).where("contaminated").select(
        F.col("k1").alias(k1), F.col("k2").alias(k2)
    )
    first, second = row_key()
    return docs.withColumns({k1: first, k2: second}).join(bad, [k1, k2], "left_anti").select(
        *docs.columns
    )
