"""Hard negatives of anchors: slots of scores between the positives' upper limits.

A row's score is the inner product with the anchor, of components floor(scale * x).
An anchor's positives are its best rows of the same label; each asks for the best rows
of another label whose score is at least ``low`` and at most ``high`` per cent of its
own.  These windows overlap, but the best k below an upper limit are known from less:

1.  Rows and anchors are dealt out to blocks by hash, every block of rows meets every
    block of anchors in one task; blocks have a fixed number of vector components.
    Inside, scores are matrix products and never leave the task.  A first pass meets
    rows of the anchor's own label only and keeps the best positives.
2.  The upper limits of an anchor's positives cut the scores into disjoint slots.  A
    second pass gives each row of another label to the one slot it falls in, and each
    task keeps the best k of every slot; the window of Spark's row_number combines them
    the same way, in each task before the shuffle and once after it.
3.  What is left of an anchor, its slots one behind the other from the highest score
    down, answers all of its windows: the best k below a limit are the first k of the
    suffix that begins at its slot, and those of them count that reach the lower bound.

Scores are exact; beyond 2**62 they count as that.  Ties go to the smaller vec_id.
Rows without an id, a label or a vector, or with null or non-finite components, take no
part.  A vector shorter than the longest one counts as padded with zeros.  Repeated
rows are one row; rows that share an id and differ otherwise are several, told apart by
their hash, which also breaks ties between them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.llm.common import stored
from scholarlake.llm.vectors import finite, matrix

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # per cent of a positive's score
BLOCK = 1 << 21  # vector components that one block has about
TILE = 1 << 21  # scores that are held at a time
LARGEST = 1 << 62


class Side:
    """The rows of one block, in the order of their ids."""

    def __init__(self, table: pa.Table, wide: int, scale: int):
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.table = table
        self.id, self.row, self.label = (
            table.column(c).to_numpy() for c in ("vec_id", "row", "label")
        )
        # One array, copied: sorted lists come in chunks.
        vectors = pa.concat_arrays(table.column("vector").chunks) if table.num_rows else None
        self.x = np.floor(matrix(vectors, wide) * scale) if table.num_rows else np.zeros((0, wide))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole numbers held as doubles, exactly."""
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * max(a.shape[1], 1) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    # Python's integers, where doubles would round.
    whole = [np.array([list(map(int, v)) for v in x], object).reshape(x.shape) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LARGEST, LARGEST).astype(np.int64)


def best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of these places the k of the highest scores, falling; of equal ones the first."""
    own = scores[places]
    if len(own) > k:
        least = np.partition(own, len(own) - k)[len(own) - k]
        above, tied = places[own > least], places[own == least]
        places = np.sort(np.concatenate([above, tied[: k - len(above)]]))
    return places[np.argsort(-scores[places], kind="stable")]


def _cells(
    rows: DataFrame,
    anchors: DataFrame,
    sizes: tuple[int, int],
    keys: list[str],
    choose: Callable[[Side, Side, int, np.ndarray], dict[int, np.ndarray]],
    wide: int,
    scale: int,
) -> DataFrame:
    """(anchor, anchor_row, slot, vec_id, row, score): what every pair of blocks keeps.

    ``choose`` gets both sides, the place of an anchor and its scores with all rows of
    the block; it returns the places of the rows it keeps, by slot.
    """
    row_blocks, anchor_blocks = sizes

    def dealt(df: DataFrame, salt: int, name: str, blocks: int, other: str, others: int):
        own = F.pmod(F.xxhash64("vec_id", "row", F.lit(salt)), F.lit(blocks)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        # New columns on either side: a cogroup of a table with itself mixes them up.
        new = df.select(*(F.col(c).alias(c) for c in df.columns), own.alias(name))
        return new.withColumn(other, each).groupBy(*keys, "block", "part")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        kept: dict[str, list] = {c: [] for c in ("anchor", "anchor_row", "slot")}
        found, scored = [], []
        if left.num_rows and right.num_rows:
            r, a = Side(left, wide, scale), Side(right, wide, scale)
            step = max(1, TILE // len(r.id))
            for begin in range(0, len(a.id), step):
                scores = products(a.x[begin : begin + step], r.x)
                for i, own in enumerate(scores, begin):
                    for slot, places in choose(r, a, i, own).items():
                        kept["anchor"] += [a.id[i]] * len(places)
                        kept["anchor_row"] += [a.row[i]] * len(places)
                        kept["slot"] += [slot] * len(places)
                        found.append(places)
                        scored.append(own[places])
        places = np.concatenate(found) if found else np.zeros(0, np.int64)
        columns = {
            "anchor": pa.array(kept["anchor"], pa.int64()),
            "anchor_row": pa.array(kept["anchor_row"], pa.int64()),
            "slot": pa.array(kept["slot"], pa.int32()),
            "vec_id": pa.array(r.id[places] if found else [], pa.int64()),
            "row": pa.array(r.row[places] if found else [], pa.int64()),
            "score": pa.array(np.concatenate(scored) if found else [], pa.int64()),
        }
        return pa.table(columns)

    return (
        dealt(rows, 0, "block", row_blocks, "part", anchor_blocks)
        .cogroup(dealt(anchors, 1, "part", anchor_blocks, "block", row_blocks))
        .applyInArrow(
            meet, "anchor long, anchor_row long, slot int, vec_id long, row long, score long"
        )
    )


def _first(df: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best rows of each key; every task sends k rows a key at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return df.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def _per_cent(score: Column, share: int, up: bool) -> Column:
    """share * score / 100, rounded down or up, without overflow."""
    rest = F.pmod(score, F.lit(100))
    hundreds = F.call_function("div", score - rest, F.lit(100))
    part = F.call_function("div", rest * share + (99 if up else 0), F.lit(100))
    return hundreds * share + part


def mined(
    embeddings: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """Per anchor, positive and hard negative of (vec_id, embedding, label): ids, rank, scores.

    ``anchor`` says of a row whether it is an anchor.  Columns: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score.
    """
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")
    rows = stored(
        embeddings.where(valid)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            "label",
            F.col("embedding").alias("vector"),
            anchor.alias("anchor"),
        )
        .dropDuplicates(["vec_id", "label", "vector"])
        .withColumn("row", F.xxhash64("label", "vector"))
    )
    of_anchors = rows.where("anchor").drop("anchor")
    count, asked, wide = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    rows = rows.drop("anchor")
    most = max(1, block // max(wide, 1))
    sizes = (max(1, -(-count // most)), max(1, -(-asked // most)))

    def same_label(r: Side, a: Side, i: int, scores: np.ndarray) -> dict[int, np.ndarray]:
        other = (r.id != a.id[i]) | (r.row != a.row[i])
        return {0: best(scores, np.flatnonzero(other), positives)}

    near = _cells(rows, of_anchors, sizes, ["label"], same_label, wide, scale)
    windows = stored(
        _first(near, positives, "anchor", "anchor_row").select(
            "anchor",
            "anchor_row",
            F.col("vec_id").alias("positive_id"),
            F.col("row").alias("positive_row"),
            F.col("score").alias("positive_score"),
            _per_cent(F.col("score"), low, up=True).alias("least"),
            _per_cent(F.col("score"), high, up=False).alias("limit"),
        )
    )
    slots = (
        windows.where("least <= limit")
        .groupBy("anchor", "anchor_row")
        .agg(F.sort_array(F.collect_set("limit")).alias("limits"), F.min("least").alias("least"))
        .select(F.col("anchor").alias("vec_id"), F.col("anchor_row").alias("row"), "limits", "least")
    )

    def other_labels(r: Side, a: Side, i: int, scores: np.ndarray) -> dict[int, np.ndarray]:
        limits = np.array(a.table["limits"][i].as_py())
        able = (r.label != a.label[i]) & (scores >= a.table["least"][i].as_py())
        places = np.flatnonzero(able & (scores <= limits[-1]))
        slot = np.searchsorted(limits, scores[places])
        return {int(s): best(scores, places[slot == s], negatives) for s in np.unique(slot)}

    far = _cells(rows, of_anchors.join(slots, ["vec_id", "row"]), sizes, [], other_labels, wide, scale)
    # All slots of an anchor, the highest first: at most as many rows as positives * negatives.
    entry = F.struct((-F.col("score")).alias("fall"), "vec_id", "row", "slot", "score")
    merged = (
        _first(far, negatives, "anchor", "anchor_row", "slot")
        .groupBy("anchor", "anchor_row")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    suffix = F.filter(
        "entries", lambda e: (e["score"] <= F.col("limit")) & (e["score"] >= F.col("least"))
    )
    return (
        windows.join(merged, ["anchor", "anchor_row"])
        .select("*", F.posexplode(F.slice(suffix, 1, negatives)).alias("place", "negative"))
        .select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            (F.col("place") + 1).alias("rank"),
            F.col("negative.vec_id").alias("negative_id"),
            "positive_score",
            F.col("negative.score").alias("negative_score"),
        )
    )
