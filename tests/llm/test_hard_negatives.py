"""op11 against SQL and against all scores in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import compare
from samples import SF01
from scholarlake.llm import hard_negatives as hn
from scholarlake.llm.queries import ORACLES, QUERIES

COLUMNS = "vec_id long, embedding array<double>, label int"


def plain(rows, every=4, most=5, k=3, low=50, high=95):
    """Sorted result tuples of distinct rows (vec_id, vector, label)."""
    x = [(i, [math.floor(256 * c) for c in v], y) for i, v, y in rows]
    out = []
    for a, va, ya in x:
        if a % every:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(va, v)), i, y) for i, v, y in x if i != a
        )
        for s, p, _ in [row for row in scored if row[2] == ya][:most]:
            fits = [r for r in scored if r[2] != ya and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def got(df, **more):
    return sorted(map(tuple, hn.mined(df, F.col("vec_id") % 4 == 0, **more).collect()))


def vectors(n, dimensions, labels, seed, levels=None):
    """With ``levels`` components are few, so that scores tie."""
    r = random.Random(seed)
    part = (lambda: r.choice(levels)) if levels else (lambda: r.gauss(0.3, 1))
    return [(i, [part() for _ in range(dimensions)], r.randrange(labels)) for i in range(n)]


def test_the_registered_query_against_sql(spark):
    name = "op11_hard_negatives"
    assert compare(QUERIES[name](spark, SF01), ORACLES[name], SF01) > 0


@pytest.mark.parametrize(
    "rows, block",
    [
        (vectors(120, 5, 3, 1), hn.BLOCK),
        (vectors(120, 5, 3, 1), 60),  # many small blocks
        (vectors(90, 2, 2, 2, levels=(0.5, 1.0)), 30),  # nearly all scores tie
        (vectors(40, 3, 20, 3), 30),  # fewer positives than five
        (vectors(30, 3, 1, 4), hn.BLOCK),  # no row of another label
    ],
)
def test_against_plain(spark, rows, block):
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert got(df, block=block) == plain(rows)


def test_other_numbers(spark):
    rows = vectors(80, 4, 3, 5)
    df = spark.createDataFrame(rows, COLUMNS)
    assert got(df, positives=9, negatives=1, low=10, high=120, block=50) == plain(
        rows, most=9, k=1, low=10, high=120
    )


def test_odd_rows(spark):
    rows = vectors(50, 3, 2, 6)
    nan, inf = float("nan"), float("inf")
    short, wide = (52, [1.0], 0), (53, [0.5, 0.5, 0.5, 2.0], 1)
    bad = [(None, [1.0] * 3, 0), (56, None, 0), (57, [1.0] * 3, None), (58, [1.0, None, 1.0], 0)]
    bad += [(60, [nan, 1.0, 1.0], 1), (64, [1.0, inf, 1.0], 0)]
    df = spark.createDataFrame([*rows, short, wide, *rows[:20], *bad], COLUMNS)
    df = df.selectExpr("*", "'x' AS row", "1 AS anchor", "2 AS block", "3 AS part", "4 AS limits")
    padded = [(i, v + [0.0] * (4 - len(v)), y) for i, v, y in [*rows, short, wide]]
    assert got(df) == plain(padded)
    assert got(df.limit(0)) == []
    assert got(df.where("vec_id IN (56, 57)")) == []
    empty = spark.createDataFrame([(4 * i, [], i % 2) for i in range(6)], COLUMNS)
    assert got(empty) == plain([(4 * i, [], i % 2) for i in range(6)])


def test_one_id_for_several_vectors(spark):
    """They are rows of their own: each an anchor, and a positive of the other."""
    rows = [(4, [1.0, 0.0], 1), (4, [1.0, 0.1], 1), (5, [0.75, 0.0], 2)]
    out = got(spark.createDataFrame(rows, COLUMNS))
    assert [r[:4] for r in out] == [(4, 4, 1, 5), (4, 4, 1, 5)]


def test_scores_are_exact():
    big = np.array([[float(1 << 40), 3.0], [float(1 << 30), -1.0]])
    expected = [[sum(int(p) * int(q) for p, q in zip(a, b)) for b in big] for a in big]
    limit = hn.LARGEST
    assert hn.products(big, big).tolist() == [
        [max(-limit, min(limit, s)) for s in row] for row in expected
    ]


def test_per_cent_rounds_like_integers(spark):
    values = [*range(-250, 251), hn.LARGEST, -hn.LARGEST]
    df = spark.createDataFrame([(v,) for v in values], "s long")
    out = df.select("s", hn._per_cent(F.col("s"), 95, False), hn._per_cent(F.col("s"), 50, True))
    for s, down, up in out.collect():
        assert (down, up) == (95 * s // 100, -(-50 * s // 100))
