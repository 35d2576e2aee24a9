"""op13 against a plain eigendecomposition of exactly centred integers."""

import numpy as np
import pytest

from samples import SF001
from scholarlake.llm import whitening
from scholarlake.llm.queries import QUERIES

COLUMNS = "vec_id long, embedding array<float>, label int"


def plain(rows, most=8):
    """{vec_id: deviation}, {component: (whitened by id, explained)} of (vec_id, vector)."""
    x = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*(v for _, v in x), strict=True)]
    z = [[n * c - s for c, s in zip(v, sums, strict=True)] for _, v in x]
    y = np.array([[c / n for c in v] for v in z])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:most]
    out = y @ vectors[:, order] / np.sqrt(values[order])
    return [sum(c * c for c in v) for v in z], out, values[order] / np.trace(v)


def check(rows, got):
    deviations, out, explained = plain(rows)
    by_row = {}
    for r in got:
        by_row.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by_row) == list(range(1, out.shape[1] + 1))
    for k, of in by_row.items():
        assert sorted(of) == sorted(i for i, _ in rows)
        w = np.array([of[i].whitened for i, _ in rows])
        expected = out[:, k - 1]
        sign = np.sign(w @ expected)
        np.testing.assert_allclose(w * sign, expected, atol=1e-7)
        assert [of[i].deviation for i, _ in rows] == deviations
        assert {r.n for r in of.values()} == {len(rows)}
        np.testing.assert_allclose([r.explained for r in of.values()], explained[k - 1], rtol=1e-9)
        assert all(r.identity_error < 1e-9 for r in of.values())


@pytest.mark.parametrize("shape", [(40, 3), (300, 12), (5, 9), (200, 8)])
def test_against_plain(spark, shape):
    random = np.random.default_rng(shape[0])
    stretch = 10.0 ** -np.arange(shape[1])[:9].clip(max=2).mean()
    vectors = random.normal(size=shape) * np.linspace(1, 3, shape[1]) * stretch
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], COLUMNS).repartition(5)
    got = whitening.whitened(df).collect()
    if shape[0] > shape[1]:
        check(rows, got)
    else:  # fewer vectors than dimensions: as many components as there is variance
        assert {r.component for r in got} == set(range(1, shape[0]))
        assert all(r.identity_error < 1e-9 for r in got)


def test_the_registered_query(spark):
    got = QUERIES["op13_embedding_whitening"](spark, SF001).collect()
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    check([(r.vec_id, r.embedding) for r in rows], got)


def test_odd_rows(spark):
    vectors = np.random.default_rng(1).normal(size=(30, 4)).tolist()
    good = [(i, v) for i, v in enumerate(vectors)] + [(30, [0.0, 0.0, 0.0, 0.0]), (31, vectors[0])]
    short = (32, [0.5])  # counts as padded with entries 0
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, [1.0, None, 1.0, 1.0]), (92, [nan] * 4), (93, [1.0, -inf, 0.0, 0.0])]
    data = [(i, v, None) for i, v in [*good, short, *bad]]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "'x' AS component", "1 AS n", "2 AS place", "3 AS whitened")
    check([*good, (32, [0.5, 0.0, 0.0, 0.0])], whitening.whitened(df).collect())
    # Repeated rows and null ids are rows.
    again = df.unionAll(df.selectExpr("CAST(NULL AS long)", "* EXCEPT (vec_id)"))
    got = whitening.whitened(again).collect()
    assert sum(r.vec_id is None for r in got) == 33 * 4 and got[0].n == 66


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], COLUMNS)
    for df in (same, same.limit(1), same.limit(0), same.selectExpr("vec_id", "array() AS e")):
        df = df.toDF(*["vec_id", "embedding", "label"][: len(df.columns)])
        df = df.withColumn("embedding", df["embedding"].cast("array<float>"))
        assert whitening.whitened(df).collect() == []


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame(
        [(i, [float(1 << 27) * (i % 3), 1.0 * i]) for i in range(9)],
        "vec_id long, embedding array<double>",
    )
    got = {r.vec_id: r.deviation for r in whitening.whitened(big).where("component = 1").collect()}
    deviations, _, _ = plain([(r.vec_id, r.embedding) for r in big.collect()])
    expected = [d if d < 1 << 63 else None for d in deviations]
    assert [got[i] for i in range(9)] == expected and None in expected
    assert any(d is not None for d in expected)


def test_factors_keep_small_eigenvalues():
    """Eigenvalues twelve orders apart come out to full relative precision."""
    scale = 10.0 ** np.array([6, 3, 0, -3])
    v = np.outer(scale, scale) * (np.eye(4) + 0.3)
    factor = whitening.pivoted_cholesky(v)
    np.testing.assert_allclose(factor @ factor.T, v, rtol=1e-12)
    rotated = whitening.one_sided_jacobi(factor[:, :4])
    gram = rotated.T @ rotated
    off = gram - np.diag(np.diag(gram))
    assert np.abs(off / np.sqrt(np.outer(np.diag(gram), np.diag(gram)))).max() < 1e-14
