import numpy as np

from samples import ODD, SF1
from scholarlake.llm import toxicity as tx
from scholarlake.llm.tokens import words


def test_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    got = tx.scored(docs, tx.train(docs, labels)).toPandas().merge(labels.toPandas())
    held = got[got.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.7  # one label in twenty is wrong
    assert held[held.toxic == 0].predicted.mean() < 0.02
    toxic, clean = held[held.toxic == 1].score, held[held.toxic == 0].score
    above = np.searchsorted(np.sort(clean), toxic).mean() / len(clean)
    assert above > 0.9
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()


def test_label_model_finds_the_class_that_voters_tell():
    rng = np.random.default_rng(0)
    hidden = rng.random(3000) < 0.3
    on = rng.random((3000, 10)) < np.where(hidden[:, None], 0.4, 0.003)
    copies = np.repeat((rng.random((3000, 1)) < np.where(hidden[:, None], 0.3, 0.2)), 20, axis=1)
    guess = hidden ^ (rng.random(3000) < 0.1)  # a tenth is wrong
    p = tx.label_model(np.hstack([on, copies]), guess)
    # Twenty copies of a poor voter count about once.
    assert ((p > 0.5) == hidden).mean() > 0.95
    assert p[~on.any(axis=1) & copies[:, 0]].mean() < 0.5


def test_rates():
    w = words([b"a a b", b"", b"b"])
    hashes, owners = tx.features(w)
    of, _, rate = tx.rates(w, hashes, owners)
    assert of.tolist() == [0, 0, 2]
    assert sorted(rate.round(2).tolist()) == [33.33, 66.67, 100.0]


def test_odd_rows(spark, table):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.train(table(ODD), none) is None
    got = tx.scored(table(ODD), None).collect()
    assert len(got) == len(ODD) and not any(r.score or r.predicted for r in got)
    rows = [(i, f"plain words number {i} " + "nasty awful " * (i % 2), "en", "a") for i in range(100, 300)]
    labels = [(i, i % 2) for i, *_ in rows] + [(100, None), (None, 1), (101, 1)]
    df = table(rows + ODD)
    model = tx.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = tx.scored(df, model).toPandas()
    assert len(scored) == len(rows) + len(ODD)
    own = scored[scored.doc_id >= 100]
    assert (own.predicted == own.doc_id % 2).mean() > 0.95
    assert tx.scored(table([]), model).count() == 0


def test_scores_use_no_labels(table):
    """Neither id, language nor source changes a score."""
    model = tx.Model(np.ones(2 << tx.BITS, np.float32), -1.0)
    got = tx.scored(table([(1, "same text", "en", "a"), (2, "same text", "de", None)]), model)
    assert len({r.score for r in got.collect()}) == 1
