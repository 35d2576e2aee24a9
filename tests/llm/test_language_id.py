import numpy as np

from samples import LONG, ODD, SF01
from scholarlake.llm import language_id as li


def test_counts_are_those_of_plain_ngrams():
    """Each n-gram inside a word with one space on either side, counted per text."""
    texts = ["Ab c", "", "ab, AB-x9y", "日本 \U00020000", " ", "é"]

    def grams(text):
        letters = [c if c.isalpha() or ord(c) > 0xFFFF else " " for c in text.lower()]
        out = []
        for word in "".join(letters).split():
            for n in li.SIZES:
                padded = word if n == 1 else f" {word} "
                out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
        # " a " without a letter in the middle positions does not occur; pairs may hold a space.
        return out

    of, _, times = li.counts(texts)
    assert np.bincount(of, times, len(texts)).tolist() == [len(grams(t)) for t in texts]
    alone = [tuple(zip(*li.counts([t])[1:])) for t in texts]
    together = [
        tuple(zip(b[of == i], n[of == i])) for i in range(len(texts)) for b, n in [li.counts(texts)[1:]]
    ]
    assert alone == together


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = li.identified(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas())
    held = got[got.held_out]
    assert 150 < len(held) < 350
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_odd_rows(table):
    rows = [(100 + i, t, lang, "a") for i in range(40) for t, lang in (
        (f"the house and the garden of number {i}", "en"), (f"das Haus und der Garten Nummer {i}", "de"))]
    rows += [(1, "das Haus und der Garten", None, "a"), (2, "the house and the garden", None, "a"),
             (3, "12 34 !", None, "a"), (4, None, "en", "a"), *ODD]
    df = table(rows)
    got = {(r.doc_id, r.lang_pred) for r in li.identified(df).collect()}
    assert {(1, "de"), (2, "en"), (3, "und"), (4, "und")} <= got
    assert li.identified(df).count() == len(rows)
    assert li.accepted(df).columns == df.columns
    kept = [r.text for r in li.accepted(df).collect()]
    assert LONG in kept and None not in kept and "" not in kept and "12 34 !" not in kept


def test_nothing_to_learn_from(table):
    assert li.identified(table([])).count() == 0
    got = li.identified(table([(1, "some words", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_temperature():
    rng = np.random.default_rng(0)
    true = rng.normal(size=(4000, 3))
    p = li.softmax(true)
    labels = np.array([rng.choice(3, p=row) for row in p])
    assert abs(li.calibrated(true * 5, labels) - 5) < 0.6
    assert li.calibrated(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_penalty_leaves_few_weights():
    rng = np.random.default_rng(0)
    rows = [(np.append(rng.choice(500, 20, False) + 2, i % 2), np.ones(21)) for i in range(300)]
    target = np.eye(2)[np.arange(300) % 2]
    loose = li.follow_the_regularised_leader(rows, target, 502, l1=0.0)
    tight = li.follow_the_regularised_leader(rows, target, 502, l1=2.0)
    assert (tight[:2, 0] != 0).all()
    assert (tight != 0).sum() < 0.2 * (loose != 0).sum()
