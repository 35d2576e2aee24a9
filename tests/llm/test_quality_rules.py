import itertools
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from samples import ODD, SF01, SF001
from scholarlake.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, duplicate = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicate += line in seen
            seen.add(line)
    times = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if times[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(w), sum(map(len, w)), symbols, duplicate, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, table):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in qr.judged(docs, None).collect()}
    assert got == {i: base(text) for i, text in rows}
    odd = qr.judged(table(ODD), None).collect()
    assert sorted(repr((r.doc_id, *(r[c] for c in COLUMNS))) for r in odd) == sorted(
        repr((i, *base(text))) for i, text, *_ in ODD
    )
    assert qr.judged(table([]), None).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab \n\t#|é.")), max_size=120), min_size=1, max_size=4))
def test_base_counts_of_any_text(texts):
    block = qr.describe([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert tuple(int(block.base[c][i]) for c in COLUMNS[:5]) == base(text)[:5]
    lines = [sum(bool(WORD.search(x)) for x in t.split("\n")) for t in texts]
    assert np.diff(block.line_first).tolist() == lines
    assert np.isfinite(block.features).all()


def total(labels, scores, turns):
    return sum(s for s, y in zip(scores, labels) if y) + sum(
        turns[a, b] for a, b in itertools.pairwise(labels)
    )


def test_decoding_and_marginals_against_all_sequences():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 7):
        scores, turns = rng.normal(size=n), rng.normal(size=(2, 2))
        every = list(itertools.product((0, 1), repeat=n))
        weights = np.array([total(labels, scores, turns) for labels in every])
        field = qr.Field(np.zeros(1), turns)
        assert tuple(field.decode(scores.tolist())) == every[weights.argmax()]
        p = np.exp(weights) / np.exp(weights).sum()
        content, pairs = qr._marginals(scores, turns)
        assert np.allclose(content, p @ np.array(every))
        counted = np.zeros((2, 2))
        for labels, share in zip(every, p):
            for a, b in itertools.pairwise(labels):
                counted[a, b] += share
        assert np.allclose(pairs, counted)
    assert qr.Field(np.zeros(1), np.zeros((2, 2))).decode([]) == []


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = qr.judged(docs, qr.train(docs, labels)).toPandas().merge(labels.toPandas())
    import zlib

    held = got[[zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good[~good.base_failed].kept.mean() > 0.95
    assert bad.kept.mean() < 0.2
    assert not got[got.base_failed].kept.any()


def test_no_labels(spark, table):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert qr.train(table(ODD), none) is None
    got = qr.judged(table(ODD), None).collect()
    assert all(r.kept != r.base_failed for r in got)
