"""Voters that fire equally often, on other texts."""

from scholarlake.llm import toxicity as tx
from scholarlake.llm.tokens import words


def test_words_with_equal_counts_are_voters_each(spark):
    insults = ("moron", "clown", "scum")
    filler = " ".join("abcdefghij")
    rows = [(f"{filler} {insults[i % 3]} n{i}", 1) for i in range(300)]
    rows += [(f"{filler} m{i}", 0) for i in range(300)]
    sample = spark.createDataFrame(rows, "text string, label int")
    got = set(tx.mined(sample, (300, 300)).hashes.tolist())
    for word in insults:
        hashes, _ = tx.features(words([word.encode()]))
        assert len(got.intersection(hashes.tolist())) == 1
    assert len(got) == len(insults)
