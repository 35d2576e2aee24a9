"""The sample that is fitted: one text an id, the same however the table is cut."""

import numpy as np
from pyspark.sql import functions as F

from samples import SF001
from scholarlake.llm import language_id as li


def test_the_model_does_not_depend_on_partitions_or_a_hot_id(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    hot = spark.range(3000).selectExpr(
        "7777L AS doc_id", "concat('hot text number ', id) AS text", "'en' AS lang"
    )
    rows = docs.unionAll(hot)
    models = [
        li.train(part, sample=20)
        for part in (rows.coalesce(1), rows.repartition(7, F.xxhash64("text")))
    ]
    assert models[0].languages == models[1].languages
    assert np.array_equal(models[0].weights, models[1].weights)
    assert models[0].temperature == models[1].temperature


def plain_probabilities(model, text):
    """Log-counts of hashed n-grams times idf, length one, softmax of weighted sums."""
    _, buckets, times = li.counts([text])
    x = np.zeros(1 << li.BITS)
    for bucket, n in zip(buckets, times):
        x[bucket] = np.log1p(n) * model.idf[bucket]
    x /= np.sqrt((x * x).sum()) or 1
    z = (np.append(x, 1.0) @ model.weights.astype(np.float64)) / model.temperature
    e = np.exp(z - z.max())
    return e / e.sum()


def test_predictions_are_those_of_the_plain_model(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    model = li.train(li.labelled_part(docs), sample=30)
    got = li.predict(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        p = plain_probabilities(model, r.text)
        assert abs(p.max() - r.score) < 1e-4
        assert p[model.languages.index(r.lang_pred)] > p.max() - 1e-4


def test_document_frequencies_are_plain_counts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    usable = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    total, have = li.document_frequencies(usable)
    expected = np.zeros(1 << li.BITS, np.int64)
    texts = [r.text for r in usable.collect()]
    for text in texts:
        expected[np.unique(li.counts([text])[1])] += 1
    assert total == len(texts) and np.array_equal(have, expected)
