from pyspark.sql import functions as F

from scholarlake.llm.common import labelled_sample


def test_a_hot_id_is_one_text(spark):
    docs = spark.range(5000).selectExpr(
        "IF(id < 4900, 0L, id - 4899) AS doc_id", "concat('text ', id) AS text"
    )
    labels = spark.range(101).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    got = labelled_sample(docs.coalesce(1), labels, "toxic", 100, F.lit(True))
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == list(range(101))
    assert {r.label for r in rows} == {0, 1}
    hashes = docs.where("doc_id = 0").orderBy(F.xxhash64("text"))
    assert next(r.text for r in rows if r.doc_id == 0) == hashes.first().text
    assert sorted(got.collect()) == sorted(rows)
