import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import ODD, SF1
from scholarlake.llm import importance_resampling as ir
from scholarlake.llm.tokens import SPACED, words


@pytest.mark.parametrize("k", [0, 1, 7, 5_000, 29_999, 30_000, 40_000])
def test_threshold_is_the_kth_largest(spark, k):
    df = spark.range(30_000).select(
        F.when(F.col("id") < 9_000, F.lit(1.5)).otherwise(F.rand(3) * F.col("id")).alias("key")
    ).cache()
    ordered = sorted((r.key for r in df.collect()), reverse=True)
    expected = float("inf") if not k else ordered[min(k, len(ordered)) - 1]
    assert ir.threshold(df, k) == expected


def test_threshold_of_nothing_and_of_one_value(spark):
    assert ir.threshold(spark.createDataFrame([], "key double"), 3) == float("inf")
    assert ir.threshold(spark.range(9_000).select(F.lit(2.0).alias("key")), 3) == 2.0


def test_models_count_all_texts(table):
    rows = [(i, "to be or not to be " * (i % 5), "en", "a") for i in range(50)] + ODD
    df = table(rows, clash=False).withColumn("half", (F.col("doc_id") % 2).cast("int")).fillna(0, ["half"])
    expected = np.zeros((2, 1 << ir.BITS), np.int64)
    for r in df.collect():
        bucket, _ = ir.features(words([(r.text or "").encode()], SPACED))
        expected[r.half] += np.bincount(bucket, minlength=1 << ir.BITS)
    assert np.array_equal(ir.counted(df), expected)


def test_target_texts_are_exact(spark, table):
    ids = spark.createDataFrame([(6,), (7,), (999,)], "doc_id long")
    got = ir.with_ids(table(ODD), ids).collect()
    assert sorted(r.doc_id for r in got) == [6, 7, 7]


def test_good_documents_are_kept(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    got = ir.resampled(docs, labels).toPandas()
    assert abs(got.kept.mean() - labels.toPandas().quality.mean()) < 0.002
    judged = got.merge(labels.toPandas())
    assert judged[judged.quality == 1].kept.mean() > 0.95
    assert judged[judged.quality == 0].kept.mean() < 0.25


def test_noise_is_gumbel(spark):
    noise = spark.range(40_000).select(ir.gumbel(1, "id").alias("g")).toPandas().g
    assert abs(noise.mean() - 0.5772) < 0.03 and abs(noise.var() - np.pi**2 / 6) < 0.08


def test_odd_rows(spark, table):
    labels = spark.createDataFrame(
        [(6, 1), (7, 0), (7, 1), (8, 1), (None, 1), (9, None)], "doc_id long, quality int"
    )
    got = ir.resampled(table(ODD), labels, share=0.5).collect()
    assert len(got) == len(ODD)
    assert sum(r.kept for r in got) in (6, 7)  # a repeated row may tie
    assert all(r.log_weight == 0 for r in got if r.doc_id in (1, 2, 3))
    none = labels.limit(0)
    assert all(r.log_weight == 0 for r in ir.resampled(table(ODD), none, share=0.5).collect())
    assert not any(r.kept for r in ir.resampled(table(ODD), none).collect())
    assert ir.resampled(table([]), labels).count() == 0
