"""Items without an id, against the query's own SQL."""

import __spark_entry__ as driver
import corpus_pipeline
from oracle import compare


def test_items_without_an_id_are_hits(spark, tmp_path):
    docs = [
        (1, "before it one two three four five six seven eight nine ten eleven behind it"),
        (2, "a clean text of other words"),
        (3, "here are both: only five words stand here, and one two three four five six"
            " seven eight nine ten"),
    ]
    items = [
        (None, "one two three four five six seven eight nine ten eleven"),
        (None, "ten nine eight"),
        (4, "only five words stand here"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = driver.queries()["op3_decontamination"](spark, str(tmp_path))
    rows = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in got.collect()}
    assert rows == {1: (11, 1, True), 2: (0, 0, False), 3: (15, 2, True)}
    kept = corpus_pipeline.benchmark_passages(spark, df, str(tmp_path)).collect()
    assert [r.doc_id for r in kept] == [2]
    assert compare(got, driver.oracle_sql()["op3_decontamination"], str(tmp_path)) > 0
