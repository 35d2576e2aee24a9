"""A row repeated more often than one task deals out at a time."""

from pyspark.sql import functions as F

from scholarlake.llm import packing as pk


def test_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(pk, "COPIES", 7)
    copies = {1: 50, 2: 7, 3: 8, 4: 1, None: 15}
    rows = [(i, 5, "a", bytes([i or 0])) for i, n in copies.items() for _ in range(n)]
    items = spark.createDataFrame(rows, "doc_id long, length long, source string, cluster binary")
    got = pk.packed(items, 16, 10)
    found = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert found == copies
    # As when all copies are dealt out at once.
    few = sorted(map(tuple, got.na.fill(-1).collect()))
    monkeypatch.setattr(pk, "COPIES", 4096)
    assert sorted(map(tuple, pk.packed(items, 16, 10).na.fill(-1).collect())) == few
    assert got.agg(F.max("room")).first()[0] <= 11
