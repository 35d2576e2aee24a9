"""Each stage against the plain forms of the operators' own tests."""

import inspect

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
import test_decontamination
import test_ngram_join
import test_packing
import test_substring_dedup
from samples import SF001
from scholarlake.llm.common import stored, table


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs = table(spark, SF001, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF001))
        out[name] = docs, after
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_join", "substring_dedup", "decontamination", "packing"]
    for before, after in list(stages.values())[:-1]:
        assert after.dtypes == before.dtypes


def test_language_id_keeps_clean_documents(stages):
    before, after = (texts(df) for df in stages["language_id"])
    assert after.items() <= before.items()
    assert len(after) > 0.97 * len(before)


def test_one_document_of_each_group_stays(stages):
    before, after = (texts(df) for df in stages["ngram_join"])
    classes = test_ngram_join.plain(list(before.items()))
    assert set(after) == {c for _, c, _ in classes}
    assert after.items() <= before.items()


def test_repeats_are_cut_out(stages):
    before, after = stages["substring_dedup"]
    expected = {
        doc_id: left
        for doc_id, left, total, removed in test_substring_dedup.plain(
            test_substring_dedup.keyed(before)
        )
        if not removed or removed < total
    }
    assert texts(after) == expected
    changed = after.where(F.char_length("text") != F.col("n_chars"))
    assert changed.count() == before.where(F.char_length("text") != F.col("n_chars")).count()


def test_contaminated_documents_go(spark, stages):
    before, after = (texts(df) for df in stages["decontamination"])
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    found = test_decontamination.plain(list(before.items()), items)
    assert after == {i: before[i] for i, *_, bad in found if not bad}


def test_bins(stages):
    before, after = stages["packing"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    test_packing.check(rows, after.collect(), 2048)


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF001).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages["packing"][1].collect()))


def test_empty_documents(spark, tmp_path):
    table(spark, SF001, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SF001, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    for name in names:
        assert len(inspect.signature(driver.queries()[name]).parameters) == 2


@pytest.mark.parametrize("name", ["op3_decontamination", "op10_ngram_jaccard", "op11_hard_negatives"])
def test_against_sql(spark, name):
    from oracle import compare

    assert compare(driver.queries()[name](spark, SF001), driver.oracle_sql()[name], SF001) > 0
