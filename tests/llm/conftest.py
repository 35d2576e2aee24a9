import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from scholarlake.llm.common import shipped_code

    shipped_code(spark)


# Columns that operators use inside, as strangers in the input.
CLASHES = ("k1", "k2", "score", "spans", "n_words", "class", "bin", "group", "set", "key", "hash")


@pytest.fixture(scope="session")
def table(spark):
    """Rows of (doc_id, text, ...) as a table that also has columns of clashing names."""

    def make(rows, columns="doc_id long, text string, lang string, source string", clash=True):
        df = spark.createDataFrame(rows, columns)
        return df.withColumns({c: F.lit("x") for c in CLASHES}) if clash else df

    return make
