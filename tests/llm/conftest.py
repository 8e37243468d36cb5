import pytest
from pyspark.sql import functions as F

from hourgrid.llm.ship import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""

    def make(rows):
        made = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(made, DOCS)

    return make


@pytest.fixture(scope="session")
def clashing():
    """The frame with more columns, named as operators might name theirs."""

    def more(df, *names):
        every = ("class", "block", "chunk", "token", "n", "key", "row", "score", "spans", "text_hash", "label", *names)
        return df.withColumns({c: F.lit("x") for c in every if c not in df.columns})

    return more


@pytest.fixture(scope="session")
def read(sf_dir, spark):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
