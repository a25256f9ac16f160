import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def hard(spark):
    """The hard texts, with other columns under names that the operators use themselves."""
    docs = spark.createDataFrame(plain.HARD, SCHEMA).repartition(3)
    clash = ["key", "h", "n", "rep", "component", "kept", "chunk", "short", "regs", "spans", "line", "id", "a", "b",
             "_found", "_score", "_words", "_known", "_lang_pred", "_sha", "_id", "digest", "row"]
    return docs.withColumns({c: F.lit(None).cast("string") for c in clash})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables, as a frame and as (id, text) pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
