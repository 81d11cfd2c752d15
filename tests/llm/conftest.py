import pytest
from edge_cases import CLASHING, SCHEMA, SF_DIR, edge_rows
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with columns of clashing names."""
    rows = spark.createDataFrame(edge_rows(), SCHEMA)
    return rows.withColumns({name: F.lit("other") for name in CLASHING}).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").persist()


@pytest.fixture(scope="session")
def some(documents):
    """A part of the documents, small enough for quadratic brute force."""
    return documents.filter("doc_id < 120").persist()
