import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: documents with columns that clash with names the operators add
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("kept", T.StringType()), T.StructField("id", T.LongType()),
                       T.StructField("tokens", T.LongType()), T.StructField("h", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 99, -1, "h") for i, t in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def texts():
    """doc_id → text of the small documents table (NULL: empty)."""
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)
