import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts; ids are places unless given."""
    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = list(zip(ids or range(n), texts, langs or ["en"] * n, sources or ["s"] * n, [len(t or "") for t in texts]))
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture(scope="session")
def clash(spark):
    """Adds columns named like those the operators use inside."""
    from pyspark.sql import functions as F
    names = ["key", "id", "k", "h", "tid", "rid", "component", "n", "size", "times", "score", "start", "tokens", "fp", "vec", "html_", "ids", "spans", "status"]

    def add(df):
        return df.select("*", *(F.lit("x").alias(c) for c in names if c not in df.columns))
    return add
