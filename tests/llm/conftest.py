import pytest
from pyspark.sql import types as T

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def documents(spark):
    """A table of documents from texts or (doc_id, text, source) tuples."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "s") for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOC)

    return make
