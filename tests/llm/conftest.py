import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)
    return make


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "One two three"), (4, "One two three"), (None, "one two three"),
       (5, "Ünïcödé 世界 🙂 don't  stop"), (6, "word " * 5000), (7, "a"), (8, "a"), (9, "\x1c\x85  x")]
