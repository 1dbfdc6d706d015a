"""Rows that the tests of the operators share."""

from pyspark.sql import types as T


def docs_of(spark, rows, extra=False):
    """(doc_id, text) rows, with columns whose names clash if asked for."""
    schema = "doc_id long, text string"
    if extra:
        rows = [(*r, "x", 1, 2, 3) for r in rows]
        schema += ", lang string, n long, node long, rank long"
    return spark.createDataFrame(rows, schema)


#: Rows every operator on documents must survive.
ODD = [(1, None), (2, ""), (None, "a null id has words, five of them"), (3, "one"), (3, "one"),
       (4, "word " * 50_000), (5, "x" * 200_000), (6, "\x00\t\r\n  　é"), (7, "same text here"), (8, "same text here")]

EMPTY = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
