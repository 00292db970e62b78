from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) and a column with a clashing name."""

    def make(rows):
        fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType())]
        schema = T.StructType([T.StructField(n, t) for n, t in [*fields, ("n_chars", T.LongType()), ("spans", T.StringType()), ("_id", T.LongType())]])
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), "x", 5) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


LONG = " ".join(f"word{i % 997} other{i % 13}," for i in range(30_000))
ODD = [
    (None, None),
    (None, "a text without an id"),
    (1, ""),
    (2, "   \n\n  "),
    (3, "one line that comes twice in here\none line that comes twice in here"),
    (4, "one line that comes twice in here!"),
    (5, "Ünïcode — \U0001f600 text\tand blanks\r\nend <|endoftext|> x"),
    (6, LONG),
    (7, LONG),
    (8, "same row"),
    (8, "same row"),
    (8, "other row of the same id"),
    (9, None, None, "s"),
    (10, "x" * 500),
]
