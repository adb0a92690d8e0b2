from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for columns of their own
        T.StructField("size", T.StringType()),
        T.StructField("ids", T.StringType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with two extra columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
