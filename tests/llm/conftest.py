from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """``docs([(doc_id, text), ...])`` as a documents table."""
    from pyspark.sql import types as T

    def make(rows):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
            ]
        )
        full = [(r[0], r[1], *(r[2:4] or ("en", "src0")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
