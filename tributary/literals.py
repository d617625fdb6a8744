"""Small tables written down in the program."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType
) -> DataFrame:
    """Rows as a local relation: read without a task, and empty plans fold away."""
    columns = list(zip(*rows)) or [()] * len(schema)
    table = pa.table({f.name: pa.array(list(c)) for f, c in zip(schema, columns)})
    return spark.createDataFrame(table, schema)
