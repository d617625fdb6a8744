"""Tables written between steps of a job, in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .session import scratch_dir


def stored(df: DataFrame, label: str, parts: Sequence[str] = ()) -> DataFrame:
    """``df`` written to a fresh shared folder, parted by ``parts``, and read again, so its plan ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
