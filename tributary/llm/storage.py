"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import SHUFFLE_CLEANUP, scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read again, so its plan ends here.

    The shuffle files of the step go with it, so that the disk holds those of one step
    beside the stored tables, whenever Spark's own cleaner comes to them.
    """
    path = scratch_dir(df.sparkSession, label)
    df.sparkSession.conf.set(SHUFFLE_CLEANUP, "true")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
