"""Steps of the training-data operators leave no shuffle files behind."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tributary.llm import storage, suffix_dedup
from tributary.session import SHUFFLE_CLEANUP


def shuffle_bytes(spark) -> int:
    """Bytes of shuffle files that the session's block manager holds on disk."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = [os.path.join(d, f) for top in local for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in found if f.endswith(".data"))


def test_a_stored_step_leaves_no_shuffle_files(spark):
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        before = shuffle_bytes(spark)
        rows = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        found = storage.stored(rows.groupBy("k").agg(F.collect_set("v").alias("v")), "test-disk")
        assert found.count() == 5_000
        assert shuffle_bytes(spark) - before < 100_000
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, "true")


def test_suffix_passes_leave_no_shuffle_files(spark):
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        before = shuffle_bytes(spark)
        words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(150)), lambda i: F.sha2(F.concat(i, F.lit("/"), F.col("id") % 90), 224)), " ")
        docs = spark.range(100).select(F.col("id").alias("doc_id"), words.alias("text"))
        found = suffix_dedup.remove_repeats(docs)  # its passes are stored, the last join is still to come
        assert shuffle_bytes(spark) - before < 100_000
        assert found.where("n_removed = n_bytes").count() == 20
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
