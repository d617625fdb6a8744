"""Operators that depend on row order: keep-last, line positions, surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_by_key(
    df: DataFrame, keys: list[str], order_by: list[str], keep: str = "last"
) -> DataFrame:
    """One row per key: the last (or first) in ``order_by``.

    Spark keeps one row per key in every map task before the shuffle, so a key
    that holds much of the data costs one row per task there.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', got {keep!r}")
    sort = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop rows that miss a required value (run after the dedupe)."""
    return df.dropna(subset=required)


def line_position(
    df: DataFrame, group: list[str], order_by: list[str], slice_of: Column, name: str = "line_pos"
) -> DataFrame:
    """Number the rows of every group from 1 in ``order_by``.

    ``slice_of`` cuts the order into runs that no task has trouble holding and
    must not decrease along ``order_by``. Rows are numbered inside a slice, and
    the rows of earlier slices of the same group are added, so that a group of
    any size is numbered by many tasks.
    """
    sliced = df.withColumn("_slice", slice_of)
    key = [*group, "_slice"]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .where(F.col("_before").isNotNull())
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(*key).orderBy(*order_by))
    return (
        sliced.withColumn("_inside", inside)
        .join(offsets, key, "left")
        .withColumn(name, F.col("_inside") + F.coalesce("_before", F.lit(0)))
        .drop("_slice", "_inside", "_before")
    )


def key_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of a natural key; depends on the key alone, so rows never move."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def surrogate_ids(
    df: DataFrame, keys: list[str], start: int, buckets: int, name: str, known: str | None = None
) -> DataFrame:
    """The ids ``start + 1`` to ``start + n`` for n new rows, the same on every re-run of a task.

    Rows are cut into ``buckets`` slices by the MD5 of their key and counted per
    slice; a row's id is the count of the slices before its own plus its place in
    it, by key. ``keys`` must be unique in ``df``, which is read twice. Rows with an
    id in the column ``known`` keep it and use up no new one.
    """
    fresh = F.lit(True) if known is None else F.col(known).isNull()
    text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    sliced = df.withColumns({"_slice": (digits % buckets).cast("int"), "_fresh": fresh})
    # One row a slice; these few are numbered in one task.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.where("_fresh")
        .groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    nth = F.row_number().over(Window.partitionBy("_slice", "_fresh").orderBy(*keys))
    new_id = F.lit(start) + F.col("_before") + F.col("_nth")
    given = F.lit(None) if known is None else F.col(known)
    ids = F.when(F.col("_fresh"), new_id).otherwise(given).cast("bigint")
    return (
        sliced.withColumn("_nth", nth)
        .join(F.broadcast(offsets), "_slice", "left")  # at most ``buckets`` rows
        .withColumn(name, ids)
        .drop("_slice", "_fresh", "_nth", "_before")
    )
