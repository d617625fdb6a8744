"""Generators and reshapes: calendar, catalog unpivot, union of channels."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import calendar_parts
from .ordering import dedupe_by_key, drop_incomplete


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day``, the columns of ``bounds``."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date_id")
    )
    return days.select("date_id", *calendar_parts(F.col("date_id")))


def unpivot_catalog(catalog: DataFrame, sku_columns: dict[str, str]) -> DataFrame:
    """Catalog with one SKU column per channel to one row per channel and SKU.

    ``sku_columns`` maps a channel to its column.
    """
    rest = [c for c in catalog.columns if c not in sku_columns.values()]
    named = catalog.select(*rest, *[F.col(c).alias(p) for p, c in sku_columns.items()])
    return named.unpivot(rest, list(sku_columns), "source_platform", "platform_sku")


def union_channels(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def stage_counts(
    extracted: DataFrame, keys: list[str], order_by: Column, required: list[str]
) -> DataFrame:
    """Rows extracted, duplicates dropped, incomplete rows dropped, rows staged.

    Counted from one aggregation per key, exact also when tasks are repeated.
    """
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    per_key = extracted.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.max_by(complete, order_by).alias("_complete")
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("extracted"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_dropped"),
        F.count_if(~F.col("_complete")).alias("incomplete_dropped"),
        F.count_if(F.col("_complete")).alias("staged"),
    )


def observed_stages(
    extracted: DataFrame, keys: list[str], order_by: list[str], required: list[str]
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The staged rows, and their :func:`stage_counts` once these rows have been written.

    The rows are counted as they pass, so no stage is read again for its count.
    """
    marks = [Observation() for _ in range(3)]

    def passing(rows: DataFrame, mark: Observation) -> DataFrame:
        return rows.observe(mark, F.count(F.lit(1)).alias("rows"))

    newest = passing(dedupe_by_key(passing(extracted, marks[0]), keys, order_by), marks[1])
    staged = passing(drop_incomplete(newest, required), marks[2])

    def counts() -> dict[str, int]:
        read, distinct, kept = (mark.get["rows"] for mark in marks)
        return {
            "extracted": read,
            "duplicates_dropped": read - distinct,
            "incomplete_dropped": distinct - kept,
            "staged": kept,
        }

    return staged, counts
