"""Joins against reference tables, with the size check behind every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sku_key, to_usd, utc_date

# A table is broadcast up to this estimated size, which for stored tables is that of
# their compressed columns; a larger one is joined by a shuffle, where adaptive
# execution splits hot keys.
BROADCAST_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The size the optimizer expects, from file sizes and types; runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is expected to take at most ``max_bytes``."""
    return estimated_bytes(df) <= max_bytes


def checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it fits, else unmarked for a shuffled join."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def latest_rates(fx: DataFrame) -> DataFrame:
    """The newest rate of every currency."""
    return fx.groupBy("currency").agg(F.max_by("rate_to_usd", "rate_date").alias("latest_rate"))


def attach_rate(
    df: DataFrame, fx: DataFrame, latest: DataFrame, instant: str = "order_dt_utc"
) -> DataFrame:
    """Add ``rate_to_usd``: the rate of the UTC day, else the newest of that currency.

    ``fx`` has one row per currency and day, ``latest`` one per currency; both
    come from :func:`checked`, so the large side is not moved for a small table.
    """
    daily = fx.withColumnsRenamed({"rate_date": "_rate_date", "rate_to_usd": "_day_rate"})
    # Only rows without a rate of their day look further. A key that depends on the
    # row also stays a join key where the currency is one literal for a whole channel.
    undated = F.when(F.col("_day_rate").isNull(), F.col("currency"))
    return (
        df.withColumn("_rate_date", utc_date(F.col(instant)))
        .join(daily, ["currency", "_rate_date"], "left")
        .withColumn("_undated", undated)
        .join(latest.withColumnRenamed("currency", "_undated"), "_undated", "left")
        .withColumn("rate_to_usd", F.coalesce("_day_rate", "latest_rate"))
        .drop("_rate_date", "_day_rate", "_undated", "latest_rate")
    )


def apply_fx(df: DataFrame, fx: DataFrame, latest: DataFrame, rate: str | None = None) -> DataFrame:
    """Unit price and line total in USD; the rate is kept as the column ``rate`` if one is named."""
    rated = attach_rate(df, fx, latest)
    return rated.withColumns(
        {
            "unit_price_usd": to_usd(F.col("unit_price_local"), F.col("rate_to_usd")),
            "line_total_usd": to_usd(F.col("line_total_local"), F.col("rate_to_usd")),
        }
    ).withColumnRenamed("rate_to_usd", rate or "rate_to_usd").drop("rate_to_usd")


def map_status(df: DataFrame, statuses: DataFrame) -> DataFrame:
    """Add ``order_status``; a status without a mapping becomes ``unknown``."""
    return (
        df.join(statuses, ["source_platform", "raw_status"], "left")
        .withColumn("order_status", F.coalesce("canonical_status", F.lit("unknown")))
        .drop("canonical_status")
    )


def sku_lookup(mapping: DataFrame) -> DataFrame:
    """The SKU mapping with one row per channel and match key.

    Keys that differ only in case or outer blanks would multiply sales rows, so
    the smallest canonical SKU wins; :func:`mapping_conflicts` lists those keys.
    """
    fields = F.struct("sku_canonical", "product_name", "category")
    return (
        mapping.groupBy("source_platform", sku_key(F.col("platform_sku")).alias("_sku_key"))
        .agg(F.min(fields).alias("_row"))
        .select(
            "source_platform",
            "_sku_key",
            "_row.sku_canonical",
            F.col("_row.product_name").alias("canonical_product_name"),
            "_row.category",
        )
    )


def checked_lookup(mapping: DataFrame) -> DataFrame:
    """:func:`sku_lookup`, broadcast if the mapping, which is no smaller, fits."""
    lookup = sku_lookup(mapping)
    return F.broadcast(lookup) if fits(mapping) else lookup


def mapping_conflicts(mapping: DataFrame) -> DataFrame:
    """Match keys that more than one mapping row claims."""
    return (
        mapping.groupBy("source_platform", sku_key(F.col("platform_sku")).alias("sku_key"))
        .agg(F.count("*").alias("mapping_rows"), F.min("sku_canonical").alias("sku_canonical"))
        .where("mapping_rows > 1")
    )


def attach_canonical(
    df: DataFrame, lookup: DataFrame, platform: Column | None = None
) -> DataFrame:
    """Add canonical SKU, product name and category; null where nothing matches."""
    keyed = df.withColumn("_sku_key", sku_key(F.col("platform_sku")))
    if platform is not None:
        keyed = keyed.withColumn("source_platform", platform)
    return keyed.join(lookup, ["source_platform", "_sku_key"], "left").drop("_sku_key")


def unmapped_skus(df: DataFrame, rows: Column | None = None) -> DataFrame:
    """Rows per channel and SKU that found no canonical SKU; null SKUs form no group.

    ``rows`` is how many rows a row stands for, by default one.
    """
    return (
        df.where(F.col("sku_canonical").isNull() & F.col("platform_sku").isNotNull())
        .groupBy("source_platform", "platform_sku")
        .agg((F.count("*") if rows is None else F.sum(rows)).alias("occurrences"))
    )


def sku_coverage(df: DataFrame, rows: Column | None = None) -> DataFrame:
    """How many rows found a canonical SKU; ``rows`` is how many a row stands for, by default one."""
    each = F.lit(1) if rows is None else rows
    found = F.col("sku_canonical").isNotNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, each)), F.lit(0)).cast("bigint")

    return df.agg(
        total(F.lit(True)).alias("total_rows"), total(found).alias("matched"), total(~found).alias("unmatched")
    )


def unmapped_totals(counts: DataFrame) -> DataFrame:
    """Distinct unmapped pairs and the rows they cover."""
    return counts.agg(
        F.count("*").alias("unmapped_pairs"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("rows_covered"),
    )
