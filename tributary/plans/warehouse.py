"""Star schema: seeds, dimensions, fact rows and the two report views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import utc_date
from ..literals import literal_table
from ..operators.lookup import attach_canonical, fits
from ..operators.reshape import calendar
from .channels import CHANNELS, Channel

# Raw status of each channel and the status it stands for.
STATUS_ROWS = [
    ("shopify", "paid", "paid"),
    ("shopify", "pending", "pending"),
    ("shopify", "refunded", "refunded"),
    ("shopify", "partially_refunded", "partially_refunded"),
    ("mercadolibre", "paid", "paid"),
    ("mercadolibre", "cancelled", "cancelled"),
    ("mercadolibre", "refunded", "refunded"),
    ("amazon", "Shipped", "paid"),
    ("amazon", "Pending", "pending"),
    ("amazon", "Cancelled", "cancelled"),
    ("amazon", "Refunded", "refunded"),
    ("tiendanube", "Pagado", "paid"),
    ("tiendanube", "Pendiente de pago", "pending"),
    ("tiendanube", "Cancelado", "cancelled"),
    ("tiendanube", "Reembolsado", "refunded"),
    ("pos", "EFECTIVO", "paid"),
    ("pos", "TARJETA", "paid"),
    ("pos", "YAPE", "paid"),
    ("pos", "PLIN", "paid"),
]

# Fixed value: category shown for sales without a canonical product.
NO_CATEGORY = "Sin categoría"

# Default range of the calendar.
CALENDAR_FIRST, CALENDAR_LAST = "2024-01-01", "2028-12-31"


def status_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, STATUS_ROWS, schemas.STATUS_MAPPING)


def platform_seed(spark: SparkSession, channels: Iterable[Channel] | None = None) -> DataFrame:
    """One row per registered channel, numbered in order of registration."""
    listed = CHANNELS.values() if channels is None else channels
    rows = [(i, c.name, c.label, c.kind, True) for i, c in enumerate(listed, start=1)]
    return literal_table(spark, rows, schemas.DIM_PLATFORM)


def dim_date(
    spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST
) -> DataFrame:
    """The calendar of a fixed range."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )
    return calendar(bounds)


def dim_date_for(rows: DataFrame, day: Column) -> DataFrame:
    """The calendar of the whole years that have days of ``rows``.

    Years between them are left out, so that a mistyped year adds itself alone.
    """
    years = rows.select(F.trunc(day, "year").alias("first_day")).distinct()
    last = F.date_sub(F.add_months("first_day", 12), 1).alias("last_day")
    return calendar(years.where("first_day IS NOT NULL").select("first_day", last))


def fact_rows(
    staging: DataFrame, platforms: DataFrame, sku_lookup: DataFrame, products: DataFrame
) -> DataFrame:
    """Staging rows with their dimension keys.

    Rows of an unknown channel are dropped; a SKU that no mapping or product
    knows leaves ``product_id`` null. The small tables come from ``checked``.
    Lookup and products meet first, so that tables too large to be broadcast
    move the sales rows once, not once each.
    """
    ids = platforms.select(F.col("platform_code").alias("source_platform"), "platform_id")
    known = products.select("sku_canonical", "product_id")
    small = fits(sku_lookup) and fits(known)
    lookup = sku_lookup.drop("canonical_product_name", "category").join(known, "sku_canonical", "left")
    mapped = attach_canonical(staging, F.broadcast(lookup) if small else lookup)
    return (
        mapped.join(F.broadcast(ids), "source_platform", "inner")
        .withColumn("date_id", utc_date(F.col("order_dt_utc")))
        .select(*[f.name for f in schemas.FACT_SALES if f.name not in ("sale_id", "loaded_at")])
    )


def outside_calendar(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows whose day the calendar lacks; the views would leave them out."""
    return facts.join(dates.select("date_id"), "date_id", "left_anti")


def _dated(facts: DataFrame, platforms: DataFrame, dates: DataFrame) -> DataFrame:
    platform = platforms.select("platform_id", "platform_code", "platform_name", "platform_type")
    return facts.join(F.broadcast(platform), "platform_id", "inner").join(dates, "date_id", "inner")


def _with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    return rows.join(
        products.select("product_id", "product_name", "category"), "product_id", "left"
    )


def sales_wide(
    facts: DataFrame, platforms: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """The wide sales view: every fact with its dimension attributes.

    Products come first: facts that are moved for them do not carry the attributes of day and platform.
    """
    return _dated(_with_product(facts, products), platforms, dates).select(
        "sale_id", "order_dt_utc", "date_id",
        "year", "quarter", "month", "month_name", "day_name", "is_weekend",
        "platform_code", "platform_name", "platform_type",
        "sku_canonical", "product_name", "category",
        "platform_order_id", "platform_line_id", "platform_sku",
        "quantity", "unit_price_local", "discount_local", "tax_local", "line_total_local",
        "currency", "unit_price_usd", "line_total_usd",
        "order_status", "customer_email", "loaded_at",
    )


def revenue_monthly(
    facts: DataFrame, platforms: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Paid revenue by month, channel and category.

    Facts are summed by month and product before they meet the products, whatever
    the size of these: only these sums are shuffled, partial ones at that, and the
    facts without a product, one hot null key, are a row a month by then.
    """
    month = ["year", "month", "month_name", "platform_name"]
    measures = ["_lines", "_units", "_usd"]
    rows = _dated(facts.where(F.col("order_status") == "paid"), platforms, dates).select(
        *month,
        "product_id",
        F.lit(1).cast("bigint").alias("_lines"),
        F.col("quantity").cast("bigint").alias("_units"),
        F.col("line_total_usd").alias("_usd"),
    )
    sums = rows.groupBy(*month, "product_id").agg(*[F.sum(m).alias(m) for m in measures])
    category = F.coalesce("category", F.lit(NO_CATEGORY)).alias("category")
    return (
        _with_product(sums, products)
        .groupBy(*month, category)
        .agg(
            F.sum("_lines").alias("line_items"),
            F.sum("_units").alias("units"),
            F.round(F.sum("_usd"), 2).alias("revenue_usd"),
        )
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """The newest runs first."""
    return (
        runs.select("run_id", "started_at", "status").orderBy(F.desc("run_id")).limit(limit)
    )
