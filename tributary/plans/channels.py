"""Channel registry: what differs from channel to channel, and nothing else.

A new channel is one more :class:`Channel` passed to :func:`register`; ingest,
normalization, validation and load go over the registry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.money import line_total
from ..operators.ordering import line_position
from ..sources import drops
from ..sources.landing import INGEST_ORDER, raw_slice
from ..sources.workbook import workbook

LIMA = "America/Lima"

# What ``extract`` must deliver, next to the ingest order columns.
EXTRACTED = [
    "raw_id", "platform_order_id", "platform_line_id", "order_dt_raw", "platform_sku",
    "product_name", "quantity", "unit_price_local", "discount_local", "tax_local",
    "line_total_local", "currency", "raw_status", "customer_email",
]

# The column that names an amount which is a number, but none that can be held.
BEYOND = "_beyond"

# Tasks that rows without an order are spread over, and the column that deals them.
SPREAD = 1024
APART = "_apart"

# Ingest order of a line: ``element`` is its place in the order's array.
LINE_ORDER = [*INGEST_ORDER, "element"]


@dataclass(frozen=True)
class Channel:
    """One sales channel.

    ``extract`` maps raw rows to ``EXTRACTED`` and ``LINE_ORDER`` columns, and ``APART``
    where they are dealt by it and the order.
    ``order_key`` is the order of a raw row: no line depends on rows of another order.
    ``malformed`` gives the reason why a raw row cannot be extracted, or null.
    ``post_clean`` may replace columns once prices and quantities are parsed. An
    ``extract`` that ``numbers_lines`` also takes the orders of very many lines.
    """

    name: str
    label: str
    kind: str
    raw_table: str
    raw_schema: T.StructType
    read: Callable[[SparkSession, str], DataFrame]
    extract: Callable[..., DataFrame]
    order_key: Callable[[], Column]
    malformed: Callable[[], Column] | None = None
    date_parser: str = "iso"
    zone: str = "UTC"
    decimal_sep: str = "."
    post_clean: Callable[[DataFrame], DataFrame] | None = None
    watermark_column: str | None = None
    lookback: timedelta = timedelta()
    land_order: tuple[str, ...] = ()
    numbers_lines: bool = False


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _no_amount() -> Column:
    return F.lit(None).cast(schemas.PARSED_AMOUNT)


# --- JSON orders ---------------------------------------------------------------

CORRUPT = "_corrupt"

# The parts of the documents that are read. ``variant`` marks values of which a
# missing key must be told from an explicit null.
SHOPIFY_ORDER = (
    "id string, created_at string, currency variant, financial_status string, "
    "customer struct<email string>, line_items array<struct<id string, sku string, "
    "title string, quantity string, price string, total_discount string, line_total string>>"
)
MERCADOLIBRE_ORDER = (
    "id string, date_created string, currency_id variant, status string, "
    "buyer struct<email string>, order_items array<struct<item struct<seller_sku string, "
    f"title string>, quantity variant, unit_price {schemas.PARSED_AMOUNT}>>"
)


def parse_order(shape: str) -> Column:
    return F.from_json(
        "payload", f"{shape}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
    )


def unless_given(value: Column | str, default: str | int, kind: str) -> Column:
    """A variant with a default for the missing key only; an explicit null stays null."""
    given = F.col(value) if isinstance(value, str) else value
    return F.when(given.isNull(), F.lit(default).cast(kind)).otherwise(
        F.try_variant_get(given, "$", kind)
    )


def json_malformed(shape: str, created_key: str, lines_key: str) -> Column:
    """Why a document cannot be extracted, or null."""

    def reason(document: Column) -> Column:
        lines = F.try_variant_get(document, f"$.{lines_key}", "variant")
        as_array = F.try_variant_get(document, f"$.{lines_key}", "array<variant>")
        return F.coalesce(
            F.when(document.isNull(), "payload: not a JSON document"),
            F.when(F.try_variant_get(document, "$.id", "string").isNull(), "id: missing"),
            F.when(
                F.try_variant_get(document, f"$.{created_key}", "string").isNull(),
                f"{created_key}: missing",
            ),
            F.when(lines.isNotNull() & as_array.isNull(), f"{lines_key}: not an array"),
            F.when(
                parse_order(shape).getField(CORRUPT).isNotNull(), "payload: not an order document"
            ),
        )

    # Named by a transform, the document is parsed once, not for each rule.
    return F.transform(F.array(F.try_parse_json("payload")), reason)[0]


def explode_lines(raw: DataFrame, shape: str, lines_key: str) -> DataFrame:
    """One row per line object (``line``, 0-based ``element``) with its order's fields.

    Orders without lines yield no rows. They go after an outer explode: for an
    inner one the optimizer puts a filter on the array below the parse, which
    would parse every document once more.
    """
    orders = raw.select(*INGEST_ORDER, parse_order(shape).alias("doc")).select(
        *INGEST_ORDER, "doc.*"
    )
    rest = [c for c in orders.columns if c not in (lines_key, CORRUPT)]
    lines = F.posexplode_outer(lines_key).alias("element", "line")
    return orders.select(*rest, lines).where("element IS NOT NULL")


def extract_shopify(raw: DataFrame) -> DataFrame:
    return explode_lines(raw, SHOPIFY_ORDER, "line_items").select(
        *LINE_ORDER,
        F.col("id").alias("platform_order_id"),
        F.col("line.id").alias("platform_line_id"),
        F.col("created_at").alias("order_dt_raw"),
        F.col("line.sku").alias("platform_sku"),
        F.col("line.title").alias("product_name"),
        F.col("line.quantity").alias("quantity"),
        F.col("line.price").alias("unit_price_local"),
        F.col("line.total_discount").alias("discount_local"),
        _no_amount().alias("tax_local"),
        F.col("line.line_total").alias("line_total_local"),
        unless_given("currency", "USD", "string").alias("currency"),
        F.col("financial_status").alias("raw_status"),
        F.col("customer.email").alias("customer_email"),
    )


def extract_mercadolibre(raw: DataFrame) -> DataFrame:
    order_id = F.col("id")
    return explode_lines(raw, MERCADOLIBRE_ORDER, "order_items").select(
        *LINE_ORDER,
        order_id.alias("platform_order_id"),
        F.concat(order_id, F.lit("-"), F.col("element") + 1).alias("platform_line_id"),
        F.col("date_created").alias("order_dt_raw"),
        F.col("line.item.seller_sku").alias("platform_sku"),
        F.col("line.item.title").alias("product_name"),
        unless_given("line.quantity", 0, "decimal(18,4)").alias("quantity"),
        F.coalesce("line.unit_price", F.lit(0)).alias("unit_price_local"),
        F.lit(0).cast(schemas.PARSED_AMOUNT).alias("discount_local"),
        _no_amount().alias("tax_local"),
        _no_amount().alias("line_total_local"),
        unless_given("currency_id", "PEN", "string").alias("currency"),
        F.col("status").alias("raw_status"),
        F.col("buyer.email").alias("customer_email"),
    )


def document_id() -> Column:
    """The order of a document, as the extraction reads it."""
    return F.from_json("payload", "id string").getField("id")


# --- line-level reports --------------------------------------------------------


def numbered_lines(raw: DataFrame, order_column: str, crowded: Sequence[str] = ()) -> DataFrame:
    """Number the lines of an order as ``line_pos``; reports have no line id.

    A line is known by its order, its SKU and which of the lines of that SKU it is
    inside its batch. An order's lines are numbered by first appearance over all
    batches: a report that lands again finds its own numbers, and lines that come
    in a later report get new ones. The rows are dealt by order once and read once;
    rows without an order, which get no number, are spread by ``APART``. Both columns
    stay, so that a later step finds an order's rows where they are. Orders in
    ``crowded`` are numbered slice by slice, by many tasks.
    """
    if crowded:
        many = F.coalesce(F.col(order_column).isin(list(crowded)), F.lit(False))
        few = numbered_lines(raw.where(~many), order_column)
        sliced = _numbered_by_slice(raw.where(many), order_column)
        return few.unionByName(sliced.withColumn(APART, F.lit(None).cast("bigint")))
    apart = F.when(F.col(order_column).isNull(), F.pmod("raw_id", F.lit(SPREAD)))
    rows = raw.withColumns({"_sku": F.coalesce("sku", F.lit("")), APART: apart})
    order = [order_column, APART]
    alike = Window.partitionBy(*order, "batch_id", "_sku").orderBy("source_file", "raw_id")
    line = Window.partitionBy(*order, "_sku", "_nth")
    return (
        rows.repartition(*order)
        .withColumn("_nth", F.row_number().over(alike))
        .withColumn("_first", F.min(F.struct(*INGEST_ORDER)).over(line))
        .withColumn("line_pos", F.dense_rank().over(Window.partitionBy(*order).orderBy("_first")))
        .drop("_sku", "_nth", "_first")
        .withColumn("element", F.lit(0))
    )


def _numbered_by_slice(raw: DataFrame, order_column: str) -> DataFrame:
    """The same for orders that no task should hold: the lines are joined with their numbers."""
    nth = line_position(
        raw.withColumn("_sku", F.coalesce("sku", F.lit(""))),
        ["batch_id", order_column, "_sku"],
        ["source_file", "raw_id"],
        raw_slice(),
        "_nth",
    )
    line = [order_column, "_sku", "_nth"]
    first = nth.groupBy(*line).agg(F.min(F.struct(*INGEST_ORDER)).alias("_first"))
    positions = line_position(
        first.select(*line, "_first.*"),
        [order_column],
        INGEST_ORDER,
        F.struct("batch_id", raw_slice().alias("slice")),
    ).select(*line, "line_pos")
    return nth.join(positions, line, "left").drop("_sku", "_nth").withColumn("element", F.lit(0))


def extract_amazon(raw: DataFrame, crowded: Sequence[str] = ()) -> DataFrame:
    return numbered_lines(raw, "amazon_order_id", crowded).select(
        *LINE_ORDER,
        APART,
        F.col("amazon_order_id").alias("platform_order_id"),
        F.concat("amazon_order_id", F.lit("-"), "line_pos").alias("platform_line_id"),
        F.col("purchase_date").alias("order_dt_raw"),
        F.col("sku").alias("platform_sku"),
        "product_name",
        F.col("quantity_purchased").alias("quantity"),
        F.col("item_price").alias("unit_price_local"),
        _no_amount().alias("discount_local"),
        F.col("item_tax").alias("tax_local"),
        _no_amount().alias("line_total_local"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        F.col("order_status").alias("raw_status"),
        F.col("buyer_email").alias("customer_email"),
    )


def computed_line_total(places: int) -> Callable[[DataFrame], DataFrame]:
    """For sources without a line total: unit price times quantity, returns negative."""

    def add(df: DataFrame) -> DataFrame:
        price, quantity = F.col("unit_price_local"), F.col("quantity")
        total = line_total(price, quantity, places)
        lost = price.isNotNull() & quantity.isNotNull() & total.isNull()
        beyond = F.coalesce(BEYOND, F.when(lost, "line_total_local"))
        return df.withColumns({"line_total_local": total, BEYOND: beyond})

    return add


def extract_tiendanube(raw: DataFrame, crowded: Sequence[str] = ()) -> DataFrame:
    return numbered_lines(raw, "n_orden", crowded).select(
        *LINE_ORDER,
        APART,
        F.col("n_orden").alias("platform_order_id"),
        F.concat("n_orden", F.lit("-"), "line_pos").alias("platform_line_id"),
        F.col("fecha").alias("order_dt_raw"),
        F.col("sku").alias("platform_sku"),
        F.col("producto").alias("product_name"),
        F.col("cantidad").alias("quantity"),
        F.col("precio_unit").alias("unit_price_local"),
        F.col("descuento").alias("discount_local"),
        _no_amount().alias("tax_local"),
        F.col("subtotal").alias("line_total_local"),
        F.coalesce("moneda", F.lit("PEN")).alias("currency"),
        F.col("estado_pago").alias("raw_status"),
        F.col("email").alias("customer_email"),
    )


def extract_pos(raw: DataFrame) -> DataFrame:
    """A till transaction is one line: its id is order id and line id."""
    sale = F.col("venta_id").cast("string")
    return raw.select(
        *INGEST_ORDER,
        F.lit(0).alias("element"),
        sale.alias("platform_order_id"),
        sale.alias("platform_line_id"),
        F.col("fecha_venta").alias("order_dt_raw"),
        F.col("sku").alias("platform_sku"),
        F.col("producto").alias("product_name"),
        F.col("cantidad").alias("quantity"),
        F.col("precio_unit").alias("unit_price_local"),
        F.col("descuento").alias("discount_local"),
        _no_amount().alias("tax_local"),
        F.col("total_linea").alias("line_total_local"),
        F.lit("PEN").alias("currency"),
        F.col("medio_pago").alias("raw_status"),
        _no_text().alias("customer_email"),
    )


# --- registry ------------------------------------------------------------------

SHOPIFY = Channel(
    name="shopify",
    label="Shopify",
    kind="ecommerce",
    raw_table="shopify_orders",
    raw_schema=schemas.JSON_ORDERS,
    read=lambda spark, path: drops.wrapped_json(spark, path, "orders"),
    extract=extract_shopify,
    order_key=document_id,
    malformed=lambda: json_malformed(SHOPIFY_ORDER, "created_at", "line_items"),
)
MERCADOLIBRE = Channel(
    name="mercadolibre",
    label="MercadoLibre",
    kind="marketplace",
    raw_table="mercadolibre_orders",
    raw_schema=schemas.JSON_ORDERS,
    read=lambda spark, path: drops.wrapped_json(spark, path, "results"),
    extract=extract_mercadolibre,
    order_key=document_id,
    malformed=lambda: json_malformed(MERCADOLIBRE_ORDER, "date_created", "order_items"),
    post_clean=computed_line_total(2),
)
AMAZON = Channel(
    name="amazon",
    label="Amazon",
    kind="marketplace",
    raw_table="amazon_shipments",
    raw_schema=schemas.AMAZON_SHIPMENTS,
    read=lambda spark, path: drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS),
    extract=extract_amazon,
    order_key=lambda: F.col("amazon_order_id"),
    numbers_lines=True,
    post_clean=computed_line_total(4),
)
TIENDANUBE = Channel(
    name="tiendanube",
    label="Tiendanube",
    kind="ecommerce",
    raw_table="tiendanube_ventas",
    raw_schema=schemas.TIENDANUBE_VENTAS,
    read=workbook,
    extract=extract_tiendanube,
    order_key=lambda: F.col("n_orden"),
    numbers_lines=True,
    date_parser="dmy",
    zone=LIMA,
)
POS = Channel(
    name="pos",
    label="Tienda Física",
    kind="pos",
    raw_table="pos_ventas",
    raw_schema=schemas.POS_VENTAS,
    read=lambda spark, path: drops.table_snapshot(spark, path, schemas.POS_VENTAS),
    extract=extract_pos,
    order_key=lambda: F.col("venta_id").cast("string"),
    date_parser="naive",
    zone=LIMA,
    watermark_column="fecha_venta",
    land_order=("fecha_venta", "venta_id"),
)

CHANNELS: dict[str, Channel] = {}


def register(channel: Channel) -> Channel:
    CHANNELS[channel.name] = channel
    return channel


for _channel in (SHOPIFY, MERCADOLIBRE, AMAZON, TIENDANUBE, POS):
    register(_channel)
