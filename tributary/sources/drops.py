"""Readers for the channels' drops. An absent drop is an empty DataFrame.

Every reader adds ``source_file``, which the landing keeps, ``file_block`` (where
the split starts) and ``file_row`` (position of an element of a wrapped array).
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..literals import literal_table
from . import split_json

log = logging.getLogger(__name__)

POSITION = schemas.struct("source_file string, file_block bigint, file_row int")

# A JSON file up to this size is parsed as one row, which takes many times its size.
WHOLE_BYTES = 8 << 20

# Report headers and the raw columns they become.
AMAZON_HEADERS = {
    "amazon-order-id": "amazon_order_id",
    "merchant-order-id": "merchant_order_id",
    "purchase-date": "purchase_date",
    "last-updated-date": "last_updated_date",
    "order-status": "order_status",
    "sku": "sku",
    "product-name": "product_name",
    "quantity-purchased": "quantity_purchased",
    "currency": "currency",
    "item-price": "item_price",
    "item-tax": "item_tax",
    "shipping-price": "shipping_price",
    "buyer-email": "buyer_email",
    "ship-city": "ship_city",
    "ship-state": "ship_state",
}
TIENDANUBE_HEADERS = {
    "N° de orden": "n_orden",
    "Fecha": "fecha",
    "Estado del pago": "estado_pago",
    "Estado del envío": "estado_envio",
    "Cliente": "cliente",
    "Email": "email",
    "SKU": "sku",
    "Producto": "producto",
    "Cantidad": "cantidad",
    "Precio unitario": "precio_unit",
    "Descuento": "descuento",
    "Subtotal": "subtotal",
    "Moneda": "moneda",
}


def _file_position(row: Column | None = None) -> list[Column]:
    return [
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_block"),
        (F.lit(0) if row is None else row).cast("int").alias("file_row"),
    ]


def present_or_empty(
    spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType
) -> DataFrame:
    """The drop, or no rows (and a warning) where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("drop not found, nothing to ingest: %s", error.getMessageParameters())
        return literal_table(spark, [], T.StructType([*schema.fields, *POSITION.fields]))


def wrapped_json(
    spark: SparkSession, path: str | list[str], wrapper: str, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """Files of one JSON object each; one row per element of its ``wrapper`` array.

    Elements stay verbatim text, so that a missing key can still be told from an
    explicit null. A file without the wrapper yields no rows; a broken file fails.
    A drop with a file of more than ``whole_bytes``, by its listing, is cut at the
    ends of its elements and read by many tasks; else each file is one row of one.
    """

    def read() -> DataFrame:
        sizes = spark.read.format("binaryFile").load(path).select("length")
        large = (sizes.agg(F.max("length")).first()[0] or 0) > whole_bytes
        rows = split_json.elements(spark, path, wrapper) if large else _whole_json(spark, path, wrapper)
        return rows.select(
            F.get_json_object("payload", "$.id").try_cast("bigint").alias("order_id"),
            "payload",
            *POSITION.names,
        )

    return present_or_empty(spark, read, schemas.JSON_ORDERS)


def _whole_json(spark: SparkSession, path: str | list[str], wrapper: str) -> DataFrame:
    documents = (
        spark.read.schema(f"`{wrapper}` array<string>")
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    position = F.posexplode(wrapper).alias("file_row", "payload")
    return documents.select(*_file_position()[:2], position)


def verbatim_tsv(spark: SparkSession, path: str | list[str], headers: dict[str, str]) -> DataFrame:
    """Tab-separated text, every column kept as text; only the empty field is null.

    The first line of each file names its columns, in any order and with others
    among them; a file that lacks one of ``headers`` fails with the column's name.
    A field may be quoted, a quote in it doubled. Lines that repeat the header are
    left out; a short line has nulls.
    """
    renamed = T.StructType([T.StructField(name, T.StringType()) for name in headers.values()])

    def read() -> DataFrame:
        lines = spark.read.text(path)
        first = (
            lines.where(F.col("_metadata.file_block_start") == 0)
            .select(
                F.col("_metadata.file_path").alias("_file"), "value", F.monotonically_increasing_id().alias("_at")
            )
            .groupBy("_file")
            .agg(F.min_by("value", "_at").alias("_header"))
        )
        # One row a layout, however many files there are.
        layouts = first.groupBy("_header").agg(F.min("_file").alias("file")).collect()
        rows = lines.select("value", *_file_position(), F.col("_metadata.file_path").alias("_file"))
        places = {row["_header"]: _places(row["_header"], row["file"], headers) for row in layouts}
        if len(places) == 1:
            rows = rows.withColumn("_header", F.lit(next(iter(places))))
        else:
            rows = rows.join(first, "_file")
        widest = max((len(_fields(h)) for h in places), default=1)
        cells = F.from_csv(
            "value",
            T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(widest)]).simpleString()[7:-1].replace(":", " "),
            {"sep": "\t", "escape": '"', "mode": "PERMISSIVE"},
        )
        split = rows.where(F.col("value") != F.col("_header")).where("value <> ''").withColumn("_cells", cells)

        def column(name: str) -> Column:
            found = F.lit(None).cast("string")
            for header, place in places.items():
                cell = F.col("_cells").getField(f"c{place[name]}")
                found = cell if len(places) == 1 else F.when(F.col("_header") == header, cell).otherwise(found)
            return F.nullif(found, F.lit(""))

        return split.select(*[column(old).alias(new) for old, new in headers.items()], *POSITION.names)

    return present_or_empty(spark, read, renamed)


def _fields(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")], delimiter="\t"), [])


def _places(header: str, file: str, headers: dict[str, str]) -> dict[str, int]:
    """Where each column stands in a file with this header line."""
    found = {name: i for i, name in reversed(list(enumerate(_fields(header))))}
    missing = [name for name in headers if name not in found]
    if missing:
        raise ValueError(f"{file}: column missing: {', '.join(missing)}")
    return found


def table_snapshot(
    spark: SparkSession,
    source: str | list[str],
    schema: T.StructType,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """Column-pruned scan of an operational table, kept as parquet or behind JDBC.

    ``jdbc`` holds the reader's options (``url``, ``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions``); ``source`` is then the
    table's name, and its columns are cast to ``schema``. Filters added later on
    columns that need no cast reach the database.
    """
    if jdbc:
        table = spark.read.format("jdbc").options(dbtable=source, **jdbc).load()
        return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return present_or_empty(
        spark,
        lambda: spark.read.schema(schema).parquet(*([source] if isinstance(source, str) else source)),
        schema,
    ).select(*schema.names)


def newer_than(
    rows: DataFrame,
    time_column: str,
    watermark: Column | None,
    zone: str,
    lookback: timedelta = timedelta(),
) -> DataFrame:
    """High-watermark scan: rows whose wall time in ``zone`` is after the watermark.

    The watermark is an instant; rows at it or before it, and rows without a
    time, are left out. Without a watermark every row is taken. ``lookback``
    reads that much again to catch late rows, which the keyed upsert settles.
    """
    if watermark is None:
        return rows
    wall = F.from_utc_timestamp(watermark - F.lit(lookback), zone).cast("timestamp_ntz")
    return rows.where(F.col(time_column) > wall)


def data_watermark(rows: DataFrame, time_column: str, zone: str) -> DataFrame:
    """The newest wall time as an instant (null when there is none)."""
    newest = F.max(time_column).cast("timestamp_ltz")
    return rows.agg(F.to_utc_timestamp(newest, zone).alias("last_watermark"))
