"""Table contracts: raw landing, staging, star schema, reference and ops."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Money is parsed and converted at this precision and stored as AMOUNT.
PARSED_AMOUNT = "decimal(28,10)"
AMOUNT = "decimal(12,4)"
RATE = "decimal(12,6)"


TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """A struct from ``name type, ...``; unlike ``fromDDL`` it needs no session."""
    fields = []
    for name, kind, precision, scale in re.findall(
        r"(\w+) (\w+)(?:\((\d+),\s*(\d+)\))?(?:,|$)", columns
    ):
        decimal = T.DecimalType(int(precision), int(scale)) if precision else None
        fields.append(T.StructField(name, decimal or TYPES[kind]))
    return T.StructType(fields)


# Every raw table also carries the landing columns.
LANDING_COLUMNS = "raw_id bigint, batch_id bigint, source_file string, ingested_at timestamp"

JSON_ORDERS = struct("order_id bigint, payload string")

AMAZON_SHIPMENTS = struct(
    "amazon_order_id string, merchant_order_id string, purchase_date string, "
    "last_updated_date string, order_status string, sku string, product_name string, "
    "quantity_purchased string, currency string, item_price string, item_tax string, "
    "shipping_price string, buyer_email string, ship_city string, ship_state string"
)

TIENDANUBE_VENTAS = struct(
    "n_orden string, fecha string, estado_pago string, estado_envio string, cliente string, "
    "email string, sku string, producto string, cantidad string, precio_unit string, "
    "descuento string, subtotal string, moneda string"
)

POS_VENTAS = struct(
    "venta_id bigint, fecha_venta timestamp_ntz, tienda_id int, cajero string, sku string, "
    "producto string, cantidad int, precio_unit decimal(12,2), descuento decimal(12,2), "
    "total_linea decimal(12,2), medio_pago string, cliente_doc string"
)

STAGING = struct(
    "source_platform string, platform_order_id string, platform_line_id string, "
    "order_dt_utc timestamp, platform_sku string, product_name string, quantity int, "
    f"unit_price_local {AMOUNT}, discount_local {AMOUNT}, tax_local {AMOUNT}, "
    f"line_total_local {AMOUNT}, currency string, unit_price_usd {AMOUNT}, "
    f"line_total_usd {AMOUNT}, order_status string, customer_email string, raw_id bigint"
)

# Staging as stored: with the rate that was applied, and rows that do not fit the types above say why.
STAGED_SALES = T.StructType([*STAGING.fields, *struct(f"applied_rate {RATE}, refusal string").fields])

NATURAL_KEY = ["source_platform", "platform_order_id", "platform_line_id"]

FX_RATES = struct(f"currency string, rate_date date, rate_to_usd {RATE}")
STATUS_MAPPING = struct("source_platform string, raw_status string, canonical_status string")
SKU_MAPPING = struct(
    "source_platform string, platform_sku string, sku_canonical string, product_name string, "
    "category string, base_price_usd decimal(12,2)"
)
PRODUCTS = struct(
    "sku_canonical string, product_name string, category string, base_price_usd decimal(12,2)"
)

DIM_PLATFORM = struct(
    "platform_id smallint, platform_code string, platform_name string, platform_type string, "
    "is_active boolean"
)
DIM_PRODUCT = struct(
    "product_id bigint, sku_canonical string, product_name string, category string, "
    "base_price_usd decimal(12,2), is_active boolean, loaded_at timestamp"
)
DIM_DATE = struct(
    "date_id date, year int, quarter int, month int, month_name string, day int, "
    "day_of_week int, day_name string, week_of_year int, is_weekend boolean"
)
FACT_SALES = struct(
    "sale_id bigint, platform_id smallint, product_id bigint, date_id date, "
    "source_platform string, platform_order_id string, platform_line_id string, "
    "platform_sku string, sku_canonical string, order_dt_utc timestamp, quantity int, "
    f"unit_price_local {AMOUNT}, discount_local {AMOUNT}, tax_local {AMOUNT}, "
    f"line_total_local {AMOUNT}, currency string, unit_price_usd {AMOUNT}, "
    f"line_total_usd {AMOUNT}, order_status string, customer_email string, loaded_at timestamp"
)

ETL_CHECKPOINTS = struct(
    "source_name string, last_watermark timestamp, updated_at timestamp, rows_ingested bigint"
)
# One row for each reason of a raw row's line, however often it is met.
REJECT_KEY = ["source_name", "raw_id", "platform_line_id", "reason"]
REJECTED_ROWS = struct(
    "source_name string, raw_id bigint, platform_line_id string, reason string, payload string, "
    "first_run_id bigint, last_run_id bigint, rejected_at timestamp, last_rejected_at timestamp"
)
UNMAPPED_SKUS = struct(
    "source_name string, platform_sku string, occurrences bigint, first_seen_at timestamp, "
    "last_seen_at timestamp, resolved boolean"
)
PIPELINE_RUNS = struct(
    "run_id bigint, started_at timestamp, finished_at timestamp, status string, "
    "sources_summary string, error_message string"
)
