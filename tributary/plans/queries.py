"""One query per operator over the driver's tables.

Results hold plain types: decimals as double, whole numbers as bigint, dates and
instants (UTC) as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..literals import literal_table
from ..functions import (
    calendar_parts,
    clean_sku,
    dmy_to_utc,
    iso_to_utc,
    naive_to_utc,
    parse_int,
    parse_money,
    row_json,
    utc_date,
)
from ..functions.money import beyond_range
from ..operators import quality
from ..operators.lookup import (
    apply_fx,
    attach_canonical,
    checked,
    checked_lookup,
    latest_rates,
    map_status,
    mapping_conflicts,
    sku_coverage,
    unmapped_skus,
    unmapped_totals,
)
from ..operators.ordering import dedupe_by_key, drop_incomplete, line_position, surrogate_ids
from ..operators.reshape import observed_stages, stage_counts, union_channels, unpivot_catalog
from ..operators.upsert import insert_absent, merge_rows, read_table, upsert_table
from ..session import configure, scratch_dir
from ..sources import drops, landing, split_json
from ..sources.workbook import decode_workbooks, workbook
from ..storage import stored
from ..streaming.incremental import after_watermark, append_new_files, file_stream, upsert_new_files
from . import channels, daily, sample, warehouse
from .normalize import REQUIRED, Reference, judged, normalize, typed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """The result types every engine prints alike."""

    def column(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# --- shared inputs -----------------------------------------------------------------


def reference(spark: SparkSession, sf_dir: str) -> Reference:
    return Reference.of(sample.fx_rates(spark, sf_dir), warehouse.status_seed(spark))


def parsed(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "platform_sku": clean_sku(F.col("platform_sku")),
            "order_dt_utc": iso_to_utc(F.col("order_dt_raw")),
            "quantity": parse_int(F.col("quantity")),
            "unit_price_local": parse_money(F.col("unit_price_local")),
            "discount_local": parse_money(F.col("discount_local")),
            "line_total_local": parse_money(F.col("line_total_local")),
        }
    )


def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sample lines, parsed, before the dedupe."""
    return parsed(sample.sales_lines(spark, sf_dir))


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sample lines as staging rows."""
    key = ["platform_order_id", "platform_line_id", "source_platform"]
    newest = dedupe_by_key(cleaned_lines(spark, sf_dir), key, ["raw_id"])
    return typed(_converted(spark, sf_dir, drop_incomplete(newest, REQUIRED)))


def _converted(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    tables = reference(spark, sf_dir)
    full = lines.withColumns(
        {
            "product_name": F.lit(None).cast("string"),
            "tax_local": F.lit(None).cast(schemas.AMOUNT),
            "customer_email": F.lit(None).cast("string"),
        }
    )
    return map_status(apply_fx(full, tables.fx, tables.latest_fx), tables.statuses)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_catalog(sample.catalog(spark, sf_dir), sample.SKU_COLUMNS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(sample.dim_product(spark, sf_dir))


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lookup(mapping(spark, sf_dir))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar around the order days; one row per day, so always small."""
    orders = sample.table(spark, sf_dir, "orders")
    return F.broadcast(warehouse.dim_date_for(orders, F.to_date("o_orderdate")))


def facts(
    spark: SparkSession, sf_dir: str, staging: DataFrame, parts: DataFrame
) -> DataFrame:
    return warehouse.fact_rows(
        staging, warehouse.platform_seed(spark), lookup(spark, sf_dir), parts
    )


# --- report views --------------------------------------------------------------------


@query
def revenue_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = products(spark, sf_dir)
    return warehouse.revenue_monthly(
        facts(spark, sf_dir, staged_lines(spark, sf_dir), parts),
        warehouse.platform_seed(spark),
        parts,
        dates(spark, sf_dir),
    )


@query
def revenue_monthly_many_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report where the product table is too large to be broadcast."""
    parts = sample.dim_product(spark, sf_dir)
    return warehouse.revenue_monthly(
        facts(spark, sf_dir, staged_lines(spark, sf_dir), parts),
        warehouse.platform_seed(spark),
        parts,
        dates(spark, sf_dir),
    )


@query
def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = products(spark, sf_dir)
    rows = facts(spark, sf_dir, staged_lines(spark, sf_dir), parts).withColumns(
        {
            "sale_id": F.lit(None).cast("bigint"),
            "loaded_at": F.lit(None).cast("timestamp"),
        }
    )
    return warehouse.sales_wide(
        rows, warehouse.platform_seed(spark), parts, dates(spark, sf_dir)
    ).drop("sale_id", "loaded_at")


@query
def top_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders")
    runs = orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("started_at"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
    )
    return warehouse.recent_runs(runs)


# --- scalar functions ------------------------------------------------------------------


def _line_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.lineitem(spark, sf_dir).withColumn("raw_id", sample.line_raw_id())


LINE_ID = ["l_orderkey", "l_linenumber", "raw_id"]


@query
def clean_sku_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = sample.dressed_sku(F.lit("shopify"))
    blank = F.when(F.col("l_returnflag") == "R", sku).otherwise(
        F.when(F.col("l_linestatus") == "F", "  ").otherwise(sku)
    )
    return _line_text(spark, sf_dir).select(*LINE_ID, clean_sku(blank).alias("sku"))


@query
def parse_money_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(14,2)") * sample.signed_quantity()
    number = F.format_number(amount, 2)
    style = F.pmod("l_linenumber", F.lit(8))
    text = (
        F.when(style == 0, F.concat(F.lit("$"), number))
        .when(style == 1, F.concat(F.lit("USD "), number))
        .when(style == 2, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(style == 3, F.concat(F.lit("S/. "), number))
        .when(style == 4, F.concat(F.lit("("), number, F.lit(")")))
        .when(style == 5, F.col("l_returnflag"))
        .when(style == 6, F.concat(F.lit("xyz"), F.col("l_partkey")))
        .otherwise(F.concat(F.lit("-"), number))
    )
    return _line_text(spark, sf_dir).select(*LINE_ID, parse_money(text).alias("amount"))


@query
def huge_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of 15 to 21 whole digits: null beyond 18, and told from garbage."""
    digits = F.concat(F.repeat(F.lit("7"), F.col("l_linenumber") + 13), F.lit("."), F.lpad("l_partkey", 3, "0"))
    text = F.concat(F.when(F.col("l_returnflag") == "R", "-").otherwise("$"), digits)
    whole = F.when(F.col("l_linestatus") == "F", text).otherwise(F.concat(F.lit("-"), digits, F.lit("-")))
    return _line_text(spark, sf_dir).select(
        *LINE_ID, parse_money(whole).cast("string").alias("amount"), beyond_range(whole).alias("beyond")
    )


@query
def parse_money_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(14,2)") * sample.signed_quantity()
    european = F.translate(F.format_number(amount, 2), ",.", ".,")
    text = F.concat(F.lit("S/ "), european)
    return _line_text(spark, sf_dir).select(*LINE_ID, parse_money(text, ",").alias("amount"))


@query
def parse_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = sample.signed_quantity().cast("string")
    style = F.pmod("l_linenumber", F.lit(6))
    text = (
        F.when(style == 0, quantity)
        .when(style == 1, F.concat(F.lit(" "), quantity, F.lit(" ")))
        .when(style == 2, F.concat(quantity, F.lit(".0")))
        .when(style == 3, F.concat(quantity, F.lit(".5")))
        .when(style == 4, F.concat(quantity, F.lit(" pcs")))
        .otherwise(F.lit(""))
    )
    number = parse_int(text).cast("double")
    return _line_text(spark, sf_dir).select(*LINE_ID, number.alias("quantity"))


@query
def iso_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    style = F.pmod("event_id", F.lit(6))
    text = (
        F.when(style == 0, F.concat(wall, F.lit("-05:00")))
        .when(style == 1, F.concat(wall, F.lit("Z")))
        .when(style == 2, F.concat(wall, F.lit(".250+0530")))
        .when(style == 3, wall)
        .when(style == 4, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .otherwise(F.date_format("ts", "HH:mm"))
    )
    return sample.table(spark, sf_dir, "events").select(
        "event_id", iso_to_utc(text).alias("instant")
    )


@query
def lima_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    garbled = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(text)
    return sample.table(spark, sf_dir, "events").select(
        "event_id",
        naive_to_utc(garbled, channels.LIMA).alias("from_text"),
        naive_to_utc(F.col("ts"), channels.LIMA, typed=True).alias("from_time"),
    )


@query
def new_york_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone with clock changes: skipped and doubled wall times become null."""
    hour = F.pmod("l_partkey", F.lit(24)) * 2 + F.pmod("l_suppkey", F.lit(2))
    minutes = hour * F.lit(30)
    wall = F.col("l_shipdate") + F.make_dt_interval(mins=minutes.cast("int"))
    return _line_text(spark, sf_dir).select(
        *LINE_ID, naive_to_utc(wall, "America/New_York", typed=True).alias("instant")
    )


@query
def dmy_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    style = F.pmod("o_orderkey", F.lit(4))
    text = (
        F.when(style == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(style == 1, F.date_format("o_orderdate", "d/M/yyyy"))
        .when(style == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("31/02/"), F.year("o_orderdate")))
    )
    return sample.table(spark, sf_dir, "orders").select(
        "o_orderkey", dmy_to_utc(text, channels.LIMA).alias("instant")
    )


@query
def calendar_of_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("l_shipdate")
    return _line_text(spark, sf_dir).select(*LINE_ID, *calendar_parts(day))


@query
def rows_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events")
    rows = events.withColumn(
        "value", F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    ).withColumn("props", F.when(F.col("event_type") != "click", F.col("props")))
    return rows.select("event_id", row_json(rows).alias("payload"))


@query
def staging_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns forced into the staging types."""
    lines = sample.lineitem(spark, sf_dir)
    text = {f.name: F.lit(None).cast("string") for f in schemas.STAGING}
    text |= {
        "platform_order_id": F.col("l_orderkey").cast("string"),
        "platform_line_id": F.col("l_linenumber").cast("string"),
        "raw_id": sample.line_raw_id().cast("string"),
        "order_dt_utc": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        "quantity": F.when(F.col("l_returnflag") == "R", "many").otherwise(
            F.col("l_quantity").cast("int").cast("string")
        ),
        "unit_price_local": F.concat(F.col("l_extendedprice").cast("decimal(12,2)"), F.lit("125")),
        "line_total_local": F.when(F.col("l_linestatus") == "F", "1e9").otherwise(
            (F.col("l_extendedprice") * 1).cast("decimal(12,2)").cast("string")
        ),
        "currency": F.col("l_returnflag"),
    }
    rows = typed(lines.select(*[c.alias(n) for n, c in text.items()]))
    return rows.select(
        "platform_order_id",
        "platform_line_id",
        "raw_id",
        "order_dt_utc",
        F.col("quantity").cast("double").alias("quantity"),
        "unit_price_local",
        "line_total_local",
        "currency",
    )


# --- lookups ---------------------------------------------------------------------------


@query
def fx_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = sample.fx_rates(spark, sf_dir)
    rows = cleaned_lines(spark, sf_dir).withColumn(
        "currency",
        F.when(F.col("raw_status") == "P", "EUR").otherwise(F.col("currency")),
    )
    tables = Reference.of(fx, warehouse.status_seed(spark))
    return apply_fx(rows, tables.fx, tables.latest_fx).select(
        *schemas.NATURAL_KEY, "raw_id", "currency", "unit_price_usd", "line_total_usd"
    )


@query
def fx_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rates(sample.fx_rates(spark, sf_dir))


@query
def status_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders").withColumn(
        "source_platform", sample.channel_of(F.col("o_orderpriority"))
    )
    rows = orders.select(
        "o_orderkey",
        "source_platform",
        sample.raw_status(F.col("source_platform")).alias("raw_status"),
    )
    return map_status(rows, checked(warehouse.status_seed(spark)))


@query
def canonical_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned_lines(spark, sf_dir).select(*schemas.NATURAL_KEY, "raw_id", "platform_sku")
    return attach_canonical(rows, lookup(spark, sf_dir))


@query
def unmapped_sku_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned_lines(spark, sf_dir).select("source_platform", "platform_sku")
    counts = unmapped_skus(attach_canonical(rows, lookup(spark, sf_dir)))
    return counts.orderBy(F.desc("occurrences"), "source_platform", "platform_sku")


@query
def unmapped_sku_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned_lines(spark, sf_dir).select("source_platform", "platform_sku")
    return unmapped_totals(unmapped_skus(attach_canonical(rows, lookup(spark, sf_dir))))


@query
def sku_mapping_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned_lines(spark, sf_dir).select("source_platform", "platform_sku")
    return sku_coverage(attach_canonical(rows, lookup(spark, sf_dir)))


@query
def sku_mapping_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as SKUs: many parts share a name, in either case."""
    parts = sample.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("source_platform"),
        F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("platform_sku"),
        F.col("p_brand").alias("sku_canonical"),
    )
    return mapping_conflicts(parts)


# --- order-dependent operators -----------------------------------------------------------


def _lines_by_key(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    lines = _line_text(spark, sf_dir).select(
        *LINE_ID, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return dedupe_by_key(lines, ["l_orderkey", "l_linenumber"], ["raw_id"], keep)


@query
def dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_by_key(spark, sf_dir, "last")


@query
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_by_key(spark, sf_dir, "first")


@query
def drop_incomplete_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A newer row without quantity or time hides an older complete one."""
    lines = cleaned_lines(spark, sf_dir).withColumns(
        {
            "quantity": F.when(F.col("quantity") >= 0, F.col("quantity")),
            "order_dt_utc": F.when(F.col("raw_status") != "P", F.col("order_dt_utc")),
        }
    )
    newest = dedupe_by_key(lines, schemas.NATURAL_KEY, ["raw_id"])
    return drop_incomplete(newest, REQUIRED).select(
        *schemas.NATURAL_KEY, "raw_id", "quantity", "order_dt_utc"
    )


@query
def line_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = line_position(
        _line_text(spark, sf_dir).select(*LINE_ID),
        ["l_orderkey"],
        ["raw_id"],
        F.shiftright("raw_id", landing.SLICE_BITS),
    )
    line_id = F.concat("l_orderkey", F.lit("-"), "line_pos")
    return numbered.select(*LINE_ID, "line_pos", line_id.alias("platform_line_id"))


@query
def line_positions_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders split over two reports, the first of which lands a second time."""
    report = F.when(F.col("l_linestatus") == "F", 1).otherwise(2)
    lines = _line_text(spark, sf_dir).select(
        *LINE_ID,
        F.concat(F.lit("S"), F.col("l_partkey") % 3).alias("sku"),
        report.cast("bigint").alias("batch_id"),
        F.lit(None).cast("string").alias("source_file"),
    )
    again = lines.where("batch_id = 1").withColumns(
        {"batch_id": F.lit(3).cast("bigint"), "raw_id": F.col("raw_id") + (1 << 40)}
    )
    numbered = channels.numbered_lines(lines.unionByName(again), "l_orderkey")
    return numbered.select(*LINE_ID, "batch_id", "sku", "line_pos")


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all distinct lines: one each, all above the start."""
    start = 1_000
    key = ["l_orderkey", "l_linenumber"]
    rows = sample.lineitem(spark, sf_dir).select(*key).distinct()
    ids = surrogate_ids(rows, key, start, 16, "sale_id")
    return ids.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("sale_id").alias("id_count"),
        (F.min("sale_id") > start).alias("above_start"),
    )


# --- nested documents ----------------------------------------------------------------------


@query
def order_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.shopify_documents(spark, sf_dir)
    return channels.extract_shopify(raw).drop(*landing.INGEST_ORDER).withColumn(
        "element", F.col("element") + 1
    )


@query
def order_json_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = channels.extract_mercadolibre(sample.mercadolibre_documents(spark, sf_dir))
    summed = channels.MERCADOLIBRE.post_clean(lines.withColumn(channels.BEYOND, F.lit(None).cast("string")))
    return summed.drop(*landing.INGEST_ORDER, "element", "tax_local", channels.BEYOND)


@query
def json_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing key takes the default, an explicit null does not."""
    documents = sample.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct("o_orderkey")))
        .when(F.col("o_orderstatus") == "O", '{"currency":null}')
        .otherwise(F.to_json(F.struct(F.substring("o_orderpriority", 1, 1).alias("currency"))))
        .alias("payload"),
    )
    parsed = documents.withColumn("doc", F.from_json("payload", "currency variant"))
    return parsed.select(
        "o_orderkey",
        channels.unless_given("doc.currency", "USD", "string").alias("currency"),
        F.col("doc.currency").isNull().alias("missing"),
    )


# --- channels ------------------------------------------------------------------------------


def _normalized(spark: SparkSession, sf_dir: str, name: str, tables: Reference) -> DataFrame:
    return normalize(sample.RAW[name](spark, sf_dir), channels.CHANNELS[name], tables)


@query
def normalize_shopify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "shopify", reference(spark, sf_dir))


@query
def normalize_mercadolibre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "mercadolibre", reference(spark, sf_dir))


@query
def normalize_amazon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "amazon", reference(spark, sf_dir))


@query
def normalize_tiendanube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "tiendanube", reference(spark, sf_dir))


@query
def normalize_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "pos", reference(spark, sf_dir))


def all_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, lines = reference(spark, sf_dir), sample.dealt_lines(spark, sf_dir)
    return union_channels(
        normalize(sample.raw_of_channel(spark, sf_dir, name, lines), channels.CHANNELS[name], tables)
        for name in sample.RAW
    )


@query
def all_channels_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five channels together; every order belongs to the channel of its priority."""
    return all_channels(spark, sf_dir)


@query
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of the five channels as fact rows."""
    parts = products(spark, sf_dir)
    return facts(spark, sf_dir, all_channels(spark, sf_dir), parts)


@query
def extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cleaned_lines(spark, sf_dir).withColumn(
        "quantity", F.when(F.col("quantity") >= 0, F.col("quantity"))
    )
    return stage_counts(lines, schemas.NATURAL_KEY, F.col("raw_id"), REQUIRED)


# --- quality rules ---------------------------------------------------------------------------

AS_OF = datetime(2001, 6, 1)


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows of which many break a rule."""
    tax = F.col("l_tax")
    currency = (
        F.when(tax == 0.08, "EUR")
        .when(tax == 0.07, "usd")
        .when(tax == 0.06, F.lit(None).cast("string"))
        .when(tax == 0.05, "US")
        .when(tax == 0.04, " PEN ")
        .when(tax == 0.03, "SOLES")
        .otherwise("USD")
    )
    status = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Pagado")
        .when(F.col("l_returnflag") == "R", "refunded")
        .otherwise("paid")
    )
    price = F.col("c_acctbal").cast(schemas.AMOUNT)
    return sample.order_lines(spark, sf_dir).select(
        sample.channel_of(F.col("o_orderpriority")).alias("source_platform"),
        F.col("l_orderkey").cast("string").alias("platform_order_id"),
        F.col("l_linenumber").cast("string").alias("platform_line_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_dt_utc"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity").cast("int"))
        .otherwise(0)
        .alias("quantity"),
        price.alias("unit_price_local"),
        F.lit(None).cast(schemas.AMOUNT).alias("discount_local"),
        F.lit(None).cast(schemas.AMOUNT).alias("tax_local"),
        price.alias("line_total_local"),
        currency.alias("currency"),
        F.abs(price).alias("unit_price_usd"),
        price.alias("line_total_usd"),
        status.alias("order_status"),
        sample.line_raw_id().alias("raw_id"),
    )


def judged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_reason(faulty_lines(spark, sf_dir), F.lit(AS_OF))


@query
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(judged_lines(spark, sf_dir))


@query
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_rows(judged_lines(spark, sf_dir))


@query
def valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_rows(judged_lines(spark, sf_dir)).select(
        *schemas.NATURAL_KEY, "raw_id", "currency", "unit_price_local", "quantity"
    )


@query
def validation_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules over rows whose numbers are still text."""
    rows = faulty_lines(spark, sf_dir).withColumns(
        {
            "quantity": F.when(F.col("order_status") == "refunded", "two").otherwise(
                F.concat(F.lit(" "), F.col("quantity").cast("string"))
            ),
            "discount_local": F.when(F.col("currency") == "usd", "NaN"),
            "tax_local": F.when(F.col("currency") == " PEN ", "12%"),
        }
    )
    return (
        quality.with_reason(rows, F.lit(AS_OF))
        .groupBy(F.coalesce("reason", F.lit("valid")).alias("reason"))
        .agg(F.count("*").alias("row_count"))
    )


@query
def refused_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines with amounts and quantities that staging cannot hold, by order and reason."""
    place = F.col("merchant_order_id").substr(4, 20).cast("bigint") % 5
    raw = sample.raw_amazon(spark, sf_dir).withColumns(
        {
            "item_price": F.when(place == 0, "7" * 19).when(place == 1, "123456789.00").otherwise(F.col("item_price")),
            "item_tax": F.when(place == 2, "-" + "8" * 25 + ".5").otherwise(F.col("item_tax")),
            "quantity_purchased": F.when(place == 3, "900000000000000").otherwise(F.col("quantity_purchased")),
        }
    )
    lines = judged(raw, channels.AMAZON, reference(spark, sf_dir)).where("refusal IS NOT NULL")
    return lines.groupBy("platform_order_id", "refusal").agg(F.count("*").alias("row_count"))


# --- upserts -----------------------------------------------------------------------------------

FACT_VALUES = ["platform_sku", "quantity", "unit_price_local", "line_total_local", "order_status"]


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Finished lines first, open lines second; many keys are in both."""
    lines = sample.lineitem(spark, sf_dir)
    orders = sample.table(spark, sf_dir, "orders").withColumn(
        "source_platform", sample.channel_of(F.col("o_orderpriority"))
    )
    channel = F.col("source_platform")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "source_platform",
        F.col("l_orderkey").cast("string").alias("platform_order_id"),
        F.col("l_linenumber").cast("string").alias("platform_line_id"),
        F.when(F.col("l_returnflag") != "A", clean_sku(sample.dressed_sku(channel))).alias(
            "platform_sku"
        ),
        sample.signed_quantity().alias("quantity"),
        sample.price().cast(schemas.AMOUNT).alias("unit_price_local"),
        (sample.price() * sample.signed_quantity()).cast(schemas.AMOUNT).alias("line_total_local"),
        F.col("l_returnflag").alias("order_status"),
        sample.line_raw_id().alias("raw_id"),
        "l_linestatus",
    )

    def load(status: str) -> DataFrame:
        newest = dedupe_by_key(
            rows.where(F.col("l_linestatus") == status), schemas.NATURAL_KEY, ["raw_id"]
        )
        return newest.select(*schemas.NATURAL_KEY, *FACT_VALUES)

    return load("F"), load("O")


@query
def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _two_loads(spark, sf_dir)
    return merge_rows(first, second, schemas.NATURAL_KEY)


@query
def fact_upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads into a table stored by key bucket, the second one twice."""
    first, second = _two_loads(spark, sf_dir)
    path = scratch_dir(spark, "fact")
    for load in (first, second, second):
        upsert_table(spark, path, first.schema, load, schemas.NATURAL_KEY, buckets=8)
    return read_table(spark, path, first.schema)


@query
def reference_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by SKU: known ones get the new price, new ones are added."""
    parts = sample.table(spark, sf_dir, "part").select(
        F.concat(F.lit("C"), F.col("p_partkey")).alias("sku_canonical"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("base_price_usd"),
        "p_size",
    )
    known = parts.where("p_size <= 30").drop("p_size")
    incoming = (
        parts.where("p_size >= 20")
        .drop("p_size")
        .withColumn("base_price_usd", F.col("base_price_usd") + 1)
        .withColumn("product_name", F.upper("product_name"))
    )
    return merge_rows(known, incoming, ["sku_canonical"])


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days stay, ship days are added where absent."""
    orders = sample.table(spark, sf_dir, "orders")
    lines = sample.lineitem(spark, sf_dir)
    known = orders.select(F.to_date("o_orderdate").alias("date_id")).distinct()
    known = known.withColumn("origin", F.lit("order"))
    shipped = lines.select(F.to_date("l_shipdate").alias("date_id")).distinct()
    shipped = shipped.withColumn("origin", F.lit("shipping"))
    return known.unionByName(insert_absent(known, shipped, ["date_id"]))


BATCH_CUT = datetime(2024, 1, 15)


@query
def checkpoint_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches per source: the watermark moves on, the row counts add up."""
    events = sample.table(spark, sf_dir, "events")

    def batch(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("event_type").alias("source_name")).agg(
            F.max("ts").alias("last_watermark"), F.count("*").alias("rows_ingested")
        )

    cut = F.lit(BATCH_CUT).cast("timestamp_ntz")
    return merge_rows(
        batch(events.where(F.col("ts") < cut)),
        batch(events.where(F.col("ts") >= cut)),
        ["source_name"],
        accumulate=["rows_ingested"],
    )


@query
def unmapped_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmapped SKUs of finished lines, then of open ones; counts add up, first seen stays."""
    sku = F.concat(F.when(F.col("l_returnflag") == "R", "pos ").otherwise("POS "), F.col("l_partkey"))
    lines = sample.lineitem(spark, sf_dir).select(
        F.lit("pos").alias("source_platform"), sku.alias("platform_sku"), "l_linestatus"
    )
    enriched = attach_canonical(lines, lookup(spark, sf_dir))

    def batch(status: str) -> DataFrame:
        return unmapped_skus(enriched.where(F.col("l_linestatus") == status)).withColumn(
            "first_seen", F.lit(status)
        )

    return merge_rows(
        batch("F"),
        batch("O"),
        ["source_platform", "platform_sku"],
        keep=["first_seen"],
        accumulate=["occurrences"],
    )


# --- dimensions ----------------------------------------------------------------------------------


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders")
    return warehouse.dim_date_for(orders, F.to_date("o_orderdate"))


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.dim_product(spark, sf_dir)


@query
def catalog_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping(spark, sf_dir)


@query
def outside_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped on days that the calendar of the orders lacks."""
    lines = _line_text(spark, sf_dir).select(*LINE_ID, F.to_date("l_shipdate").alias("date_id"))
    orders = sample.table(spark, sf_dir, "orders")
    known = orders.select(F.to_date("o_orderdate").alias("date_id")).distinct()
    return warehouse.outside_calendar(lines, checked(known))


# --- incremental -----------------------------------------------------------------------------------


@query
def high_watermark_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after 2024-01-15 in Lima, the watermark being an instant."""
    mark = F.lit("2024-01-15 05:00:00").cast("timestamp")
    events = sample.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return drops.newer_than(events, "ts", mark, channels.LIMA)


@query
def newest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drops.data_watermark(sample.table(spark, sf_dir, "events"), "ts", channels.LIMA)


def _event_waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = sample.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    first, second = datetime(2024, 1, 11), datetime(2024, 1, 21)
    return [
        events.where(F.col("ts") < F.lit(first)),
        events.where((F.col("ts") >= F.lit(first)) & (F.col("ts") < F.lit(second))),
        events.where(F.col("ts") >= F.lit(second)),
    ]


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three waves of files, a run after each: every event is landed once."""
    base = scratch_dir(spark, "ingest")
    waves = _event_waves(spark, sf_dir)
    schema = waves[0].schema
    for wave in waves:
        wave.write.mode("append").parquet(f"{base}/drop")
        stream = file_stream(spark, f"{base}/drop", schema)
        append_new_files(stream.drop("source_file"), f"{base}/raw", f"{base}/progress").awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/raw")


@query
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same waves upserted by user: the newest event of every user."""
    base = scratch_dir(spark, "upsert")
    waves = _event_waves(spark, sf_dir)
    schema = waves[0].schema
    for wave in waves:
        wave.write.mode("append").parquet(f"{base}/drop")
        upsert_new_files(
            file_stream(spark, f"{base}/drop", schema),
            f"{base}/table",
            schema,
            ["user_id"],
            ["ts", "event_id"],
            f"{base}/progress",
        ).awaitTermination()
    return read_table(spark, f"{base}/table", schema)


# --- file sources ------------------------------------------------------------------------------------


def write_wrapped_json(documents: DataFrame, path: str, wrapper: str, mode: str = "error") -> None:
    """Write documents as files of one object each, the documents in one array."""

    def wrap(batches):
        import pandas as pd

        yield pd.DataFrame({"value": ['{"' + wrapper + '":[']})
        separator = ""
        for batch in batches:
            lines = batch["payload"].tolist()
            if lines:
                yield pd.DataFrame(
                    {"value": [separator + lines[0], *("," + line for line in lines[1:])]}
                )
                separator = ","
        yield pd.DataFrame({"value": ["]}"]})

    documents.select("payload").mapInPandas(wrap, "value string").write.mode(mode).text(path)


def write_tsv(rows: DataFrame, path: str, headers: dict[str, str], mode: str = "error") -> None:
    report = rows.select(*[F.col(new).alias(old) for old, new in headers.items()])
    (
        report.write.mode(mode)
        .option("sep", "\t")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@query
def tsv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'tsv')}/drop"
    write_tsv(sample.raw_amazon(spark, sf_dir), path, drops.AMAZON_HEADERS)
    return drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS).drop(*drops.POSITION.names)


@query
def workbook_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines packed into workbooks inside the tasks, and decoded again."""
    files = sample.workbook_files(sample.raw_tiendanube(spark, sf_dir), drops.TIENDANUBE_HEADERS)
    rows = decode_workbooks(files, "Ventas", drops.TIENDANUBE_HEADERS)
    return rows.drop(*drops.POSITION.names, "email", "cliente")


@query
def workbook_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as workbook files and read again, all columns."""
    path = f"{scratch_dir(spark, 'workbooks')}/drop"
    sample.write_workbooks(sample.raw_tiendanube(spark, sf_dir), drops.TIENDANUBE_HEADERS, path)
    return workbook(spark, path).drop(*drops.POSITION.names)


@query
def wrapped_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'json')}/drop"
    write_wrapped_json(sample.mercadolibre_documents(spark, sf_dir), path, "results")
    rows = drops.wrapped_json(spark, path, "results")
    return rows.select(
        "order_id",
        F.get_json_object("payload", "$.date_created").alias("date_created"),
        F.get_json_object("payload", "$.status").alias("status"),
        F.get_json_object("payload", "$.buyer.email").alias("email"),
        F.get_json_object("payload", "$.order_items[0].item.seller_sku").alias("first_sku"),
    )


@query
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till rows landed in two batches: ids are unique and grow with the batch."""
    path = scratch_dir(spark, "raw")
    rows = stored(sample.raw_pos(spark, sf_dir).select(*schemas.POS_VENTAS.names), "till")
    order = list(channels.POS.land_order)
    landing.land(spark, rows, path, schemas.POS_VENTAS, 1, order)
    landing.land(spark, rows.where("cantidad < 0"), path, schemas.POS_VENTAS, 2, order)
    landed = landing.read_raw(spark, path, schemas.POS_VENTAS)
    return landed.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("raw_id").alias("id_count"),
        (F.max(F.when(F.col("batch_id") == 1, F.col("raw_id")))
         < F.min(F.when(F.col("batch_id") == 2, F.col("raw_id")))).alias("ids_grow"),
        F.count_if(F.col("batch_id") == 2).alias("second_batch"),
        F.sum("total_linea").alias("total"),
    )


@query
def raw_ids_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till sales landed in two batches, the second of returns: ids without a gap, by time and number."""
    path = scratch_dir(spark, "raw-ids")
    till = dedupe_by_key(sample.raw_pos(spark, sf_dir), ["venta_id"], ["raw_id"])
    rows = stored(till.select(*schemas.POS_VENTAS.names), "till")
    order, key = list(channels.POS.land_order), channels.POS.order_key()
    landing.land(spark, rows, path, schemas.POS_VENTAS, 1, order, key)
    landing.land(spark, rows.where("cantidad < 0"), path, schemas.POS_VENTAS, 2, order, key)
    return landing.read_raw(spark, path, schemas.POS_VENTAS).select("venta_id", "batch_id", "raw_id")


def _sample_channels() -> dict[str, channels.Channel]:
    """The registry, the workbook channel reading its sheet exported as text."""
    as_text = replace(
        channels.TIENDANUBE,
        read=lambda spark, path: drops.verbatim_tsv(spark, path, drops.TIENDANUBE_HEADERS),
    )
    return {**channels.CHANNELS, "tiendanube": as_text}


def _write_drops(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    lines: DataFrame,
    orders: Column | None = None,
    till: Column | None = None,
) -> dict[str, str]:
    """Drops of all channels: of the orders that ``orders`` picks by ``_order``, and of the till as it stands.

    ``lines`` are the stored lines; they are sorted before their texts are made.
    """
    sources = {name: f"{folder}/{name}" for name in sample.RAW}
    raw = {}
    for name in ("shopify", "mercadolibre", "amazon", "tiendanube"):
        rows = sample.raw_of_channel(spark, sf_dir, name, lines.orderBy(sample.line_raw_id()))
        order = F.col("order_id") if "order_id" in rows.columns else channels.CHANNELS[name].order_key()
        rows = rows.withColumn("_order", order.cast("bigint"))
        raw[name] = (rows if orders is None else rows.where(orders)).drop("_order")
    raw["mercadolibre"] = raw["mercadolibre"].orderBy("raw_id")
    write_wrapped_json(raw["shopify"], sources["shopify"], "orders")
    write_wrapped_json(raw["mercadolibre"], sources["mercadolibre"], "results")
    write_tsv(raw["amazon"], sources["amazon"], drops.AMAZON_HEADERS)
    write_tsv(raw["tiendanube"], sources["tiendanube"], drops.TIENDANUBE_HEADERS)
    sales = dedupe_by_key(sample.raw_of_channel(spark, sf_dir, "pos", lines), ["venta_id"], ["raw_id"])
    sales = sales if till is None else sales.where(till)
    sales.select(*schemas.POS_VENTAS.names).write.parquet(sources["pos"])
    return sources


def _seeded_store(spark: SparkSession, sf_dir: str, root: str) -> daily.Store:
    store = daily.Store(spark, root, channels=_sample_channels())
    daily.seed_reference(
        store,
        sample.fx_rates(spark, sf_dir),
        sample.products(spark, sf_dir),
        mapping(spark, sf_dir),
    )
    return store


RUN_AT = datetime(2002, 1, 1)


def daily_store(spark: SparkSession, sf_dir: str) -> daily.Store:
    """Drops of all channels written, reference tables seeded, the daily job run."""
    base = scratch_dir(spark, "daily")
    sources = _write_drops(spark, sf_dir, f"{base}/drops", sample.dealt_lines(spark, sf_dir))
    store = _seeded_store(spark, sf_dir, f"{base}/warehouse")
    daily.run(store, sources, as_of=RUN_AT)
    return store


def two_day_store(spark: SparkSession, sf_dir: str) -> daily.Store:
    """The same in two runs: half of the orders, then the others and half of the first ones again.

    A quarter of the orders is in the first batch alone. The till is the table as
    it stands on the day, so the second run reads its newer sales only.
    """
    base = scratch_dir(spark, "two-days")
    store = _seeded_store(spark, sf_dir, f"{base}/warehouse")
    early = F.col("fecha_venta") < F.lit(datetime(1995, 6, 1))
    days = [(F.col("_order") % 2 == 1, early), (F.col("_order") % 4 != 1, None)]
    lines = sample.dealt_lines(spark, sf_dir)
    for day, (orders, till) in enumerate(days):
        sources = _write_drops(spark, sf_dir, f"{base}/day{day}", lines, orders, till)
        daily.run(store, sources, as_of=RUN_AT)
    return store


@query
def daily_job_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops to monthly revenue through every stored layer."""
    daily.create_views(daily_store(spark, sf_dir))
    return spark.table("v_revenue_monthly")


@query
def daily_job_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact after two daily runs, the second one of the affected orders alone."""
    store = two_day_store(spark, sf_dir)
    return store.read("core/fact_sales").select(
        *schemas.NATURAL_KEY, "platform_id", "product_id", "date_id", "platform_sku", "sku_canonical",
        "quantity", "unit_price_local", "line_total_local", "currency", "unit_price_usd",
        "line_total_usd", "order_status",
    ).withColumn("product_id", F.col("product_id").isNotNull().cast("int"))


@query
def fact_upsert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of two loads: known keys keep theirs, new ones go on without a gap."""
    key = schemas.NATURAL_KEY
    path = scratch_dir(spark, "fact-ids")
    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in key], T.StructField("sale_id", T.LongType())])
    for load in _two_loads(spark, sf_dir):
        rows = daily.with_ids(read_table(spark, path, schema), load.select(*key), key, "sale_id", 16)
        upsert_table(spark, path, schema, rows, key, buckets=8, keep=["sale_id"])
    return read_table(spark, path, schema)


@query
def reject_sink_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of half of the raw rows, then of all: each once, with the runs that met it first and last."""
    store = daily.Store(spark, scratch_dir(spark, "rejects"))
    lines = quality.with_reason(faulty_lines(spark, sf_dir), F.lit(AS_OF))
    rejects = quality.rejected_rows(lines)
    daily.write_rejects(store, rejects.where("raw_id % 2 = 0"), 1)
    daily.write_rejects(store, rejects, 2)
    return store.read("ops/rejected_rows").select(*schemas.REJECT_KEY, "first_run_id", "last_run_id")


@query
def coverage_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmapped SKUs of all staged lines, reported twice: counts add up, a pair is one row."""
    store = daily.Store(spark, scratch_dir(spark, "coverage"))
    store.upsert("reference/sku_mapping", mapping(spark, sf_dir), ["source_platform", "platform_sku"])
    lines = staged_lines(spark, sf_dir).withColumns(
        {"applied_rate": F.lit(None).cast(schemas.RATE), "refusal": F.lit(None).cast("string")}
    )
    store.upsert("staging/sales", lines, schemas.NATURAL_KEY, buckets=store.buckets)
    found = [daily.report_unmapped(store) for _ in range(2)]
    rows = store.read("ops/unmapped_skus").select("source_name", "platform_sku", "occurrences", "resolved")
    return rows.withColumns({name: F.lit(value) for name, value in found[-1].items()})


@query
def run_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a run over the till and of one whose drop is broken."""
    base = scratch_dir(spark, "audit")
    store = _seeded_store(spark, sf_dir, f"{base}/warehouse")
    sales = dedupe_by_key(sample.raw_pos(spark, sf_dir, "pos"), ["venta_id"], ["raw_id"])
    sales.select(*schemas.POS_VENTAS.names).write.parquet(f"{base}/till")
    sample.table(spark, sf_dir, "region").select("r_name").coalesce(1).write.text(f"{base}/broken")
    daily.run(store, {"pos": f"{base}/till"}, as_of=RUN_AT)
    try:
        daily.run(store, {"shopify": f"{base}/broken"}, as_of=RUN_AT)
    except Exception:  # noqa: BLE001, S110: the audit row is what is looked at
        pass
    summary = F.col("sources_summary")
    return store.read("ops/pipeline_runs").select(
        "run_id",
        "status",
        F.get_json_object(summary, "$.extract.pos").cast("bigint").alias("till_rows"),
        F.get_json_object(summary, "$.load.fact_sales_rows_upserted").cast("bigint").alias("facts"),
        F.col("error_message").isNotNull().alias("has_error"),
        (F.col("finished_at") >= F.col("started_at")).alias("finished"),
    )


@query
def late_rows_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waves of events of which only rows after a watermark are landed."""
    base = scratch_dir(spark, "late")
    waves = _event_waves(spark, sf_dir)
    schema = waves[0].schema
    mark = F.lit(datetime(2024, 1, 16, 12)).cast("timestamp_ntz")
    for wave in waves:
        wave.write.mode("append").parquet(f"{base}/drop")
        stream = after_watermark(file_stream(spark, f"{base}/drop", schema), "ts", mark)
        append_new_files(stream.drop("source_file"), f"{base}/raw", f"{base}/progress").awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/raw")


@query
def empty_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without rows changes nothing in a stored table."""
    first, _ = _two_loads(spark, sf_dir)
    path = scratch_dir(spark, "empty-load")
    for load in (first, first.where("false")):
        upsert_table(spark, path, first.schema, load, schemas.NATURAL_KEY, buckets=8)
    return read_table(spark, path, first.schema)


@query
def long_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons that quote a status of hundreds of characters are cut at 500."""
    lines = faulty_lines(spark, sf_dir).withColumns(
        {
            "quantity": F.lit(1),
            "currency": F.lit("USD"),
            "unit_price_local": F.lit(1).cast(schemas.AMOUNT),
            "unit_price_usd": F.lit(1).cast(schemas.AMOUNT),
            "order_dt_utc": F.lit(datetime(2000, 1, 1)).cast("timestamp"),
            "order_status": F.repeat(F.lit("no status "), F.col("platform_line_id").cast("int") + 42),
        }
    )
    return quality.with_reason(lines, F.lit(AS_OF)).select(
        *schemas.NATURAL_KEY, "raw_id", "reason", F.length("reason").alias("size")
    )


@query
def file_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in two files that come one after the other, with runs between: each file is landed once."""
    base = scratch_dir(spark, "progress")
    store, channel = daily.Store(spark, f"{base}/warehouse"), channels.MERCADOLIBRE
    documents = sample.mercadolibre_documents(spark, sf_dir)
    started = datetime(2024, 1, 1)

    def ingest(run: int) -> None:
        daily.ingest_new_files(store, channel, f"{base}/drop", run, started)

    ingest(1)
    write_wrapped_json(documents.where("order_id % 2 = 1"), f"{base}/drop", "results")
    ingest(2)
    ingest(3)
    write_wrapped_json(documents.where("order_id % 2 = 0"), f"{base}/drop", "results", "append")
    ingest(4)
    daily.ingest_new_files(store, channel, f"{base}/no-drop", 5, started)
    landed = store.raw(channel).groupBy("batch_id", "order_id").agg(F.count("*").alias("times"))
    mark = store.read("ops/etl_checkpoints").first()
    return landed.withColumn("ingested", F.lit(mark.rows_ingested))


@query
def wrapped_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in one file, cut at the ends of its elements; the text of each whole."""
    path = f"{scratch_dir(spark, 'json-split')}/drop"
    documents = sample.mercadolibre_documents(spark, sf_dir).coalesce(1)
    write_wrapped_json(documents, path, "results")
    rows = split_json.elements(spark, path, "results")
    return rows.select(F.get_json_object("payload", "$.id").cast("bigint").alias("order_id"), "payload")


@query
def tsv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in two layouts: the columns in order, and reversed with one more in front."""
    path = f"{scratch_dir(spark, 'tsv-layouts')}/drop"
    rows = sample.raw_amazon(spark, sf_dir)
    odd = F.col("amazon_order_id").cast("bigint") % 2 == 1
    write_tsv(rows.where(odd), path, drops.AMAZON_HEADERS)
    turned = {"note": "note", **dict(reversed(drops.AMAZON_HEADERS.items()))}
    write_tsv(rows.where(~odd).withColumn("note", F.lit("n")), path, turned, "append")
    return drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS).drop(*drops.POSITION.names)


@query
def stage_counts_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the staging step, observed while its rows are written."""
    lines = cleaned_lines(spark, sf_dir).withColumn(
        "quantity", F.when(F.col("quantity") >= 0, F.col("quantity"))
    )
    rows, counts = observed_stages(lines, schemas.NATURAL_KEY, ["raw_id"], REQUIRED)
    rows.write.format("noop").mode("overwrite").save()
    found = counts()
    schema = schemas.struct(", ".join(f"{name} bigint" for name in found))
    return literal_table(spark, [tuple(found.values())], schema)
