"""The driver's order tables seen as channel drops.

Every order line becomes a sales line. The order priority names the channel, the
order status the raw status, the part the product; texts are dressed the way the
channels send them (currency signs, thousands separators, stray white space).
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources.landing import LANDING
from ..storage import stored

# Channel by order priority, and how the channel words a paid and a pending order.
PRIORITY_CHANNEL = {
    "1-URGENT": "shopify",
    "2-HIGH": "mercadolibre",
    "3-MEDIUM": "amazon",
    "4-NOT SPECIFIED": "tiendanube",
    "5-LOW": "pos",
}
PAID = {
    "shopify": "paid",
    "mercadolibre": "paid",
    "amazon": "Shipped",
    "tiendanube": "Pagado",
    "pos": "EFECTIVO",
}
PENDING = {
    "shopify": "pending",
    "mercadolibre": "pending",
    "amazon": "Pending",
    "tiendanube": "Pendiente de pago",
    "pos": "FIADO",
}
SKU_PREFIX = {
    "shopify": "SHP",
    "mercadolibre": "MLA",
    "amazon": "B0",
    "tiendanube": "tn",
    "pos": "POS",
}
USD_CHANNELS = ["shopify", "amazon"]
UNMAPPED_BRAND = "Brand#25"
LAST_PEN_RATE = "2000-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def by_channel(channel: Column, values: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for name, value in values.items():
        chosen = F.when(channel == name, F.lit(value)).otherwise(chosen)
    return chosen


def channel_of(priority: Column) -> Column:
    return by_channel(priority, PRIORITY_CHANNEL)


def currency_of(channel: Column) -> Column:
    return F.when(channel.isin(USD_CHANNELS), "USD").otherwise("PEN")


def raw_status(channel: Column) -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", by_channel(channel, PAID))
        .when(F.col("o_orderstatus") == "O", by_channel(channel, PENDING))
        .otherwise(F.col("o_orderstatus"))
    )


def line_raw_id() -> Column:
    """Ingest order of a line: its ship day, then a mix of its other columns."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    mix = F.col("l_partkey") * 1000003 + F.col("l_suppkey") * 10007 + cents
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("bigint")
    return day * 1048576 + F.pmod(mix, F.lit(1048576))


def dressed_sku(channel: Column) -> Column:
    """The channel's SKU of a part, dressed by line number."""
    prefix, part = by_channel(channel, SKU_PREFIX), F.col("l_partkey").cast("string")
    style = F.pmod("l_linenumber", F.lit(4))
    plain = F.concat(prefix, F.lit(" "), part)
    return (
        F.when(style == 0, plain)
        .when(style == 1, F.concat(F.lit("  "), F.lower(plain), F.lit(" ")))
        .when(style == 2, F.concat(prefix, F.lit(" \t "), part, F.lit("\t")))
        .otherwise(F.concat(F.lit("\u00a0"), F.upper(plain), F.lit("\u00a0")))
    )


def money_text(amount: Column, sign: str = "") -> Column:
    return F.concat(F.lit(sign), F.format_number(amount.cast("decimal(14,2)"), 2))


def signed_quantity() -> Column:
    """Returned lines count negative."""
    quantity = F.col("l_quantity").cast("int")
    return F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity)


def price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def line_wall_time() -> Column:
    """Wall time of a line: the order's day, three hours per line number, half past."""
    return F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("T"),
        F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0"),
        F.lit(":30:00"),
    )


def email() -> Column:
    return F.concat(F.lower("c_name"), F.lit("@example.com"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order and customer; the lines, of which there are most, are moved once."""
    lines = lineitem(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    bought = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return lines.join(bought, lines.l_orderkey == orders.o_orderkey)


# What the builders of raw lines read, and the column that the stored lines are parted by.
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name",
]
DEALT = "_channel"


def dealt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`order_lines` of the channels that are made of lines, joined and stored once, parted by channel.

    For those who build several channels: each reads its own lines, and not all of them.
    """
    lines = order_lines(spark, sf_dir).withColumn(DEALT, channel_of(F.col("o_orderpriority")))
    made_of_lines = [name for name in RAW if name != "mercadolibre"]
    return stored(lines.where(F.col(DEALT).isin(made_of_lines)).select(*LINE_COLUMNS, DEALT), "lines", [DEALT])


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all channels in the extraction contract, texts still dressed."""
    lines = lineitem(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").withColumn(
        "source_platform", channel_of(F.col("o_orderpriority"))
    )
    channel = F.col("source_platform")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "source_platform",
        F.col("l_orderkey").cast("string").alias("platform_order_id"),
        F.col("l_linenumber").cast("string").alias("platform_line_id"),
        F.concat(line_wall_time(), F.lit("-05:00")).alias("order_dt_raw"),
        dressed_sku(channel).alias("platform_sku"),
        signed_quantity().cast("string").alias("quantity"),
        money_text(price(), "$").alias("unit_price_local"),
        money_text(price() * F.col("l_discount").cast("decimal(4,2)"), "$").alias("discount_local"),
        money_text(price() * signed_quantity(), "$").alias("line_total_local"),
        currency_of(channel).alias("currency"),
        raw_status(channel).alias("raw_status"),
        line_raw_id().alias("raw_id"),
    )


# --- reference tables ------------------------------------------------------------


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """USD at 1 on every order day; PEN on weekdays up to a last day."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("rate_date")).distinct()
    usd = days.select(
        F.lit("USD").alias("currency"), "rate_date", F.lit(1).cast(schemas.RATE).alias("rate_to_usd")
    )
    step = F.pmod(F.dayofyear("rate_date"), F.lit(50)).cast("decimal(12,6)")
    pen = days.where(
        (F.weekday("rate_date") < 5) & (F.col("rate_date") <= F.lit(LAST_PEN_RATE).cast("date"))
    ).select(
        F.lit("PEN").alias("currency"),
        "rate_date",
        (F.lit("0.25").cast("decimal(12,6)") + step / 1000).cast(schemas.RATE).alias("rate_to_usd"),
    )
    return usd.unionByName(pen)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a catalog with one SKU column per channel; one brand is left out."""
    parts = table(spark, sf_dir, "part").where(F.col("p_brand") != UNMAPPED_BRAND)
    return parts.select(
        F.concat(F.lit("C"), F.col("p_partkey")).alias("sku_canonical"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("base_price_usd"),
        *[
            F.concat(F.lit(f"{prefix} "), F.col("p_partkey")).alias(f"sku_{name}")
            for name, prefix in SKU_PREFIX.items()
        ],
    )


SKU_COLUMNS = {name: f"sku_{name}" for name in SKU_PREFIX}


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).select(*schemas.PRODUCTS.names)


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension, numbered by part."""
    return products(spark, sf_dir).withColumn(
        "product_id", F.substring("sku_canonical", 2, 20).cast("int") + 1
    )


# --- raw rows of one channel -----------------------------------------------------


def _landed(rows: DataFrame, columns: list[str], raw_id: Column) -> DataFrame:
    """Add the landing columns, as one batch."""
    landing = {
        "raw_id": raw_id,
        "batch_id": F.lit(1).cast("bigint"),
        "source_file": F.lit(None).cast("string"),
        "ingested_at": F.current_timestamp(),
    }
    assert list(landing) == LANDING.names
    return rows.withColumns(landing).select(*columns, *LANDING.names)


def _only(lines: DataFrame, channel: str | None) -> DataFrame:
    if channel is None:
        return lines
    own = F.col(DEALT) if DEALT in lines.columns else channel_of(F.col("o_orderpriority"))
    return lines.where(own == channel)


def _lines(spark: SparkSession, sf_dir: str, channel: str | None, lines: DataFrame | None) -> DataFrame:
    """The lines of a channel, of ``lines`` if they are given."""
    return _only(order_lines(spark, sf_dir) if lines is None else lines, channel)


def raw_amazon(
    spark: SparkSession, sf_dir: str, channel: str | None = None, lines: DataFrame | None = None
) -> DataFrame:
    """Report lines, all text; ``channel`` takes that channel's orders only."""
    mine = F.lit("amazon")
    moment = F.concat(line_wall_time(), F.lit("-05:00"))
    columns = {
        "amazon_order_id": F.col("l_orderkey").cast("string"),
        "merchant_order_id": F.concat(F.lit("MRC"), F.col("l_orderkey")),
        "purchase_date": moment,
        "last_updated_date": moment,
        "order_status": raw_status(mine),
        "sku": dressed_sku(mine),
        "product_name": F.concat(F.lit("Part "), F.col("l_partkey")),
        "quantity_purchased": signed_quantity().cast("string"),
        "currency": F.when(F.col("l_linestatus") == "F", "USD"),
        "item_price": money_text(price()),
        "item_tax": money_text(price() * F.col("l_tax").cast("decimal(4,2)")),
        "shipping_price": F.lit("0.00"),
        "buyer_email": email(),
        "ship_city": F.lit(None).cast("string"),
        "ship_state": F.lit(None).cast("string"),
    }
    rows = _lines(spark, sf_dir, channel, lines).withColumns(columns)
    return _landed(rows, schemas.AMAZON_SHIPMENTS.names, line_raw_id())


def raw_tiendanube(
    spark: SparkSession, sf_dir: str, channel: str | None = None, lines: DataFrame | None = None
) -> DataFrame:
    mine = F.lit("tiendanube")
    columns = {
        "n_orden": F.col("l_orderkey").cast("string"),
        "fecha": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "estado_pago": raw_status(mine),
        "estado_envio": F.lit("Enviado"),
        "cliente": F.col("c_name"),
        "email": email(),
        "sku": dressed_sku(mine),
        "producto": F.concat(F.lit("Part "), F.col("l_partkey")),
        "cantidad": signed_quantity().cast("string"),
        "precio_unit": money_text(price(), "S/ "),
        "descuento": money_text(price() * F.col("l_discount").cast("decimal(4,2)")),
        "subtotal": money_text(price() * signed_quantity()),
        "moneda": F.when(F.col("l_linestatus") == "F", "PEN"),
    }
    rows = _lines(spark, sf_dir, channel, lines).withColumns(columns)
    return _landed(rows, schemas.TIENDANUBE_VENTAS.names, line_raw_id())


def raw_pos(
    spark: SparkSession, sf_dir: str, channel: str | None = None, lines: DataFrame | None = None
) -> DataFrame:
    """Till transactions: one per order and line number, the last state landed wins."""
    mine = F.lit("pos")
    columns = {
        "venta_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "fecha_venta": line_wall_time().cast("timestamp_ntz"),
        "tienda_id": F.col("l_suppkey").cast("int"),
        "cajero": F.lit(None).cast("string"),
        "sku": dressed_sku(mine),
        "producto": F.concat(F.lit("Part "), F.col("l_partkey")),
        "cantidad": signed_quantity(),
        "precio_unit": price(),
        "descuento": (price() * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)"),
        "total_linea": (price() * signed_quantity()).cast("decimal(12,2)"),
        "medio_pago": raw_status(mine),
        "cliente_doc": F.lit(None).cast("string"),
    }
    rows = _lines(spark, sf_dir, channel, lines).withColumns(columns)
    return _landed(rows, schemas.POS_VENTAS.names, line_raw_id())


def _json(document: Column, keep_nulls: bool = True) -> Column:
    return F.to_json(document, {"ignoreNullFields": str(not keep_nulls).lower()})


def shopify_documents(
    spark: SparkSession, sf_dir: str, channel: str | None = None, lines: DataFrame | None = None
) -> DataFrame:
    """One order snapshot per line: the line, and a gift line on unreturned ones.

    Finished lines leave out the currency key, others give it; orders in state P
    give it as an explicit null.
    """
    gift = F.struct(
        (F.col("l_linenumber") + 100).alias("id"),
        F.lit("GIFT").alias("sku"),
        F.lit("Gift").alias("title"),
        F.lit(1).alias("quantity"),
        F.lit("0.00").alias("price"),
        F.lit("0.00").alias("total_discount"),
        F.lit("0.00").alias("line_total"),
    )
    sold = F.struct(
        F.col("l_linenumber").alias("id"),
        dressed_sku(F.lit("shopify")).alias("sku"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("title"),
        signed_quantity().alias("quantity"),
        price().cast("string").alias("price"),
        (price() * F.col("l_discount").cast("decimal(4,2)")).cast("string").alias("total_discount"),
        (price() * signed_quantity()).cast("string").alias("line_total"),
    )
    items = F.when(F.col("l_returnflag") == "N", F.array(sold, gift)).otherwise(F.array(sold))
    base = [
        F.col("l_orderkey").alias("id"),
        F.concat(line_wall_time(), F.lit("-05:00")).alias("created_at"),
        raw_status(F.lit("shopify")).alias("financial_status"),
        F.struct(email().alias("email")).alias("customer"),
        items.alias("line_items"),
    ]
    currency = F.when(F.col("o_orderstatus") != "P", "USD").alias("currency")
    payload = F.when(F.col("l_linestatus") == "F", _json(F.struct(*base))).otherwise(
        _json(F.struct(*base, currency))
    )
    rows = _lines(spark, sf_dir, channel, lines).withColumns(
        {"order_id": F.col("l_orderkey"), "payload": payload}
    )
    return _landed(rows, schemas.JSON_ORDERS.names, line_raw_id())


def mercadolibre_documents(
    spark: SparkSession, sf_dir: str, channel: str | None = None
) -> DataFrame:
    """One document per order with one to four items; buyer null for orders in state P."""
    total = F.col("o_totalprice").cast("decimal(12,2)")

    def item(place: Column) -> Column:
        return F.struct(
            F.struct(
                F.concat(F.lit(" mla "), F.col("o_custkey") + place).alias("seller_sku"),
                F.concat(F.lit("Part "), F.col("o_custkey") + place).alias("title"),
            ).alias("item"),
            place.alias("quantity"),
            (total / 8).cast("decimal(12,2)").alias("unit_price"),
        )

    orders = table(spark, sf_dir, "orders").withColumn(
        "_places", F.sequence(F.lit(1), F.pmod("o_orderkey", F.lit(4)).cast("int") + 1)
    )
    document = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T21:15:00.000-05:00")).alias(
            "date_created"
        ),
        raw_status(F.lit("mercadolibre")).alias("status"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.struct(F.concat(F.lit("b"), F.col("o_custkey"), F.lit("@example.com")).alias("email")),
        ).alias("buyer"),
        F.transform("_places", item).alias("order_items"),
    )
    rows = _only(orders, channel).withColumns(
        {"order_id": F.col("o_orderkey"), "payload": _json(document)}
    )
    return _landed(rows, schemas.JSON_ORDERS.names, F.col("o_orderkey"))


def raw_of_channel(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame) -> DataFrame:
    """Raw rows of a channel's own orders, of :func:`dealt_lines` where it is made of lines."""
    given = {} if name == "mercadolibre" else {"lines": lines}
    return RAW[name](spark, sf_dir, name, **given)


RAW = {
    "shopify": shopify_documents,
    "mercadolibre": mercadolibre_documents,
    "amazon": raw_amazon,
    "tiendanube": raw_tiendanube,
    "pos": raw_pos,
}


# --- workbooks ---------------------------------------------------------------------

MAIN_XML = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE_XML = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_XML = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook_bytes(header: list[str], rows: list[tuple], sheet: str = "Ventas") -> bytes:
    """A small workbook of one sheet; numbers as number cells, texts inline."""

    def cell(value: object) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)):
            return f"<c><v>{value}</v></c>"
        text = escape(str(value))
        return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'

    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in [header, *rows])
    return _book(lines.encode(), sheet)


def _book(lines: bytes, sheet: str) -> bytes:
    """The workbook of one sheet with these rows."""
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN_XML}" xmlns:r="{OFFICE_XML}"><sheets>'
        f'<sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE_XML}">'
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN_XML}"><sheetData>'.encode()
        + lines
        + b"</sheetData></worksheet>",
    }
    content = io.BytesIO()
    # The quickest level: cells are mostly tags, which any level packs well.
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, xml in parts.items():
            book.writestr(name, xml)
    return content.getvalue()


def _text_columns(rows: DataFrame, headers: dict[str, str]) -> DataFrame:
    """The columns of a report as text, the quantity as a whole number."""
    return rows.select(
        *[F.col(n).cast("bigint" if n == "cantidad" else "string").alias(n) for n in headers.values()]
    )


def _packed(batch: pa.RecordBatch, headers: dict[str, str], sheet: str = "Ventas") -> bytes:
    """What ``workbook_bytes`` makes of the same rows, column by column."""

    def cells(column: pa.Array) -> pa.Array:
        text = column.cast(pa.large_string())
        if pa.types.is_integer(column.type):
            before, behind = "<c><v>", "</v></c>"
        else:
            before, behind = '<c t="inlineStr"><is><t xml:space="preserve">', "</t></is></c>"
            for sign, entity in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
                text = pc.replace_substring(text, sign, entity)
        return pc.fill_null(pc.binary_join_element_wise(*_large(before), text, *_large(behind, "")), "<c/>")

    rows = pc.binary_join_element_wise(*_large("<row>"), *map(cells, batch.columns), *_large("</row>", ""))
    first = "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(h)}</t></is></c>' for h in headers)
    # The texts of a column lie one after the other.
    ends, held = np.frombuffer(rows.buffers()[1], np.int64), rows.buffers()[2]
    lines = held[ends[0] : ends[len(rows)]].to_pybytes() if held is not None else b""
    return _book(f"<row>{first}</row>".encode() + lines, sheet)


def _large(*texts: str) -> list[pa.Scalar]:
    return [pa.scalar(text, pa.large_string()) for text in texts]


def workbook_files(rows: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rows packed into workbooks (``path``, ``content``), one per batch of a task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"path": [f"{uuid.uuid4().hex}.xlsx"], "content": [_packed(batch, headers)]})

    return _text_columns(rows, headers).mapInArrow(pack, "path string, content binary")


def write_workbooks(rows: DataFrame, headers: dict[str, str], path: str) -> None:
    """Rows written as workbook files below ``path``, one per batch of a task.

    A file is named by its task and batch, so a task that runs again writes its own files anew.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            name = f"{folder}/part-{task:05d}-{number:05d}.xlsx"
            with files.open_output_stream(name) as out:
                out.write(_packed(batch, headers))
            yield pa.RecordBatch.from_pydict({"file": [name]})

    _text_columns(rows, headers).mapInArrow(write, "file string").write.format("noop").mode("overwrite").save()
