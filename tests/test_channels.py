import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary import schemas
from tributary.literals import literal_table
from tributary.plans import channels
from tributary.plans.normalize import Reference, judged, malformed, normalize
from tributary.plans.warehouse import status_seed


@pytest.fixture
def reference(spark, table):
    fx = table(
        "currency string, rate_date string, rate string",
        [("USD", "2024-03-15", "1"), ("PEN", "2024-03-15", "0.25"), ("PEN", "2024-03-20", "0.30")],
    ).select(
        "currency",
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("rate").cast("decimal(12,6)").alias("rate_to_usd"),
    )
    return Reference.of(fx, status_seed(spark))


@pytest.fixture
def raw(spark):
    def make(channel, rows, batches=None):
        """Rows as tuples of the raw columns, in ingest order."""
        full = []
        for i, row in enumerate(rows, start=1):
            full.append((*row, i, batches[i - 1] if batches else 1, "f"))
        names = ", ".join(
            f"{f.name} " + ("string" if "decimal" in f.dataType.simpleString() else f.dataType.simpleString())
            for f in channel.raw_schema
        )
        text = schemas.struct(f"{names}, raw_id bigint, batch_id bigint, source_file string")
        df = literal_table(spark, full, text)
        return df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in channel.raw_schema],
            "raw_id", "batch_id", "source_file",
        )

    return make


def by_line(df):
    return {r.platform_line_id: r for r in df.collect()}


def dec(text):
    return Decimal(text).quantize(Decimal("0.0001"))


SHOPIFY_ORDER = {
    "id": 1000001,
    "created_at": "2024-03-15T10:30:00-05:00",
    "currency": "USD",
    "financial_status": "paid",
    "customer": {"email": "ana@example.com"},
    "line_items": [
        {"id": 101, "sku": " SHP  A ", "title": "Polo", "quantity": 2, "price": "1,019.90",
         "total_discount": "0.00", "line_total": "2039.80"},
        {"id": 102, "sku": None, "title": "Cap", "quantity": 1, "price": "5.00",
         "total_discount": None, "line_total": "5.00"},
    ],
}


def documents(*orders):
    return [(o.get("id"), json.dumps(o)) for o in orders]


def test_shopify(raw, reference):
    got = by_line(normalize(raw(channels.SHOPIFY, documents(SHOPIFY_ORDER)), channels.SHOPIFY, reference))
    assert set(got) == {"101", "102"}
    line = got["101"]
    assert (line.source_platform, line.platform_order_id, line.platform_sku) == ("shopify", "1000001", "SHP A")
    assert line.order_dt_utc == datetime(2024, 3, 15, 15, 30)
    assert (line.quantity, line.unit_price_local, line.line_total_usd) == (2, dec("1019.9"), dec("2039.8"))
    assert (line.order_status, line.customer_email, line.tax_local) == ("paid", "ana@example.com", None)
    assert got["102"].platform_sku is None and got["102"].discount_local is None


def test_shopify_missing_currency_is_defaulted_and_null_is_not(raw, reference):
    missing = {k: v for k, v in SHOPIFY_ORDER.items() if k != "currency"} | {"id": 1, "customer": None}
    null = {**SHOPIFY_ORDER, "id": 2, "currency": None}
    df = normalize(raw(channels.SHOPIFY, documents(missing, null)), channels.SHOPIFY, reference)
    got = {r.platform_order_id: r for r in df.where("platform_line_id = '101'").collect()}
    assert (got["1"].currency, got["1"].customer_email) == ("USD", None)
    assert (got["2"].currency, got["2"].unit_price_usd) == (None, None)


def test_newest_document_wins_and_repeated_lines_settle_by_place(raw, reference):
    newer = {**SHOPIFY_ORDER, "financial_status": "refunded"}
    line = SHOPIFY_ORDER["line_items"][0]
    twice = {**SHOPIFY_ORDER, "id": 5, "line_items": [line, {**line, "title": "Later"}]}
    df = normalize(raw(channels.SHOPIFY, documents(SHOPIFY_ORDER, newer, twice)), channels.SHOPIFY, reference)
    got = df.collect()
    assert len(got) == 3
    assert {r.order_status for r in got if r.platform_order_id == "1000001"} == {"refunded"}
    assert [r.product_name for r in got if r.platform_order_id == "5"] == ["Later"]


def test_newer_broken_row_hides_the_older_good_one(raw, reference):
    broken = {**SHOPIFY_ORDER, "created_at": "soon"}
    df = normalize(raw(channels.SHOPIFY, documents(SHOPIFY_ORDER, broken)), channels.SHOPIFY, reference)
    assert df.count() == 0


def test_fractional_quantity_is_dropped(raw, reference):
    lines = [{**SHOPIFY_ORDER["line_items"][0], "quantity": 1.5}]
    df = normalize(
        raw(channels.SHOPIFY, documents({**SHOPIFY_ORDER, "line_items": lines})), channels.SHOPIFY, reference
    )
    assert df.count() == 0


def test_malformed_documents_are_named_and_the_rest_continues(raw, reference):
    bad = [
        (1, "{nonsense"),
        (2, json.dumps({**SHOPIFY_ORDER, "line_items": None})),
        (3, json.dumps({**SHOPIFY_ORDER, "line_items": {}})),
        (4, json.dumps({k: v for k, v in SHOPIFY_ORDER.items() if k != "id"})),
        (5, json.dumps({k: v for k, v in SHOPIFY_ORDER.items() if k != "created_at"})),
        (6, json.dumps({"id": 6, "created_at": "2024-03-15T00:00:00Z"})),
        (7, json.dumps({**SHOPIFY_ORDER, "id": 7})),
    ]
    rows = raw(channels.SHOPIFY, bad)
    reasons = {r.raw_id: r.reason for r in malformed(rows, channels.SHOPIFY).collect()}
    assert reasons == {
        1: "payload: not a JSON document",
        2: "line_items: not an array",
        3: "line_items: not an array",
        4: "id: missing",
        5: "created_at: missing",
    }
    good = normalize(rows, channels.SHOPIFY, reference).collect()
    assert {r.platform_order_id for r in good} == {"7"}


def test_lines_that_do_not_fit_are_refused_not_fatal(raw, reference):
    lines = SHOPIFY_ORDER["line_items"]
    huge = {**SHOPIFY_ORDER, "line_items": [{**lines[0], "price": "100000000.00"}, lines[1]]}
    rows = raw(channels.SHOPIFY, documents(huge))
    assert set(by_line(normalize(rows, channels.SHOPIFY, reference))) == {"102"}
    out = judged(rows, channels.SHOPIFY, reference).collect()
    assert {(r.platform_line_id, r.refusal) for r in out} == {
        ("101", "unit_price_local: out of range"), ("102", None),
    }


def test_mercadolibre(raw, reference):
    order = {
        "id": 2000001,
        "date_created": "2024-03-15T20:00:00.000-05:00",
        "status": "paid",
        "buyer": {"email": "b@example.com"},
        "order_items": [
            {"item": {"seller_sku": "MLA-a", "title": "Polo"}, "quantity": 3, "unit_price": 33.335},
            {"item": None, "unit_price": None},
            {"item": {"seller_sku": "x"}, "quantity": None, "unit_price": 1},
        ],
    }
    got = by_line(
        normalize(raw(channels.MERCADOLIBRE, documents(order)), channels.MERCADOLIBRE, reference)
    )
    assert set(got) == {"2000001-1", "2000001-2"}
    one, two = got["2000001-1"], got["2000001-2"]
    assert one.order_dt_utc == datetime(2024, 3, 16, 1)
    assert (one.currency, one.line_total_local, one.discount_local) == ("PEN", dec("100.01"), dec("0"))
    assert one.line_total_usd == dec("30.003")
    assert (two.quantity, two.unit_price_local, two.platform_sku) == (0, dec("0"), None)


AMAZON_ROW = (
    "111-1", "MRC1", "2024-03-15T10:30:00+00:00", None, "Shipped", " B0A ", "Polo", "-2", None,
    "1,299.90", "104.00", "0.00", "c@example.com", "Lima", "LI",
)


def test_amazon(raw, reference):
    other = (*AMAZON_ROW[:4], "Lost", *AMAZON_ROW[5:7], "1", "USD", *AMAZON_ROW[9:])
    got = by_line(normalize(raw(channels.AMAZON, [AMAZON_ROW, other]), channels.AMAZON, reference))
    assert set(got) == {"111-1-1", "111-1-2"}
    one = got["111-1-1"]
    assert (one.quantity, one.unit_price_local, one.line_total_local) == (-2, dec("1299.9"), dec("-2599.8"))
    assert (one.tax_local, one.discount_local, one.currency) == (dec("104"), None, "USD")
    assert got["111-1-2"].order_status == "unknown"


def test_landing_a_report_again_does_not_number_its_lines_on(raw, reference):
    rows = [AMAZON_ROW, AMAZON_ROW, AMAZON_ROW, AMAZON_ROW]
    df = normalize(raw(channels.AMAZON, rows, batches=[1, 1, 2, 2]), channels.AMAZON, reference)
    assert set(by_line(df)) == {"111-1-1", "111-1-2"}
    assert {r.raw_id for r in df.collect()} == {3, 4}


def test_lines_of_an_order_in_several_reports_all_stay(raw, reference):
    """Lines A and B come first, C in a later report, then B changed, and a second A."""

    def line(sku, status="Shipped"):
        return (*AMAZON_ROW[:4], status, sku, *AMAZON_ROW[6:])

    rows = [line("A"), line("B"), line("C"), line("B", "Refunded"), line("A"), line("A")]
    df = normalize(raw(channels.AMAZON, rows, batches=[1, 1, 2, 3, 4, 4]), channels.AMAZON, reference)
    found = {r.platform_line_id: (r.platform_sku, r.order_status, r.raw_id) for r in df.collect()}
    assert found == {
        "111-1-1": ("A", "paid", 5),
        "111-1-2": ("B", "refunded", 4),
        "111-1-3": ("C", "paid", 3),
        "111-1-4": ("A", "paid", 6),
    }


def test_tiendanube(raw, reference):
    row = ("3001", "15/03/2024", "Pagado", "Enviado", "Ana", None, "tn a", "Polo", "2", "S/ 40.00",
           "0", "80.00", None)
    got = by_line(normalize(raw(channels.TIENDANUBE, [row]), channels.TIENDANUBE, reference))
    line = got["3001-1"]
    assert line.order_dt_utc == datetime(2024, 3, 15, 5)
    assert (line.currency, line.order_status, line.line_total_usd) == ("PEN", "paid", dec("20"))


def test_pos(raw, reference):
    row = (4000001, datetime(2024, 3, 15, 20, 0), 1, "Ana", "POS1", "Polo", 2, "40.00", "0.00",
           "80.00", "YAPE", None)
    got = by_line(normalize(raw(channels.POS, [row]), channels.POS, reference))
    line = got["4000001"]
    assert line.platform_order_id == "4000001"
    assert line.order_dt_utc == datetime(2024, 3, 16, 1)
    # 2024-03-16 has no rate: the newest of the currency counts, though it is later.
    assert (line.currency, line.order_status, line.line_total_usd) == ("PEN", "paid", dec("24"))


def test_a_channel_without_rows_gives_an_empty_staging_frame(raw, reference):
    for channel in channels.CHANNELS.values():
        df = normalize(raw(channel, []), channel, reference)
        assert df.schema.names == schemas.STAGING.names and df.count() == 0
