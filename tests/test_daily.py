import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tributary import schemas
from tributary.literals import literal_table
from tributary.plans import daily
from tributary.plans.sample import workbook_bytes
from tributary.sources import drops

AS_OF = datetime(2024, 4, 1, tzinfo=UTC)
SHOPIFY = {
    "orders": [
        {
            "id": 1,
            "created_at": "2024-03-15T10:00:00-05:00",
            "financial_status": "paid",
            "customer": None,
            "line_items": [
                {"id": 11, "sku": "shp-1 ", "title": "Polo", "quantity": 2, "price": "10.00",
                 "total_discount": "0", "line_total": "20.00"},
                {"id": 12, "sku": "SHP-?", "title": "?", "quantity": 0, "price": "1.00",
                 "total_discount": "0", "line_total": "0.00"},
            ],
        }
    ]
}
MERCADOLIBRE = {
    "results": [
        {"id": 2, "date_created": "2024-03-15T10:00:00Z", "status": "paid", "buyer": None,
         "order_items": [{"item": {"seller_sku": "MLA-1"}, "quantity": 1, "unit_price": 40}]}
    ]
}
AMAZON = ["111-1", "M1", "2024-03-15T10:00:00+00:00", "", "Shipped", "B0-1", "Polo", "3", "USD",
          "5.00", "0.40", "0.00", "", "", ""]
TIENDANUBE = ("3001", "15/03/2024", "Pagado", "Enviado", "Ana", None, "tn-1", "Polo", 1, "40.00",
              "0", "40.00", "PEN")


@pytest.fixture
def sources(spark, tmp_path):
    base = tmp_path / "drops"
    base.mkdir()
    (base / "shopify.json").write_text(json.dumps(SHOPIFY))
    (base / "ml.json").write_text(json.dumps(MERCADOLIBRE))
    lines = "\t".join(drops.AMAZON_HEADERS) + "\n" + "\t".join(AMAZON) + "\n"
    (base / "amazon.tsv").write_text(lines)
    (base / "tn.xlsx").write_bytes(workbook_bytes(list(drops.TIENDANUBE_HEADERS), [TIENDANUBE]))
    till(spark, base, [(1, datetime(2024, 3, 15, 9)), (2, datetime(2024, 3, 15, 21))])
    return {
        "shopify": str(base / "shopify.json"),
        "mercadolibre": str(base / "ml.json"),
        "amazon": str(base / "amazon.tsv"),
        "tiendanube": str(base / "tn.xlsx"),
        "pos": str(base / "pos"),
    }


def till(spark, base, sales, price="4.00"):
    text = schemas.struct("venta_id bigint, fecha_venta timestamp_ntz")
    rows = literal_table(spark, sales, text).withColumns(
        {
            "tienda_id": F.lit(1),
            "cajero": F.lit("Ana"),
            "sku": F.lit("POS1"),
            "producto": F.lit("Polo"),
            "cantidad": F.lit(1),
            "precio_unit": F.lit(price).cast("decimal(12,2)"),
            "descuento": F.lit("0").cast("decimal(12,2)"),
            "total_linea": F.lit(price).cast("decimal(12,2)"),
            "medio_pago": F.lit("YAPE"),
            "cliente_doc": F.lit(None).cast("string"),
        }
    )
    rows.select(*schemas.POS_VENTAS.names).write.mode("append").parquet(str(base / "pos"))


@pytest.fixture
def store(spark, tmp_path, table):
    store = daily.Store(spark, str(tmp_path / "warehouse"), buckets=4)
    fx = table(
        "currency string, rate_date string, rate string",
        [("USD", "2024-03-15", "1"), ("PEN", "2024-03-15", "0.25"), ("PEN", "2024-03-16", "0.5")],
    ).select(
        "currency",
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("rate").cast("decimal(12,6)").alias("rate_to_usd"),
    )
    price = F.lit("10").cast("decimal(12,2)").alias("base_price_usd")
    products = table(
        "sku_canonical string, product_name string, category string", [("POL-1", "Polo", "Polos")]
    ).select("*", price)
    mapping = table(
        "source_platform string, platform_sku string, sku_canonical string, product_name string, category string",
        [
            (p, s, "POL-1", "Polo", "Polos")
            for p, s in [("shopify", "SHP-1"), ("mercadolibre", "MLA-1"), ("amazon", "B0-1"),
                         ("tiendanube", "tn-1"), ("pos", "POS1")]
        ],
    ).select("*", price)
    daily.seed_reference(store, fx, products, mapping)
    return store


def facts(store):
    return {
        (r.source_platform, r.platform_line_id): r for r in store.read("core/fact_sales").collect()
    }


def test_first_run(spark, store, sources):
    summary = daily.run(store, sources, AS_OF)
    assert summary["extract"] == {"shopify": 1, "mercadolibre": 1, "amazon": 1, "tiendanube": 1, "pos": 2}
    assert summary["normalize"] == {"shopify": 2, "mercadolibre": 1, "amazon": 1, "tiendanube": 1, "pos": 2}
    assert summary["validate"] == {"total": 7, "valid": 6, "rejected": 1}
    assert summary["load"] == {"fact_sales_rows_upserted": 7}
    loaded = facts(store)
    # Validation does not gate the load: the row with quantity zero is loaded too.
    assert loaded[("shopify", "12")].quantity == 0 and loaded[("shopify", "12")].product_id is None
    assert loaded[("shopify", "11")].product_id is not None
    assert len({r.sale_id for r in loaded.values()}) == 7
    rejected = store.read("ops/rejected_rows").collect()
    assert [(r.source_name, r.reason) for r in rejected] == [
        ("shopify", "quantity: Value error, quantity cannot be zero")
    ]
    daily.create_views(store)
    got = {(r.platform_name, r.month, r.category): r for r in spark.table("v_revenue_monthly").collect()}
    assert float(got[("Shopify", 3, "Polos")].revenue_usd) == 20.0
    assert float(got[("Amazon", 3, "Polos")].revenue_usd) == 15.0
    assert got[("Tienda Física", 3, "Polos")].line_items == 2
    # One till sale falls on the 16th in UTC, at the other rate.
    assert float(got[("Tienda Física", 3, "Polos")].revenue_usd) == 3.0
    assert got[("Shopify", 3, "Sin categoría")].units == 0
    wide = spark.table("v_sales_wide")
    assert len(wide.columns) == 29 and wide.count() == 7


def test_second_run_is_idempotent_and_incremental(spark, store, sources, tmp_path):
    daily.run(store, sources, AS_OF)
    before = facts(store)
    # A late sale (before the watermark) is never picked up, a newer one is.
    till(spark, tmp_path / "drops", [(3, datetime(2024, 3, 15, 20)), (4, datetime(2024, 3, 16, 9))])
    summary = daily.run(store, sources, AS_OF)
    assert summary["extract"]["pos"] == 1
    after = facts(store)
    assert set(after) - set(before) == {("pos", "4")}
    assert all(after[k].sale_id == before[k].sale_id for k in before)
    assert len({r.sale_id for r in after.values()}) == len(after)
    marks = {r.source_name: r for r in store.read("ops/etl_checkpoints").collect()}
    assert marks["pos"].last_watermark == datetime(2024, 3, 16, 14) and marks["pos"].rows_ingested == 3
    assert marks["shopify"].rows_ingested == 2
    runs = store.read("ops/pipeline_runs").orderBy("run_id").collect()
    assert [(r.run_id, r.status) for r in runs] == [(1, "success"), (2, "success")]
    assert json.loads(runs[1].sources_summary)["extract"]["pos"] == 1


def test_changed_row_updates_its_fact(spark, store, sources, tmp_path):
    daily.run(store, sources, AS_OF)
    before = facts(store)[("shopify", "11")]
    order = SHOPIFY["orders"][0]
    moved = {**order, "created_at": "2024-03-16T10:00:00-05:00", "financial_status": "refunded"}
    (tmp_path / "drops" / "shopify.json").write_text(json.dumps({"orders": [moved]}))
    daily.run(store, sources, AS_OF)
    after = facts(store)[("shopify", "11")]
    assert (after.order_status, str(after.date_id)) == ("refunded", "2024-03-16")
    assert after.sale_id == before.sale_id


def test_gate_loads_valid_rows_only(store, sources):
    summary = daily.run(store, sources, AS_OF, gate=True)
    assert summary["load"] == {"fact_sales_rows_upserted": 6}
    assert ("shopify", "12") not in facts(store)


def test_absent_drops_do_not_stop_the_run(store, sources):
    summary = daily.run(store, {"shopify": sources["shopify"], "amazon": "/nowhere/a.tsv"}, AS_OF)
    assert summary["extract"] == {"shopify": 1, "amazon": 0}
    assert len(facts(store)) == 2


def test_failed_run_is_recorded(store, sources, tmp_path):
    (tmp_path / "drops" / "shopify.json").write_text('{"orders": [')
    with pytest.raises(Exception):
        daily.run(store, sources, AS_OF)
    run = store.read("ops/pipeline_runs").first()
    assert run.status == "failed" and "Traceback" in run.error_message
    assert run.finished_at is not None


def test_unmapped_report_accumulates(store, sources):
    daily.run(store, sources, AS_OF)
    assert daily.report_unmapped(store) == {"total_rows": 7, "matched": 6, "unmatched": 1}
    first = store.read("ops/unmapped_skus").first()
    daily.report_unmapped(store)
    second = store.read("ops/unmapped_skus").first()
    assert (first.platform_sku, first.occurrences, second.occurrences) == ("SHP-?", 1, 2)
    assert second.first_seen_at == first.first_seen_at
    assert second.last_seen_at > first.last_seen_at and second.resolved is False


def test_seeding_again_keeps_product_ids(store, table):
    before = store.read("core/dim_product").first()
    rows = table(
        "sku_canonical string, product_name string, category string",
        [("POL-1", "Polo 2", "Polos"), ("CAM-1", "Camisa", "Camisas")],
    ).withColumn("base_price_usd", F.lit("12").cast("decimal(12,2)"))
    daily.upsert_products(store, rows)
    got = {r.sku_canonical: r for r in store.read("core/dim_product").collect()}
    assert got["POL-1"].product_id == before.product_id and got["POL-1"].product_name == "Polo 2"
    assert got["CAM-1"].product_id > before.product_id
    assert store.read("core/dim_platform").count() == 5
    assert store.read("reference/status_mapping").count() == 19


def test_new_rates_reach_the_rows_they_apply_to(store, sources, table):
    daily.run(store, sources, AS_OF)
    before = facts(store)
    rates = table("currency string, day string, rate string", [("PEN", "2024-03-16", "0.8")]).select(
        "currency",
        F.col("day").cast("date").alias("rate_date"),
        F.col("rate").cast("decimal(12,6)").alias("rate_to_usd"),
    )
    store.upsert("reference/fx_rates", rates, ["currency", "rate_date"])
    summary = daily.run(store, {}, AS_OF)
    # The sale of the 16th and no other one.
    assert summary["load"] == {"fact_sales_rows_upserted": 1} and summary["normalize"]["pos"] == 1
    after = facts(store)
    assert [k for k in after if after[k].line_total_usd != before[k].line_total_usd] == [("pos", "2")]
    assert float(after[("pos", "2")].line_total_usd) == 3.2
    assert daily.run(store, {}, AS_OF)["load"] == {"fact_sales_rows_upserted": 0}


def test_a_new_mapping_reaches_the_facts(store, sources, table):
    daily.run(store, sources, AS_OF)
    price = F.lit("10").cast("decimal(12,2)").alias("base_price_usd")
    mapping = table(
        "source_platform string, platform_sku string, sku_canonical string, product_name string, category string",
        [("shopify", "SHP-?", "POL-1", "Polo", "Polos")],
    ).select("*", price)
    store.upsert("reference/sku_mapping", mapping, ["source_platform", "platform_sku"])
    summary = daily.run(store, {}, AS_OF)
    assert summary["normalize"]["shopify"] == 0 and summary["load"] == {"fact_sales_rows_upserted": 7}
    assert facts(store)[("shopify", "12")].product_id is not None


def test_a_run_takes_up_what_a_failed_one_left(store, sources, monkeypatch):
    monkeypatch.setattr(daily, "load_facts", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run(store, sources, AS_OF)
    monkeypatch.undo()
    assert facts(store) == {}
    assert daily.run(store, {}, AS_OF)["load"] == {"fact_sales_rows_upserted": 7}
    assert len(facts(store)) == 7


def test_rejects_are_recorded_once(store, sources):
    for _ in range(2):
        daily.run(store, sources, AS_OF)
    first, again = store.read("ops/rejected_rows").orderBy("raw_id").collect()
    # The drop has landed twice, as two raw rows; judging a row again adds nothing.
    assert (first.first_run_id, first.last_run_id, again.first_run_id) == (1, 1, 2)
    daily.validate(store, 9, F.lit(AS_OF))
    rejects = {r.raw_id: (r.first_run_id, r.last_run_id) for r in store.read("ops/rejected_rows").collect()}
    assert rejects == {first.raw_id: (1, 1), again.raw_id: (2, 9)}


def test_files_are_landed_once(store, sources, tmp_path):
    started = datetime(2024, 4, 1, tzinfo=UTC)
    channel = store.channels["shopify"]

    def ingest(run):
        return daily.ingest_new_files(store, channel, str(tmp_path / "drops" / "s*.json"), run, started)

    assert [ingest(1), ingest(2)] == [1, 0]
    (tmp_path / "drops" / "s2.json").write_text(json.dumps({"orders": [{"id": 5}, {"id": 6}]}))
    assert [ingest(3), ingest(4)] == [2, 0]
    assert sorted((r.batch_id, r.order_id) for r in store.raw(channel).collect()) == [(1, 1), (3, 5), (3, 6)]
    mark = store.read("ops/etl_checkpoints").first()
    assert mark.rows_ingested == 3
    assert daily.ingest_new_files(store, channel, str(tmp_path / "none"), 5, started) == 0


def test_a_step_that_landed_but_was_not_marked_is_not_landed_again(store, sources, tmp_path, monkeypatch):
    started, channel = datetime(2024, 4, 1, tzinfo=UTC), store.channels["shopify"]
    land = daily.land

    def land_and_stop(*args, **kwargs):
        land(*args, **kwargs)
        raise OSError("stopped")

    monkeypatch.setattr(daily, "land", land_and_stop)
    with pytest.raises(Exception, match="stopped"):
        daily.ingest_new_files(store, channel, sources["shopify"], 1, started)
    monkeypatch.undo()
    assert daily.ingest_new_files(store, channel, sources["shopify"], 2, started) == 0
    assert [r.batch_id for r in store.raw(channel).collect()] == [1]


def test_validation_scans_staging_once(spark, store, sources):
    daily.run(store, sources, AS_OF)
    # One write of the rejects counts on the way; the totals need no job of their own.
    assert daily.validate(store, 2, F.lit(AS_OF)) == {"total": 7, "valid": 6, "rejected": 1}
