"""Steps that read, store and move their rows less often, with the same result."""

from pyspark.sql import functions as F

from tributary import schemas
from tributary.literals import literal_table
from tributary.operators.lookup import sku_coverage, unmapped_skus
from tributary.plans import channels, daily
from tributary.plans.normalize import malformed


def test_counts_of_rows_that_stand_for_several(table):
    pairs = table(
        "source_platform string, platform_sku string, sku_canonical string, n bigint",
        [("a", "x", "X", 3), ("a", "y", None, 2), ("a", None, None, 5)],
    )
    assert tuple(sku_coverage(pairs, pairs.n).first()) == (10, 3, 7)
    assert tuple(sku_coverage(pairs.where("false"), pairs.n).first()) == (0, 0, 0)
    assert [tuple(r) for r in unmapped_skus(pairs, pairs.n).collect()] == [("a", "y", 2)]


def test_rows_are_stored_once_before_they_are_numbered(spark, table, tmp_path, monkeypatch):
    labels = []
    monkeypatch.setattr(daily, "stored", lambda df, label, store=daily.stored: labels.append(label) or store(df, label))
    store = daily.Store(spark, str(tmp_path))
    products = table("sku_canonical string, product_name string, category string, base_price_usd decimal(12,2)", [
        (s, s, s, None) for s in "abc"
    ])
    daily.upsert_products(store, products)
    assert labels == ["unnumbered"]
    daily.upsert_products(store, products.unionByName(products.selectExpr("'d' AS sku_canonical", "product_name", "category", "base_price_usd").limit(1)))
    held = {r.sku_canonical: r.product_id for r in store.read("core/dim_product").collect()}
    assert sorted(held.values()) == [1, 2, 3, 4] and held["d"] == 4
    assert daily.notes(spark, store.path("core/dim_product"))["top_product_id"] == 4


def test_a_shuffle_is_cut_by_its_size_and_goes_with_its_action(spark):
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 512
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counts = spark.range(100).groupBy("id").count()
    assert len(counts.collect()) == len(counts.collect()) == 100


def test_a_document_is_judged_by_one_parse(table):
    payloads = [
        '{"id": 1, "created_at": "x", "line_items": []}', "{", None, '{"created_at": "x"}', '{"id": 1}',
        '{"id": 1, "created_at": "x", "line_items": 3}', '{"id": 1, "created_at": "x", "line_items": [3]}',
    ]
    raw = table("raw_id bigint, payload string", list(enumerate(payloads)))
    found = malformed(raw, channels.CHANNELS["shopify"])
    assert found._jdf.queryExecution().analyzed().toString().count("parse_json(") == 1
    assert {r.raw_id: r.reason for r in found.collect()} == {
        1: "payload: not a JSON document", 2: "payload: not a JSON document", 3: "id: missing", 4: "created_at: missing",
        5: "line_items: not an array", 6: "payload: not an order document",
    }


def test_new_ids_are_told_from_keys(spark, table, tmp_path, monkeypatch):
    labels, store = [], daily.Store(spark, str(tmp_path))
    monkeypatch.setattr(daily, "stored", lambda df, label, keep=daily.stored: labels.append(label) or keep(df, label))
    make = lambda rows: table("platform_order_id string, quantity int", rows).select(*[
        F.lit("pos").alias(f.name) if f.name == "source_platform"
        else F.lit("USD").alias(f.name) if f.name == "currency"
        else F.col("platform_order_id").alias(f.name) if f.name == "platform_line_id"
        else F.col(f.name) if f.name in ("platform_order_id", "quantity")
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.STAGING
    ], F.lit(None).cast("string").alias("reason"))
    daily.seed_reference(
        store, *[literal_table(spark, [], s) for s in (schemas.FX_RATES, schemas.PRODUCTS, schemas.SKU_MAPPING)]
    )
    labels.clear()
    assert daily.load_facts(store, make([("a", 1), ("b", 1), (None, 1)])) == 3
    held = {r.platform_order_id: r.sale_id for r in store.read("core/fact_sales").collect()}
    assert sorted(held.values()) == [1, 2, 3] and labels == ["unnumbered", "keys"]
    assert daily.load_facts(store, make([("b", 2), ("c", 2), ("c", 3), (None, 2)])) == 4
    after = {r.platform_order_id: (r.sale_id, r.quantity) for r in store.read("core/fact_sales").collect()}
    assert after == {"a": (held["a"], 1), "b": (held["b"], 2), None: (held[None], 2), "c": (4, 3)}
    assert daily.notes(spark, store.path("core/fact_sales"))["top_sale_id"] == 4
    assert labels[2:] == ["unnumbered", "keys", "new-keys"]  # of the rows, the ids see the keys alone
    assert daily.load_facts(store, make([])) == 0
