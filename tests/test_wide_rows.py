"""Sales rows, the widest there are, are moved for as few lookups as they need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tributary import schemas
from tributary.operators.lookup import sku_lookup
from tributary.plans import sample, warehouse


def lines_of(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def first(lines: list[str], *words: str) -> int:
    return next(i for i, line in enumerate(lines) if all(w in line for w in words))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def star(spark, table):
    skus = [("pos", "1", " a "), ("pos", "2", "B"), ("pos", "3", None), ("pos", "4", "none"), (None, "5", "a"), ("pos", "6", "c")]
    staging = table("source_platform string, platform_line_id string, platform_sku string", skus).select(*[
        F.col(f.name) if f.name in ("source_platform", "platform_line_id", "platform_sku")
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.STAGING
    ])
    staging = staging.withColumn("order_dt_utc", F.lit("2024-05-01 10:00:00").cast("timestamp"))
    mapping = table(
        "source_platform string, platform_sku string, sku_canonical string, product_name string, category string",
        [("pos", "A", "X", "x", "k"), ("pos", "a", "Y", "x", "k"), ("pos", "b", "Z", "z", "k"), ("pos", "c", None, "n", "k")],
    )
    products = table(
        "product_id bigint, sku_canonical string, product_name string, category string",
        [(1, "X", "x", "k"), (2, "X", "x2", "k"), (3, "W", "w", "k"), (4, None, "n", "k")],
    )
    platforms = table(
        "platform_id smallint, platform_code string, platform_name string, platform_type string", [(5, "pos", "Till", "pos")]
    )
    dates = warehouse.dim_date(spark, "2024-01-01", "2024-12-31")
    return staging, platforms, sku_lookup(mapping), products, dates


def test_lookup_and_products_meet_before_the_sales_rows(star, monkeypatch):
    staging, platforms, lookup, products, _ = star
    expected = [  # of a SKU that two products have, a row each; a lookup without a product, or none at all: null
        ("1", "X", 1), ("1", "X", 2), ("2", "Z", None), ("3", None, None), ("4", None, None), ("6", None, None)
    ]
    for fits in (True, False):
        monkeypatch.setattr(warehouse, "fits", lambda _, given=fits: given)
        facts = warehouse.fact_rows(staging, platforms, lookup, products)
        assert rows(facts.select("platform_line_id", "sku_canonical", "product_id")) == sorted(expected, key=repr)
        plan = lines_of(facts)
        by_sku, by_product = first(plan, "Join LeftOuter", "_sku_key"), first(plan, "Join LeftOuter", "sku_canonical")
        assert by_sku < by_product and ("broadcast" in plan[by_sku]) == fits


def test_the_view_takes_the_products_first(star):
    staging, platforms, lookup, products, dates = star
    facts = warehouse.fact_rows(staging, platforms, lookup, products).withColumns(
        {"sale_id": F.lit(1), "loaded_at": F.current_timestamp()}
    )
    view = warehouse.sales_wide(facts, platforms, products, dates)
    plan = lines_of(view)
    assert first(plan, "Join Inner", "date_id") < first(plan, "Join LeftOuter", "product_id")
    assert rows(view.select("platform_line_id", "product_name", "platform_name", "month")) == sorted(
        [("1", "x", "Till", 5), ("1", "x2", "Till", 5), *[(n, None, "Till", 5) for n in "2346"]], key=repr
    )


def order_tables(spark, path):
    """A line of each make for each channel, one twice; orders and lines that find no other, null keys."""
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "", None]
    orders = [(i, 7 if i else None, "FOP"[i % 3], 10.5, i % 7 + 1, p) for i, p in enumerate([*priorities, *priorities])]
    orders.append((None, 7, "F", 1.0, 1, "3-MEDIUM"))
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day int, o_orderpriority string"
    ).withColumn("o_orderdate", F.expr("timestamp'1996-03-01' + make_interval(0, 0, 0, day)")).drop("day").write.parquet(
        f"{path}/orders.parquet"
    )
    lines = [
        (k, 10 + k, 3, n, 2.0 + n, 99.5 * (k + 1), 0.05, 0.02, "NRA"[(k + n) % 3], "FO"[n % 2]) for k in range(15) for n in (1, 1, 2)
    ]
    lines.append((None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O"))
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    ).withColumn("l_shipdate", F.expr("timestamp'1996-04-01'")).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(7, "Ann", 1.0)], "c_custkey bigint, c_name string, c_acctbal double").write.parquet(f"{path}/customer.parquet")
    return str(path)


def test_channels_read_their_own_stored_lines(spark, tmp_path):
    path = order_tables(spark, tmp_path)
    lines = sample.dealt_lines(spark, path)
    for name, build in sample.RAW.items():
        given = sample.raw_of_channel(spark, path, name, lines)
        assert rows(given.drop("ingested_at")) == rows(build(spark, path, name).drop("ingested_at")) != []
        if name != "mercadolibre":  # not the tables, and of the stored lines its part alone
            plan = given._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "PartitionFilters: [isnotnull(_channel" in plan
