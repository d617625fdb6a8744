from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary.operators import lookup, ordering, reshape, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lookups -------------------------------------------------------------------

FX = [
    ("USD", "2024-03-15", "1.000000"),
    ("PEN", "2024-03-15", "0.266700"),
    ("PEN", "2024-03-18", "0.270000"),
]


@pytest.fixture
def fx(table):
    return table("currency string, rate_date string, rate string", FX).select(
        "currency",
        F.col("rate_date").cast("date").alias("rate_date"),
        F.col("rate").cast("decimal(12,6)").alias("rate_to_usd"),
    )


def test_rate_of_the_day_else_newest_of_the_currency(table, fx):
    orders = table(
        "id int, currency string, order_dt_utc timestamp",
        [
            (1, "PEN", datetime(2024, 3, 15, 23)),
            (2, "PEN", datetime(2024, 3, 16, 1)),
            (3, "USD", datetime(2020, 1, 1)),
            (4, "EUR", datetime(2024, 3, 15)),
            (5, None, datetime(2024, 3, 15)),
            (6, "PEN", None),
        ],
    )
    rated = lookup.attach_rate(orders, fx, lookup.latest_rates(fx))
    got = {r.id: r.rate_to_usd for r in rated.collect()}
    new = Decimal("0.270000")
    assert got == {1: Decimal("0.266700"), 2: new, 3: Decimal("1.000000"), 4: None, 5: None, 6: new}
    assert rated.columns.count("rate_to_usd") == 1 and "latest_rate" not in rated.columns


def test_status_is_exact_and_per_channel(table):
    statuses = table(
        "source_platform string, raw_status string, canonical_status string",
        [("shopify", "paid", "paid"), ("pos", "YAPE", "paid")],
    )
    orders = table(
        "id int, source_platform string, raw_status string",
        [(1, "shopify", "paid"), (2, "shopify", "PAID"), (3, "pos", "paid"), (4, "pos", None), (5, "pos", "YAPE")],
    )
    got = {r.id: r.order_status for r in lookup.map_status(orders, statuses).collect()}
    assert got == {1: "paid", 2: "unknown", 3: "unknown", 4: "unknown", 5: "paid"}


@pytest.fixture
def mapping(table):
    return table(
        "source_platform string, platform_sku string, sku_canonical string, product_name string, category string",
        [
            ("shopify", "Cup Large/7", "K-2", "Cup", "Tableware"),
            ("shopify", " cup large/7", "K-1", "Mug", "Tableware"),
            ("amazon", "ZK77", "K-2", "Cup", "Tableware"),
        ],
    )


def test_canonical_sku(table, mapping):
    lines = table(
        "source_platform string, platform_sku string",
        [
            ("amazon", " zk77 "),
            ("shopify", "plate"),
            ("amazon", "Cup Large/7"),
            ("shopify", None),
            ("shopify", "Cup LARGE/7"),
        ],
    )
    got = lookup.attach_canonical(lines, lookup.sku_lookup(mapping)).collect()
    assert {(r.platform_sku, r.sku_canonical) for r in got} == {
        (" zk77 ", "K-2"),
        ("plate", None),
        ("Cup Large/7", None),
        (None, None),
        ("Cup LARGE/7", "K-1"),
    }
    conflicts = rows(lookup.mapping_conflicts(mapping))
    assert conflicts == [("shopify", "cup large/7", 2, "K-1")]


def test_coverage_and_unmapped(table, mapping):
    lines = table(
        "source_platform string, platform_sku string",
        [("shopify", "x"), ("shopify", "x"), ("shopify", "X"), ("shopify", None), ("amazon", "ZK77")],
    )
    enriched = lookup.attach_canonical(lines, lookup.sku_lookup(mapping))
    assert lookup.sku_coverage(enriched).first() == (5, 1, 4)
    counts = lookup.unmapped_skus(enriched)
    assert rows(counts) == [("shopify", "X", 1), ("shopify", "x", 2)]
    assert lookup.unmapped_totals(counts).first() == (2, 3)


def test_a_table_over_the_bound_is_joined_without_broadcast(spark, table):
    big = spark.range(50).select(F.col("id"), (F.col("id") * 2).alias("double"))
    size = lookup.estimated_bytes(big)
    assert lookup.fits(big, size) and not lookup.fits(big, size - 1)
    left = spark.range(80)
    plans, results = [], []
    for bound in (size, size - 1):
        joined = left.join(lookup.checked(big, bound), "id", "left")
        plans.append(joined._jdf.queryExecution().optimizedPlan().toString())
        results.append(rows(joined))
    assert results[0] == results[1] and len(results[0]) == 80
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]


# --- order -----------------------------------------------------------------------

def test_dedupe_keeps_last_or_first(spark):
    """60 readings of 7 meters: the last is the greatest place, the first the least."""
    df = spark.range(60).select((F.col("id") * 11 % 7).alias("meter"), (F.col("id") * 13 % 61).alias("place"))
    places = {}
    for r in df.collect():
        places.setdefault(r.meter, []).append(r.place)
    for keep, chosen in (("last", max), ("first", min)):
        kept = ordering.dedupe_by_key(df, ["meter"], ["place"], keep=keep)
        assert rows(kept) == sorted(((m, chosen(p)) for m, p in places.items()), key=repr)
    with pytest.raises(ValueError):
        ordering.dedupe_by_key(df, ["meter"], ["place"], keep="any")


def test_newer_incomplete_row_hides_the_older_complete_one(table):
    df = table("o string, raw_id int, q int", [("A", 1, 3), ("A", 2, None), ("B", 1, 1)])
    left = ordering.drop_incomplete(ordering.dedupe_by_key(df, ["o"], ["raw_id"]), ["q"])
    assert rows(left) == [("B", 1, 1)]


def test_line_positions_of_a_group_over_many_slices(spark):
    """A third of the rows is one group, cut into many slices."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("raw_id"),
    )
    numbered = ordering.line_position(df, ["g"], ["raw_id"], F.floor(F.col("raw_id") / 64))
    got = {(r.g, r.raw_id): r.line_pos for r in numbered.collect()}
    seen, expected = Counter(), {}
    for r in sorted(df.collect(), key=lambda r: r.raw_id):
        seen[r.g] += 1
        expected[(r.g, r.raw_id)] = seen[r.g]
    assert seen["hot"] == 1000
    assert got == expected


def test_surrogate_ids_are_unique_stable_and_above_start(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    ids = ordering.surrogate_ids(df, ["k"], 100, 16, "sale_id")
    got = {r.k: r.sale_id for r in ids.collect()}
    again = ordering.surrogate_ids(df.repartition(7), ["k"], 100, 16, "sale_id")
    assert len(set(got.values())) == 5000 and min(got.values()) > 100
    assert got == {r.k: r.sale_id for r in again.collect()}


def test_known_ids_are_kept_and_use_up_no_new_one(table):
    rows = [("a", 7), *[(k, None) for k in "bcd"], ("e", 3)]
    ids = ordering.surrogate_ids(table("k string, old bigint", rows), ["k"], 7, 1, "sale_id", "old")
    assert {r.k: r.sale_id for r in ids.collect()} == {"a": 7, "b": 8, "c": 9, "d": 10, "e": 3}


# --- upsert ------------------------------------------------------------------------

TARGET = "k string, v string, n bigint, seen string, extra string"


def test_merge_updates_inserts_keeps_and_accumulates(table):
    old = table(TARGET, [("a", "1", 10, "first", "x"), ("b", "2", 20, "first", "y")])
    new = table("k string, v string, n bigint, seen string", [("b", None, 5, "second"), ("c", "3", 7, "second")])
    merged = upsert.merge_rows(old, new, ["k"], keep=["seen"], accumulate=["n"])
    assert rows(merged) == [
        ("a", "1", 10, "first", "x"),
        ("b", None, 25, "first", "y"),
        ("c", "3", 7, "second", None),
    ]


def test_insert_absent(table):
    old = table("k string, v string", [("a", "1")])
    new = table("k string, v string", [("a", "9"), ("b", "2")])
    assert rows(upsert.insert_absent(old, new, ["k"])) == [("b", "2")]


def test_stored_upsert_rewrites_touched_buckets_only(spark, table, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    upsert.upsert_table(spark, path, df.schema, df, ["k"], buckets=8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("key_bucket=*/*/*.parquet")}
    one = table("k string, v string", [("7", "new")])
    upsert.upsert_table(spark, path, df.schema, one, ["k"], buckets=8)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("key_bucket=*/*/*.parquet")}
    assert all(after[p] == before[p] for p in before)
    assert len({p.parent.parent for p in set(after) - set(before)}) == 1
    got = dict(rows(upsert.read_table(spark, path, df.schema)))
    assert len(got) == 200 and got["7"] == "new" and got["8"] == "old"


def test_append_absent(spark, table, tmp_path):
    path = str(tmp_path / "t")
    schema = table("k string, v string", [("a", "1")]).schema
    upsert.append_absent(spark, path, schema, table("k string, v string", [("a", "1")]), ["k"])
    upsert.append_absent(spark, path, schema, table("k string, v string", [("a", "9"), ("b", "2")]), ["k"])
    assert rows(upsert.read_table(spark, path, schema)) == [("a", "1"), ("b", "2")]


# --- reshape -------------------------------------------------------------------------


def test_default_calendar(spark):
    from tributary.plans.warehouse import dim_date

    days = dim_date(spark)
    assert days.count() == 1827
    first = days.orderBy("date_id").first()
    assert first.date_id == date(2024, 1, 1) and first.day_name == "Lunes"


def test_a_mistyped_year_adds_that_year_alone(table):
    from tributary.plans.warehouse import dim_date_for

    orders = table("day string", [("2025-06-30",), ("2025-01-02",), ("9024-02-29",), (None,)])
    days = dim_date_for(orders, F.col("day").cast("date"))
    assert rows(days.groupBy("year").count()) == [(2025, 365), (9024, 366)]


def test_unpivot_catalog(table):
    catalog = table("sku_canonical string, sku_a string, sku_b string", [("C1", "a1", "b1")])
    long = reshape.unpivot_catalog(catalog, {"a": "sku_a", "b": "sku_b"})
    assert rows(long) == [("C1", "a", "a1"), ("C1", "b", "b1")]


def test_stage_counts(table):
    df = table("k string, raw_id int, q int", [("a", 1, 1), ("a", 2, None), ("b", 1, 1), ("c", 1, 2), ("c", 2, 3)])
    counts = reshape.stage_counts(df, ["k"], F.col("raw_id"), ["q"]).first()
    assert tuple(counts) == (5, 2, 1, 2)


def test_upsert_counts_each_key_once(spark, table, tmp_path):
    rows = table("sku string, price string", [("a", "1"), ("a", "2"), ("b", "7")])
    for path, write, left in (
        (str(tmp_path / "update"), upsert.upsert_table, "2"),
        (str(tmp_path / "absent"), upsert.append_absent, "1"),
    ):
        write(spark, path, rows.schema, rows, ["sku"])
        found = upsert.read_table(spark, path, rows.schema).collect()
        assert sorted(map(tuple, found)) == [("a", left), ("b", "7")]


def test_older_rows_replace_nothing_newer(table):
    columns = "sku string, at int, price string"
    stored = table(columns, [("a", 2, "new"), ("b", 1, "old"), ("c", 3, "same")])
    late = table(columns, [("a", 1, "late"), ("b", 5, "newer"), ("c", 3, "again"), ("d", 1, "first")])
    merged = upsert.merge_rows(stored, late, ["sku"], newer_by=["at"]).collect()
    assert sorted(map(tuple, merged)) == [
        ("a", 2, "new"),
        ("b", 5, "newer"),
        ("c", 3, "again"),
        ("d", 1, "first"),
    ]
