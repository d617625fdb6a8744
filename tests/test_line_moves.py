"""Lines that were dealt by order to be numbered are deduped where they are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tributary.operators.ordering import dedupe_by_key, drop_incomplete
from tributary.plans import channels, normalize
from tributary.sources import landing

ORDER = {"amazon": "amazon_order_id", "tiendanube": "n_orden"}
MOMENT = {"amazon": ("purchase_date", "2024-01-02T03:04:05Z"), "tiendanube": ("fecha", "02/01/2024")}
QUANTITY = {"amazon": "quantity_purchased", "tiendanube": "cantidad"}


def raw_rows(table, name, n=300):
    """Two batches; some rows have no order, some no quantity."""
    channel, rng = channels.CHANNELS[name], random.Random(5)
    columns = ["order_", "sku", "moment", "quantity", "raw_id", "batch_id"]
    rows = [
        (rng.choice(["o1", "o2", "o3", None]), rng.choice(["s", "t", None]), MOMENT[name][1],
         rng.choice(["1", "2", None]), i, 1 + i // (n // 2))
        for i in range(n)
    ]
    df = table("order_ string, sku string, moment string, quantity string, raw_id bigint, batch_id bigint", rows)
    given = dict(zip([ORDER[name], "sku", MOMENT[name][0], QUANTITY[name], "raw_id", "batch_id"], columns))
    return channel, df.select(*[
        F.col(given[f.name]).alias(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in landing.raw_schema(channel.raw_schema)
    ])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", list(ORDER))
@pytest.mark.parametrize("crowded", [[], ["o2"]])
def test_newest_lines_are_those_of_one_dedupe(table, name, crowded):
    channel, raw = raw_rows(table, name)
    lines = normalize.clean(channel.extract(raw.repartition(7), crowded), channel)
    columns = [c for c in lines.columns if c != "_apart"]
    expected = drop_incomplete(
        dedupe_by_key(lines.select(*columns), normalize.LINE_KEY, channels.LINE_ORDER), normalize.REQUIRED
    )
    got = rows(normalize.newest_lines(lines).select(*columns))
    assert got == rows(expected) and got
    for last in ("1", None):  # the newest row without an order decides, with or without a quantity
        newest = raw.withColumn(ORDER[name], F.lit(None).cast("string")).withColumn(
            QUANTITY[name], F.when(F.col("raw_id") < 299, "3").otherwise(F.lit(last))
        )
        lost = normalize.newest_lines(normalize.clean(channel.extract(newest, crowded), channel)).collect()
        assert [(r.raw_id, r.platform_order_id) for r in lost] == [(299, None)] * (last == "1")


@pytest.mark.parametrize("name", list(ORDER))
def test_numbered_lines_are_moved_once(spark, tmp_path, name):
    channel = channels.CHANNELS[name]
    spark.createDataFrame([], landing.raw_schema(channel.raw_schema)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    lines = normalize.newest_lines(normalize.clean(channel.extract(raw), channel))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    ordered, lost = plan.split("Exchange hashpartitioning(platform_order_id")
    assert ordered.count("REPARTITION_BY_COL") == 1 and f"isnotnull({ORDER[name]}" in ordered
    assert f"isnull({ORDER[name]}" in lost
