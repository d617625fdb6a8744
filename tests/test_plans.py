"""The plans Spark makes of the composite jobs."""

import re

import pytest

from tributary import schemas
from tributary.operators.ordering import dedupe_by_key
from tributary.operators.upsert import read_table, upsert_table
from tributary.plans import channels, queries, sample
from tributary.plans.normalize import normalize

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_raw(spark, tmp_path_factory):
    """Raw rows as a landing stores them, without the plan that made them."""
    base = tmp_path_factory.mktemp("raw")
    for name, build in sample.RAW.items():
        build(spark, SF).write.parquet(str(base / name))
    return lambda name: spark.read.parquet(str(base / name))


@pytest.mark.parametrize("name", ["shopify", "mercadolibre", "pos"])
def test_a_channel_shuffles_its_rows_once(spark, stored_raw, name):
    plan = physical(normalize(stored_raw(name), channels.CHANNELS[name], queries.reference(spark, SF)))
    rows = [line for line in plan.splitlines() if "Exchange hashpartitioning(platform_order_id" in line]
    assert len(rows) == 1
    assert not re.search("SortMergeJoin|CartesianProduct|NestedLoopJoin", plan)


@pytest.mark.parametrize("name", list(sample.RAW))
def test_no_python_in_normalization(spark, stored_raw, name):
    plan = physical(normalize(stored_raw(name), channels.CHANNELS[name], queries.reference(spark, SF)))
    assert not re.search(r"Python|MapInPandas|ArrowEval", plan)


@pytest.mark.parametrize("name", ["shopify", "mercadolibre"])
def test_a_document_is_parsed_once(spark, stored_raw, name):
    plan = physical(normalize(stored_raw(name), channels.CHANNELS[name], queries.reference(spark, SF)))
    assert plan.count("from_json(") == 1


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark):
    lines = sample.table(spark, SF, "lineitem")
    plan = physical(dedupe_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    final, partial = plan.index(", 1, Final"), plan.index(", 1, Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_revenue_reads_only_the_columns_it_needs(spark):
    plan = physical(queries.QUERIES["revenue_monthly"](spark, SF))
    scans = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert all("l_discount" not in s and "l_linestatus" not in s for s in scans)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_watermark_reaches_the_scan(spark):
    plan = physical(queries.QUERIES["high_watermark_batch"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts", plan)


def test_upsert_reads_touched_buckets_only(spark, table, tmp_path):
    path = str(tmp_path / "t")
    schema = schemas.struct("k string, key_bucket int")
    df = table("k string", [(str(i),) for i in range(50)])
    upsert_table(spark, path, df.schema, df, ["k"], buckets=8)
    pruned = read_table(spark, path, schema).where("key_bucket IN (3)")
    assert re.search(r"PartitionFilters: \[[^\]]*key_bucket", physical(pruned))
