"""Large rows are moved as seldom as the work allows, with the same results."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import upsert
from tributary.plans import sample
from tributary.sources import landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


KEEP = [([], [], []), (["v"], [], []), ([], ["at"], []), ([], ["at"], ["at"]), (["v"], [], ["at"])]


@pytest.mark.parametrize(("keep", "order_by", "newer_by"), KEEP)
def test_settled_rows_are_the_merged_ones(table, keep, order_by, newer_by):
    rng = random.Random(7)

    def some(n, first):
        made = {}
        for i in range(n):
            key = (rng.choice(["a", "b", None]), rng.choice([*range(9), None]))
            made[(key, first or i)] = (*key, rng.choice([None, i]), rng.choice([None, 1, 2, 3]) if first else 10 * i, f"x{i}")
        return list(made.values())

    target = table("k string, n int, v int, at int, old string", some(15, True))
    incoming = table("k string, n int, v int, at int, more string", some(40, False)).drop("more")
    keys = ["k", "n"]
    expected = upsert.merge_rows(
        target, upsert.one_per_key(incoming, keys, order_by), keys, keep, newer_by=newer_by
    )
    assert rows(upsert._settled(target, incoming, keys, keep, order_by, newer_by)) == rows(expected)


def test_an_upsert_shuffles_once(table):
    target = table("k string, v int", [("a", 1)])
    incoming = table("k string, v int", [("a", 2), ("a", 3), ("b", 4)])
    merged = upsert._settled(target, incoming, ["k"], [], ["v"], [])
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_rows_are_numbered_where_they_are(spark):
    written = spark.range(100).select("id", F.monotonically_increasing_id().alias("_at"))
    numbered = landing._numbered(written, 5)
    assert "strategy=broadcast" in optimized(numbered)
    assert sorted(r.raw_id for r in numbered.collect()) == list(range(6, 106))


def test_lines_meet_orders_that_have_their_customer(spark, table, tmp_path):
    table("l_orderkey bigint", [(1,), (1,), (2,), (None,)]).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(1, 7), (2, None), (3, 7)]
    table("o_orderkey bigint, o_custkey bigint", orders).write.parquet(str(tmp_path / "orders.parquet"))
    customers = [(7, "x", 1), (7, "y", 1)]
    table("c_custkey bigint, c_name string, c_acctbal int", customers).write.parquet(
        str(tmp_path / "customer.parquet")
    )
    lines = sample.order_lines(spark, str(tmp_path))
    joins = [line for line in optimized(lines).splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "o_custkey" in joins[1]
    assert rows(lines.select("l_orderkey", "c_name")) == [(1, "x"), (1, "x"), (1, "y"), (1, "y")]
