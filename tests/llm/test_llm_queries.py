"""The registered training-data queries against their SQL on the small tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import TABLES, sorted_rows
from tributary.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    got = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(got[1]) > 0
    if name in oracle.QUERIES:
        db = duckdb.connect()
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = db.execute(oracle.QUERIES[name])
        assert got == sorted_rows([c[0] for c in result.description], result.fetchall())


def test_hosts_paths_and_rules_of_urls_equal_sql(spark):
    """What op4 takes from the url alone; its verdicts without a rule are beyond SQL."""
    found = queries.op4_url_filter(spark, SF)
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in found.collect())
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p in sorted(
            ((rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]) for _, rule in queries.URL_RULES),
            key=lambda r: -len(r[0] + r[1]),
        )
    )
    rows = duckdb.sql(rf"""
      WITH p AS (SELECT page_id,
          coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
          coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM '{SF}/pages.parquet')
      SELECT page_id, host, path, CASE {cases} END AS rule FROM p""").fetchall()
    assert got == sorted(rows)


def test_pages_do_not_move_to_meet_the_rules(spark):
    from pyspark.sql import functions as F

    from tributary.llm import url_filter

    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path")
    )
    rules = url_filter.rule_table(spark, queries.URL_RULES)
    plan = url_filter.match_rules(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
