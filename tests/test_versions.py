"""Tables switched by a manifest, dense ids, and arrays read in many splits."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tributary import manifest, schemas
from tributary.operators import upsert
from tributary.plans import channels, daily
from tributary.sources import drops, landing, split_json

COLUMNS = "k string, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- manifests ---------------------------------------------------------------------


def test_a_write_that_fails_half_way_leaves_the_table_as_it_was(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = table(COLUMNS, [(str(i), "old") for i in range(40)])
    upsert.upsert_table(spark, path, first.schema, first, ["k"], buckets=4, noted={"run": 1})

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(manifest, "switch", fail)
    with pytest.raises(OSError):
        upsert.upsert_table(spark, path, first.schema, table(COLUMNS, [("3", "new")]), ["k"], 4, noted={"run": 2})
    monkeypatch.undo()
    assert dict(rows(upsert.read_table(spark, path, first.schema))) == {str(i): "old" for i in range(40)}
    assert upsert.notes(spark, path)["run"] == 1
    upsert.upsert_table(spark, path, first.schema, table(COLUMNS, [("3", "newer")]), ["k"], 4, noted={"run": 3})
    found = dict(rows(upsert.read_table(spark, path, first.schema)))
    assert len(found) == 40 and found["3"] == "newer" and upsert.notes(spark, path)["run"] == 3


def test_a_first_write_that_fails_leaves_an_empty_table(spark, table, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), table(COLUMNS, [("a", "1")])
    monkeypatch.setattr(manifest, "switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        upsert.upsert_table(spark, path, df.schema, df, ["k"])
    assert upsert.read_table(spark, path, df.schema).count() == 0


def test_a_missing_folder_is_an_error(spark, table, tmp_path):
    path, df = str(tmp_path / "t"), table(COLUMNS, [("a", "1"), ("b", "2")])
    upsert.upsert_table(spark, path, df.schema, df, ["k"], buckets=2)
    manifest.remove(spark, f"{path}/{next(iter(manifest.current(spark, path).folders.values()))}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        upsert.read_table(spark, path, df.schema).collect()


def test_two_writers_at_once(spark, table, tmp_path):
    path, df = str(tmp_path / "t"), table(COLUMNS, [("a", "1")])
    upsert.upsert_table(spark, path, df.schema, df, ["k"])
    base = manifest.current(spark, path)
    manifest.switch(spark, path, base, base.folders, base.notes)
    with pytest.raises(manifest.ConcurrentWrite):
        manifest.switch(spark, path, base, {}, {})
    assert upsert.read_table(spark, path, df.schema).count() == 1


def test_old_versions_go_and_their_shared_folders_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    held = manifest.begin(spark, path)
    for number in range(manifest.KEPT + 5):
        name = f"part={number}"
        (tmp_path / "t" / name).mkdir()
        manifest.switch(spark, path, held, {"all": name, "first": "part=0"}, {"n": number})
        held = manifest.current(spark, path)
    left = {p.name for p in (tmp_path / "t").glob("part=*")}
    assert left == {"part=0", *[f"part={n}" for n in range(5, manifest.KEPT + 5)]}
    assert held.notes == {"n": manifest.KEPT + 4} and held.version == manifest.KEPT + 5


def test_an_existing_table_keeps_its_buckets(spark, table, tmp_path):
    path, df = str(tmp_path / "t"), table(COLUMNS, [(str(i), "old") for i in range(30)])
    upsert.upsert_table(spark, path, df.schema, df, ["k"], buckets=3)
    upsert.upsert_table(spark, path, df.schema, df.withColumn("v", F.lit("new")), ["k"], buckets=16)
    assert rows(upsert.read_table(spark, path, df.schema)) == sorted((str(i), "new") for i in range(30))


def test_null_keys_are_one_key(spark, table, tmp_path):
    path, df = str(tmp_path / "t"), table(COLUMNS, [(None, "1"), ("a", "2")])
    upsert.upsert_table(spark, path, df.schema, df, ["k"], buckets=4)
    upsert.upsert_table(spark, path, df.schema, table(COLUMNS, [(None, "3")]), ["k"], buckets=4)
    assert rows(upsert.read_table(spark, path, df.schema)) == [("a", "2"), (None, "3")]


# --- landing -----------------------------------------------------------------------


def test_raw_ids_leave_no_number_out(spark, tmp_path):
    path, schema = str(tmp_path / "raw"), schemas.struct("k string")

    def batch(n):
        return spark.range(n).select(F.col("id").cast("string").alias("k")).repartition(7)

    for number, size in ((1, 100), (2, 0), (3, 55)):
        assert landing.land(spark, batch(size), path, schema, number, order_key=F.col("k")) == size
    got = landing.read_raw(spark, path, schema)
    assert sorted(r.raw_id for r in got.collect()) == list(range(1, 156))
    assert {r.raw_id > 100 for r in got.where("batch_id = 3").collect()} == {True}
    # The last batch again, larger; then an earlier one, no larger, and a larger one.
    landing.land(spark, batch(60), path, schema, 3)
    assert sorted(r.raw_id for r in landing.read_raw(spark, path, schema).collect()) == list(range(1, 161))
    landing.land(spark, batch(90), path, schema, 1)
    ids = [r.raw_id for r in landing.read_raw(spark, path, schema, upto=1).collect()]
    assert sorted(ids) == list(range(1, 91))
    landing.land(spark, batch(120), path, schema, 1)
    every = [r.raw_id for r in landing.read_raw(spark, path, schema).collect()]
    assert len(every) == len(set(every)) == 180


def test_a_landing_that_fails_leaves_the_source_as_it_was(spark, table, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "raw"), schemas.struct("k string")
    landing.land(spark, table("k string", [("a",)]), path, schema, 1)
    monkeypatch.setattr(manifest, "switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.land(spark, table("k string", [("b",)]), path, schema, 1)
    assert [r.k for r in landing.read_raw(spark, path, schema).collect()] == ["a"]


def test_crowded_orders_are_noted_and_numbered_alike(spark, tmp_path):
    path = str(tmp_path / "raw")
    names = schemas.AMAZON_SHIPMENTS.names
    rng = random.Random(2)
    lines = [(rng.choice(["big", "big", "o1", "o2", None]), rng.choice(["s", "t", None])) for _ in range(400)]
    df = spark.createDataFrame(lines, "amazon_order_id string, sku string")
    full = df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])
    for number in (1, 2):
        landing.land(spark, full.repartition(3), path, schemas.AMAZON_SHIPMENTS, number,
                     order_key=F.col("amazon_order_id"), crowd=150)
    assert landing.crowded_orders(spark, path) == ["big"]
    raw = landing.read_raw(spark, path, schemas.AMAZON_SHIPMENTS)
    one = channels.extract_amazon(raw).select("raw_id", "platform_line_id")
    many = channels.extract_amazon(raw, ["big"]).select("raw_id", "platform_line_id")
    assert rows(one) == rows(many)
    assert {r.platform_line_id for r in one.join(raw.where("amazon_order_id IS NULL"), "raw_id").collect()} == {None}


def test_numbered_lines_read_their_source_once(spark, tmp_path):
    spark.createDataFrame([], landing.raw_schema(schemas.AMAZON_SHIPMENTS)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = channels.extract_amazon(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


# --- affected orders ---------------------------------------------------------------


def _amazon(spark, orders, day):
    names = schemas.AMAZON_SHIPMENTS.names
    full = spark.createDataFrame([(o,) for o in orders], "amazon_order_id string").select(
        *[F.col(n) if n == "amazon_order_id" else F.lit(day).alias(n) for n in names]
    )
    return full


def test_earlier_rows_come_from_touched_buckets_alone(spark, tmp_path):
    store = daily.Store(spark, str(tmp_path / "w"), buckets=16)
    channel = channels.AMAZON
    path = store.raw_path(channel)
    for number, orders in ((1, [f"o{i}" for i in range(200)]), (2, ["o7", "new", None])):
        landing.land(spark, _amazon(spark, orders, str(number)), path, channel.raw_schema, number,
                     order_key=channel.order_key(), buckets=store.buckets)
    affected = daily.affected_raw(store, channel, 1)
    assert rows(affected.select("batch_id", "amazon_order_id")) == [(1, "o7"), (2, "new"), (2, "o7"), (2, None)]
    plan = affected._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[[^\]]*order_bucket#\d+L? (?:=|IN) \(?([\d, ]+)", plan)
    assert pruned and all(len(p.split(",")) <= 2 for p in pruned)
    stale = spark.createDataFrame([("amazon", "o9"), ("pos", "o11")], "source_platform string, _order string")
    again = daily.affected_raw(store, channel, 1, stale)
    assert {r.amazon_order_id for r in again.collect()} == {"o7", "o9", "new", None}


# --- arrays in many splits -----------------------------------------------------------

ODD = [
    {"id": 1, "text": 'a } b { c ] d [ "results":[ e \\'},
    {"id": 2, "n": {"results": [{"id": 20}, {"x": []}], "deep": [[{"y": "}"}], {}]}},
    {"id": 3, "quote": '"', "slash": "\\\\", "both": '\\"}', "é": "ü}日本"},
    {},
    {"id": 5, "empty": [], "none": None, "no": -1.5e3, "yes": True},
]


def _split_reader(spark, path, wrapper, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return split_json.elements(spark, path, wrapper).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("size", "indent"), [(40, None), (90, 2), (1 << 20, None), (700, None)])
def test_elements_are_those_of_the_whole_file(spark, tmp_path, size, indent):
    rng = random.Random(size)
    documents = [rng.choice(ODD) | {"i": i} for i in range(60)]
    other = [{"id": -1, "results": [{"no": 1}]}]
    whole = {"results2": other, "paging": {"total": 3, "results": [{"no": 2}]}, "s": "results",
             "results": documents, "filters": other, "tail": {"results": other}}
    path = tmp_path / "d"
    path.mkdir()
    (path / "a.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=False) + "\n")
    (path / "b.json").write_text(json.dumps({"results": documents[:3]}))
    (path / "c.json").write_text('{"results": [], "x": [{"id": 1}]}')
    found = _split_reader(spark, str(path), "results", size)
    by_file = {}
    for r in sorted(found, key=lambda r: r.file_row):
        by_file.setdefault(r.source_file, []).append((r.file_row, json.loads(r.payload)))
    assert by_file == {"a.json": list(enumerate(documents)), "b.json": list(enumerate(documents[:3]))}


def test_many_splits_are_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"orders": [{"id": i, "pad": "x" * 50} for i in range(500)]}))
    found = _split_reader(spark, str(path), "orders", 4000)
    assert len({r.file_block for r in found}) > 5
    large = drops.wrapped_json(spark, str(path), "orders", whole_bytes=1000)
    small = drops.wrapped_json(spark, str(path), "orders")
    columns = ["order_id", "source_file", "file_row"]
    assert rows(large.select(*columns)) == rows(small.select(*columns))


@pytest.mark.parametrize("text", ['{"orders": [{"id": 1}, {"id": 2}', '{"orders": [{"id": "1}]}', '{"orders": [{"id": 1},, {"id" 2}]}'])
def test_a_broken_file_fails(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="JSON"):
        split_json.elements(spark, str(tmp_path / "d.json"), "orders").collect()


def test_a_file_of_some_megabytes_is_no_single_row(spark, tmp_path):
    """A row of a whole file takes many times the file's size of one task's memory."""
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"orders": [{"id": i, "pad": "x" * 5000} for i in range(2000)]}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 << 20))
    try:
        found = drops.wrapped_json(spark, str(path), "orders").select("order_id", "file_block", "file_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r.file_block for r in found}) > 1
    assert sorted((r.order_id, r.file_row) for r in found) == [(i, i) for i in range(2000)]
