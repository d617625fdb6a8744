import json
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary import schemas
from tributary.plans.sample import workbook_bytes
from tributary.sources import drops, landing
from tributary.sources.workbook import workbook

HEADER = list(drops.TIENDANUBE_HEADERS)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_wrapped_json_keeps_elements_verbatim(spark, tmp_path):
    orders = [{"id": 7, "currency": None}, {"id": 8, "line_items": [1]}, {"x": 1}]
    path = write(tmp_path / "shopify.json", json.dumps({"orders": orders}, indent=2))
    rows = drops.wrapped_json(spark, path, "orders").orderBy("file_row").collect()
    assert [r.order_id for r in rows] == [7, 8, None]
    assert [json.loads(r.payload) for r in rows] == orders
    assert {r.source_file for r in rows} == {"shopify.json"}


def test_wrapped_json_without_wrapper_or_elements(spark, tmp_path):
    write(tmp_path / "d" / "a.json", '{"results": []}')
    write(tmp_path / "d" / "b.json", '{"other": [1]}')
    assert drops.wrapped_json(spark, str(tmp_path / "d"), "results").count() == 0


def test_broken_json_fails(spark, tmp_path):
    path = write(tmp_path / "broken.json", '{"orders": [')
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        drops.wrapped_json(spark, path, "orders").collect()


def test_absent_drops_are_empty(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    frames = [
        drops.wrapped_json(spark, nowhere, "orders"),
        drops.verbatim_tsv(spark, nowhere, drops.AMAZON_HEADERS),
        workbook(spark, nowhere),
        drops.table_snapshot(spark, nowhere, schemas.POS_VENTAS),
    ]
    assert [f.count() for f in frames] == [0] * 4
    assert frames[0].columns[:2] == schemas.JSON_ORDERS.names
    assert frames[3].columns == schemas.POS_VENTAS.names


def test_tsv_is_verbatim(spark, tmp_path):
    values = ["1", "", "NA", " 3 ", "null", '"a\tb"', '"say ""x"""', "-1", "USD", "1,299.90"]
    lines = ["\t".join(drops.AMAZON_HEADERS), "\t".join(values + [""] * 5)]
    path = write(tmp_path / "report.tsv", "\n".join(lines) + "\n")
    row = drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS).first()
    assert list(row)[:10] == ["1", None, "NA", " 3 ", "null", "a\tb", 'say "x"', "-1", "USD", "1,299.90"]
    assert row.ship_state is None and row.source_file == "report.tsv"


def test_tsv_columns_are_found_by_name_in_each_file(spark, tmp_path):
    headers = list(drops.AMAZON_HEADERS)
    turned = [headers[1], "note", headers[0], *headers[2:]]
    write(tmp_path / "r" / "a.tsv", "\t".join(headers) + "\n" + "\t".join(f"a{i}" for i in range(15)) + "\n")
    lines = ["\t".join(turned), "\t".join(["b1", "n", "b0", *[f"b{i}" for i in range(2, 15)]]), "c1\tn\tc0"]
    write(tmp_path / "r" / "b.tsv", "\n".join([*lines, "", lines[0]]) + "\n")
    rows = drops.verbatim_tsv(spark, str(tmp_path / "r"), drops.AMAZON_HEADERS).collect()
    assert sorted((r.source_file, r.amazon_order_id, r.merchant_order_id, r.ship_state) for r in rows) == [
        ("a.tsv", "a0", "a1", "a14"), ("b.tsv", "b0", "b1", "b14"), ("b.tsv", "c0", "c1", None),
    ]


def test_tsv_without_a_column_fails_with_its_name(spark, tmp_path):
    headers = ["other" if h == "item-tax" else h for h in drops.AMAZON_HEADERS]
    path = write(tmp_path / "report.tsv", "\t".join(headers) + "\n" + "\t".join("x" * 15) + "\n")
    with pytest.raises(ValueError, match="report.tsv: column missing: item-tax"):
        drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS)


def test_workbook_cells_as_text(spark, tmp_path):
    rows = [
        ("3001", "15/03/2024", "Pagado", None, "Ana & Co", "N/A", " tn 1 ", "Polo", 2, 19.5, "null", "39.00", "PEN"),
        (None,) * 13,
        (3002, "16/03/2024", "Pagado", "x", "NA", "", "tn 2", "Polo", 2.0, "10", 0, "20", None),
    ]
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(HEADER, rows))
    got = workbook(spark, str(tmp_path)).orderBy("file_row").collect()
    assert [tuple(r)[:13] for r in got] == [
        ("3001", "15/03/2024", "Pagado", None, "Ana & Co", None, " tn 1 ", "Polo", "2", "19.5", None, "39.00", "PEN"),
        ("3002", "16/03/2024", "Pagado", "x", None, None, "tn 2", "Polo", "2", "10", "0", "20", None),
    ]


def test_workbook_shared_strings_and_references(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    content = workbook_bytes(HEADER, [])
    target = tmp_path / "b.xlsx"
    target.write_bytes(content)
    with zipfile.ZipFile(target) as book:
        parts = {n: book.read(n).decode() for n in book.namelist()}
    parts["xl/sharedStrings.xml"] = (
        f'<sst xmlns="{main}"><si><t>SKU</t></si><si><r><t>tn</t></r><r><t> 9</t></r></si></sst>'
    )
    parts["xl/worksheets/sheet1.xml"] = (
        f'<worksheet xmlns="{main}"><sheetData>'
        '<row r="1"><c r="A1" t="inlineStr"><is><t>Cantidad</t></is></c><c r="C1" t="s"><v>0</v></c></row>'
        '<row r="2"><c r="C2" t="s"><v>1</v></c></row>'
        '<row r="3"><c r="A3"><v>4</v></c><c r="AB3"><v>1</v></c></row>'
        "</sheetData></worksheet>"
    )
    with zipfile.ZipFile(target, "w") as book:
        for name, xml in parts.items():
            book.writestr(name, xml)
    got = workbook(spark, str(target)).orderBy("file_row").collect()
    assert [(r.sku, r.cantidad) for r in got] == [("tn 9", None), (None, "4")]


def test_workbook_whole_numbers_and_error_cells():
    from xml.etree import ElementTree as ET

    from tributary.sources.workbook import MAIN, _cell_text

    def text(kind, value):
        cell = ET.Element(f"{MAIN}c", {"t": kind} if kind else {})
        ET.SubElement(cell, f"{MAIN}v").text = value
        return _cell_text(cell, [])

    assert text(None, "98765432109876543") == "98765432109876543"
    assert text("n", "-40") == "-40" and text("n", "6.50") == "6.5" and text("n", "3E2") == "300"
    assert text("e", "#REF!") is None and text("str", "#5") == "#5"


def test_landing_appends_batches_and_replaces_a_repeated_one(spark, table, tmp_path):
    path = str(tmp_path / "raw")
    schema = schemas.struct("k string")

    def rows(*keys):
        return table("k string, source_file string", [(k, "f") for k in keys])

    assert landing.land(spark, rows("a", "b"), path, schema, 1) == 2
    assert landing.land(spark, rows("a"), path, schema, 2) == 1
    first = {(r.batch_id, r.k): r.raw_id for r in landing.read_raw(spark, path, schema).collect()}
    assert len(set(first.values())) == 3
    assert first[(2, "a")] > max(first[(1, "a")], first[(1, "b")])
    assert landing.land(spark, rows("c"), path, schema, 2) == 1
    again = {(r.batch_id, r.k) for r in landing.read_raw(spark, path, schema).collect()}
    assert again == {(1, "a"), (1, "b"), (2, "c")}
    assert landing.land(spark, rows(), path, schema, 2) == 0
    left = {(r.batch_id, r.k) for r in landing.read_raw(spark, path, schema).collect()}
    assert left == {(1, "a"), (1, "b")}
    assert landing.land(spark, rows("d"), path, schema, 3) == 1


def test_a_first_batch_may_be_empty(spark, table, tmp_path):
    path, schema = str(tmp_path / "raw"), schemas.struct("k string")
    empty = table("k string, source_file string", [])
    assert landing.land(spark, empty, path, schema, 1) == 0
    assert landing.read_raw(spark, path, schema).count() == 0


def test_ids_follow_the_position_in_a_file_read_in_many_splits(spark, tmp_path):
    rows = [f"{i}\t" + "\t".join(["x" * 20] * 14) for i in range(3000)]
    path = write(tmp_path / "r.tsv", "\n".join(["\t".join(drops.AMAZON_HEADERS), *rows]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = drops.verbatim_tsv(spark, path, drops.AMAZON_HEADERS)
        assert read.rdd.getNumPartitions() > 4
        landing.land(spark, read, str(tmp_path / "raw"), schemas.AMAZON_SHIPMENTS, 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    landed = landing.read_raw(spark, str(tmp_path / "raw"), schemas.AMAZON_SHIPMENTS)
    ordered = [int(r[0]) for r in landed.orderBy("raw_id").select("amazon_order_id").collect()]
    assert ordered == list(range(3000))


def test_watermark_is_strict_and_in_wall_time(table):
    times = [datetime(2024, 3, 15, 10), datetime(2024, 3, 15, 11), None]
    rows = table("fecha timestamp_ntz", [(t,) for t in times])
    mark = F.lit("2024-03-15 15:00:00").cast("timestamp")
    newer = drops.newer_than(rows, "fecha", mark, "America/Lima").collect()
    assert [r.fecha for r in newer] == [datetime(2024, 3, 15, 11)]
    assert drops.newer_than(rows, "fecha", None, "America/Lima").count() == 3
    again = drops.newer_than(rows, "fecha", mark, "America/Lima", timedelta(minutes=1))
    assert again.count() == 2
    newest = drops.data_watermark(rows, "fecha", "America/Lima").first()[0]
    assert newest == datetime(2024, 3, 15, 16)
    assert drops.data_watermark(rows.where("false"), "fecha", "America/Lima").first()[0] is None
