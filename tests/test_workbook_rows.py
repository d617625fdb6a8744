"""Workbooks written by column and read without the XML parser: the same cells as with it."""

import io
import zipfile

import pyarrow as pa
import pytest

from tributary.plans import sample
from tributary.sources import workbook as books

MAIN = books.MAIN[1:-1]
TEXT = '<c t="inlineStr"><is><t xml:space="preserve">{}</t></is></c>'


def sheet(rows, root=f'<worksheet xmlns="{MAIN}">', behind="</sheetData></worksheet>"):
    return f"{root}<sheetData>{rows}{behind}".encode()


def rows_of(blocks):
    return [list(row) for size, columns in blocks for row in zip(*[c.to_pylist() for c in columns])]


def padded(rows):
    width = max(map(len, rows))
    return [row + [None] * (width - len(row)) for row in rows]


SHEETS = {
    "alike": "<row><c><v>1</v></c><c/>" + TEXT.format("a &amp;lt; &lt;b&gt;") + "</row><row><c/><c><v>-2</v></c><c/></row>",
    "references": '<row r="1" spans="1:3"><c r="A1" s="2" t="s"><v>0</v></c><c r="C1"><v>1.50</v></c></row>',
    "kinds": '<row><c t="b"><v>1</v></c><c t="e"><v>#REF!</v></c><c t="str"><v>x</v></c><c t="inlineStr"/></row>',
    "lengths": "<row><c><v>1</v></c></row><row></row><row><c/><c><v>2</v></c></row>",
    "rich": "<row><c t=\"inlineStr\"><is><r><t>a</t></r><r><t>b</t></r></is></c><c><f>1+1</f><v>2</v></c></row>",
    "entities": "<row>" + TEXT.format("&#233;&quot;&apos;") + "</row>",
}


@pytest.mark.parametrize("name", SHEETS)
def test_plain_rows_are_what_the_parser_finds(name):
    xml, shared = sheet(SHEETS[name]), ["shared"]
    expected = padded(list(books._parsed_rows(io.BytesIO(xml), shared)))
    assert rows_of(books._plain_blocks(io.BytesIO(xml), shared)) == expected


@pytest.mark.parametrize(
    "xml",
    [
        sheet("<row><!-- no row --><c><v>1</v></c></row>"),
        sheet("<row>" + TEXT.format("<![CDATA[</row>]]>") + "</row>"),
        sheet("<row>" + TEXT.format("a\r\nb") + "</row>"),
        sheet('<row r="1"/><row><c><v>1</v></c></row>'),
        f'<x:worksheet xmlns:x="{MAIN}"><x:sheetData><x:row/></x:sheetData></x:worksheet>'.encode(),
        sheet("<row><c><v>1</v></c></row>", behind="</sheetData>"),
        f'<?xml version="1.0" encoding="UTF-16"?><worksheet xmlns="{MAIN}"><sheetData></sheetData></worksheet>'.encode("utf-16"),
    ],
)
def test_an_unusual_sheet_is_left_to_the_parser(xml):
    with pytest.raises(books._Unusual):
        list(books._plain_blocks(io.BytesIO(xml), []))


def test_a_sheet_that_turns_unusual_keeps_its_rows(monkeypatch):
    monkeypatch.setattr(books, "BLOCK", 100)
    rows = "".join(f"<row><c><v>{i}</v></c></row>" for i in range(20))
    content = io.BytesIO(sample.workbook_bytes([], []))
    with zipfile.ZipFile(content) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = sheet(rows + "<row><!-- --><c><v>20</v></c></row>")
    with zipfile.ZipFile(content, "w") as book:
        for name, xml in parts.items():
            book.writestr(name, xml)
    found = rows_of(books.sheet_blocks(content.getvalue(), "Ventas"))
    assert found == [[str(i)] for i in range(21)]


def test_plain_sheets_do_not_reach_the_parser(monkeypatch):
    def parsed(*_):
        raise AssertionError("parsed row by row")

    monkeypatch.setattr(books, "_parsed_rows", parsed)
    monkeypatch.setattr(books, "_row_cells", parsed)
    content = sample.workbook_bytes(["a", "b"], [("x & <y>", 3), (None, None)])
    assert rows_of(books.sheet_blocks(content, "Ventas")) == [["a", "b"], ["x & <y>", "3"], [None, None]]


def test_packed_columns_are_the_same_workbook():
    rows = [("1", "a&b<c>", -3), (None, "ñ", None), ("", None, 0)]
    batch = pa.RecordBatch.from_pydict({n: list(c) for n, c in zip("xyz", zip(*rows))})
    headers = {"X & 1": "x", "Y": "y", "Z": "z"}

    def xml(content):
        return zipfile.ZipFile(io.BytesIO(content)).read("xl/worksheets/sheet1.xml")

    assert xml(sample._packed(batch, headers)) == xml(sample.workbook_bytes(list(headers), rows))
    assert xml(sample._packed(batch.slice(1, 1), headers)) == xml(sample.workbook_bytes(list(headers), rows[1:2]))
