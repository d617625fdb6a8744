"""Workbook source: one sheet per file, decoded in parallel over the files.

A workbook is a zip of XML parts and cannot be split, but a sheet holds at most
1,048,576 rows, which bounds what one task decodes. Rows of plain cells, as most
programs write them, are matched by one expression; any other row, and a sheet of
any other make, goes through the XML parser, with the same result.
"""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree as ET

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .drops import POSITION, TIENDANUBE_HEADERS, present_or_empty

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
BATCH_ROWS = 10_000
BLOCK = 1 << 20  # bytes of a sheet looked at in one go

# A cell as most programs write it: its column, kind, inline text and value.
PLAIN_CELL = re.compile(
    r'<c(?: r="([A-Z]+)[0-9]+")?(?: s="[0-9]+")?(?: t="([A-Za-z]+)")?'
    r'(?:/>|>(?:<is><t(?: xml:space="preserve")?>([^<]*)</t></is>|<v>([^<]+)</v>)?</c>)'
)
PLAIN_ROW = re.compile(r'\s*<row(?:\s+[\w:.-]+="[^"<>&]*")*\s*>')
PLAIN_HEAD = re.compile(
    r'\s*(?:<\?xml version="1.0"(?: encoding="(?:UTF|utf)-8")?(?: standalone="(?:yes|no)")?\s*\?>)?\s*'
    r'(<worksheet(?:\s+[\w:.-]+="[^"<>&]*")*\s*>)(?:[^!]*>)?\s*<sheetData>'
)
ENTITY = re.compile("&(amp|lt|gt|quot|apos);")
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
INLINE = ['<c t="inlineStr"><is><t>', '<c t="inlineStr"><is><t xml:space="preserve">']
INLINE_END = "</t></is>"
# Characters that XML forbids or changes.
ODD_BYTES = bytes(i for i in range(32) if i not in b"\t\n")

# Cell texts that stand for an empty cell.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _text_of(element: ET.Element) -> str:
    return "".join(part.text or "" for part in element.iter(f"{MAIN}t"))


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _number_text(raw: str) -> str:
    if re.fullmatch(r"-?\d+", raw):
        return raw  # ids may have more digits than a float holds
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _cell_text(cell: ET.Element, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text_of(cell)
    return _value_text(kind, cell.findtext(f"{MAIN}v"), shared)


def _value_text(kind: str, raw: str | None, shared: list[str]) -> str | None:
    if raw is None or kind == "e":  # an error, such as a division by zero, is no value
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    return _number_text(raw) if kind == "n" else raw


# A number of rows and their columns, as many as the widest row has.
Block = tuple[int, list[pa.Array]]


def sheet_blocks(content: bytes, sheet: str) -> Iterator[Block]:
    """The rows of one sheet as columns of text, some at a time, header first."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            strings = ET.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_text_of(item) for item in strings.iter(f"{MAIN}si")]
        sheets = ET.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        relation = {s.get("name"): s.get(RELATION) for s in sheets}[sheet]
        targets = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in targets}[relation]
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        done = 0
        try:
            with book.open(part) as xml:
                for block in _plain_blocks(xml, shared):
                    yield block
                    done += block[0]
        except _Unusual:
            with book.open(part) as xml:
                rows = islice(_parsed_rows(xml, shared), done, None)
                while some := list(islice(rows, BATCH_ROWS)):
                    yield _columns(some)


def _columns(rows: list[list[str | None]]) -> Block:
    width = max(map(len, rows))
    return len(rows), [pa.array([r[i] if i < len(r) else None for r in rows], pa.string()) for i in range(width)]


class _Unusual(Exception):
    """A sheet that is not made of plain rows alone."""


def _by_place(cells: dict[int, str | None]) -> list[str | None]:
    return [cells.get(i) for i in range(max(cells, default=-1) + 1)]


def _row_cells(row: ET.Element, shared: list[str]) -> list[str | None]:
    cells: dict[int, str | None] = {}
    for place, cell in enumerate(row.iter(f"{MAIN}c")):
        reference = cell.get("r")
        column = _column_number(reference) if reference else place
        cells[column] = _cell_text(cell, shared)
    return _by_place(cells)


def _parsed_rows(xml: io.BufferedIOBase, shared: list[str]) -> Iterator[list[str | None]]:
    table = None
    for event, row in ET.iterparse(xml, events=("start", "end")):
        if event == "start" and row.tag == f"{MAIN}sheetData":
            table = row
        if event == "start" or row.tag != f"{MAIN}row":
            continue
        yield _row_cells(row, shared)
        table.clear()  # rows read are not kept


def _plain_blocks(xml: io.BufferedIOBase, shared: list[str]) -> Iterator[Block]:
    """The rows of a sheet without comments, prefixes and the like."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    text, root = "", None
    while block := xml.read(BLOCK):
        if len(block.translate(None, ODD_BYTES)) < len(block):
            raise _Unusual
        try:
            text += decoder.decode(block)
        except UnicodeDecodeError:
            raise _Unusual from None
        if root is None:
            head = PLAIN_HEAD.match(text)
            if head is None or f'xmlns="{MAIN[1:-1]}"' not in head[1]:
                raise _Unusual
            root, text = head[1], text[head.end() :]
        if "<!" in text or "<?" in text or "]]>" in text or "\ufffe" in text or "\uffff" in text:
            raise _Unusual
        *whole, text = text.split("</row>")
        if whole:
            columns = _uniform(whole)
            yield (len(whole), columns) if columns else _columns([_plain_row(row, root, shared) for row in whole])
    if root is None or not re.fullmatch(r"\s*</sheetData>(?:.*>)?\s*</worksheet>\s*", text, re.DOTALL):
        raise _Unusual


def _uniform(rows: list[str]) -> list[pa.Array] | None:
    """Columns of rows with as many cells each: inline texts, whole numbers and empty ones. None if any is other."""
    marked = pc.replace_substring(pa.array(rows, pa.large_string()), "<c/>", "<c></c>")
    cells = pc.split_pattern(marked, "</c>")
    sizes = pc.unique(pc.list_value_length(cells))
    if len(sizes) > 1 or not pc.all(pc.starts_with(marked, "<row>")).as_py():
        return None
    size, flat = sizes[0].as_py(), cells.flatten()
    nth = np.arange(len(rows)) * size
    if not pc.all(pc.equal(flat.take(nth + size - 1), "")).as_py():
        return None
    before, found = INLINE[INLINE[1] in rows[0]], []
    for i in range(size - 1):
        cell = flat.take(nth + i)
        if i == 0:
            cell = pc.utf8_slice_codeunits(cell, len("<row>"))
        text = pc.and_(pc.starts_with(cell, before), pc.ends_with(cell, INLINE_END))
        text = pc.and_(text, pc.equal(pc.count_substring(cell, "<"), (before + INLINE_END).count("<")))
        values = pc.if_else(text, pc.utf8_slice_codeunits(cell, len(before), -len(INLINE_END)), None)
        other = pc.invert(text)
        if pc.any(other).as_py():
            whole = pc.match_substring_regex(cell, "^<c><v>-?[0-9]+</v>$")
            if not pc.all(pc.or_(pc.or_(text, whole), pc.equal(cell, "<c>"))).as_py():
                return None
            values = pc.if_else(whole, pc.utf8_slice_codeunits(cell, len("<c><v>"), -len("</v>")), values)
        signs = pc.sum(pc.count_substring(values, "&")).as_py()
        if signs:
            if signs != pc.sum(pc.count_substring_regex(values, ENTITY.pattern)).as_py():
                return None
            for name in ("lt", "gt", "quot", "apos", "amp"):
                values = pc.replace_substring(values, f"&{name};", ENTITIES[name])
        found.append(values.cast(pa.string()))
    return found


def _plain_row(row: str, root: str, shared: list[str]) -> list[str | None]:
    start = PLAIN_ROW.match(row)
    if start is None:
        raise _Unusual
    found = PLAIN_CELL.findall(row, start.end())
    if len(found) != row.count("<c") or row.count("&") != len(ENTITY.findall(row)):
        try:
            return _row_cells(ET.fromstring(f"{root}{row}</row></worksheet>")[0], shared)
        except ET.ParseError:
            raise _Unusual from None
    if "&" in row:
        found = [tuple(ENTITY.sub(lambda m: ENTITIES[m[1]], part) for part in cell) for cell in found]
    texts = [
        inline if kind == "inlineStr" else _value_text(kind or "n", value or None, shared)
        for _, kind, inline, value in found
    ]
    if not any(cell[0] for cell in found):
        return texts
    return _by_place({_column_number(c[0]) if c[0] else i: text for i, (c, text) in enumerate(zip(found, texts))})


def decode_workbooks(files: DataFrame, sheet: str, headers: dict[str, str]) -> DataFrame:
    """``files`` (``path``, ``content``) to one text row per sheet row."""
    names = list(headers.values())
    schema = T.StructType(
        [*(T.StructField(n, T.StringType()) for n in names), *POSITION.fields]
    )

    fields = pa.schema(
        [*((n, pa.string()) for n in [*names, "source_file"]), ("file_block", pa.int64()), ("file_row", pa.int32())]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                file, place, first = path.as_py().rsplit("/", 1)[-1], None, 0
                for size, columns in sheet_blocks(content.as_buffer(), sheet):
                    if place is None:
                        header = [column[0].as_py() for column in columns]
                        place = {headers[h]: i for i, h in enumerate(header) if h in headers}
                        size, columns = size - 1, [column[1:] for column in columns]
                    held = [columns[place[n]] if place.get(n, len(columns)) < len(columns) else None for n in names]
                    position = [[file] * size, [0] * size, range(first, first + size)]
                    given = zip([*held, *position], fields)
                    yield pa.record_batch(
                        [
                            c if isinstance(c, pa.Array) else pa.array([None] * size if c is None else c, f.type)
                            for c, f in given
                        ],
                        fields,
                    )
                    first += size

    rows = files.select("path", "content").mapInArrow(decode, schema)
    blanked = {n: F.when(~F.col(n).isin(NULL_TOKENS), F.col(n)) for n in names}
    empty = F.coalesce(*[F.col(n) for n in names]).isNull()
    return rows.withColumns(blanked).where(~empty)


def workbook(
    spark: SparkSession,
    path: str,
    sheet: str = "Ventas",
    headers: dict[str, str] | None = None,
) -> DataFrame:
    """Workbooks below ``path``; all columns text, the usual null tokens null."""
    headers = headers or TIENDANUBE_HEADERS
    schema = T.StructType([T.StructField(n, T.StringType()) for n in headers.values()])

    def read() -> DataFrame:
        return decode_workbooks(
            spark.read.format("binaryFile").load(path), sheet, headers
        )

    return present_or_empty(spark, read, schema)
