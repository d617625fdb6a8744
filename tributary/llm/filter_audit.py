"""Interaction of filters over all their orders; duplicates are found by radix text tries.

A task inserts its texts into compressed tries. A terminal holds the least id of
its text, so copies that a task sees are decided there and their texts go no
further: a text that a third of all rows share is sent once for each ``CHUNK`` of
input. The tries also name, at even distances in text order, the shortest prefixes
that part neighbouring texts; these adaptive prefixes cut all texts into ranges.
Each range is sorted and inserted, run after run, into tries of bounded size,
whose terminals now hold the least id of all. A document then is a mask of the
filters it fails. Masks are counted per part, and since what a filter removes in
an order depends on the mask alone, all orders follow from these counts.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..literals import literal_table
from ..schemas import struct
from .storage import partitions, stored

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
CHUNK = 32 << 20  # bytes of text in one trie
STEP = 1 << 15  # bytes of text between two range bounds that a trie names
BOUNDS = 32  # bounds gathered for each range
LONG = 1 << 20  # bytes; longer texts are cut into words piece by piece

BREAK = re.compile(rb"[\x20\x09-\x0D]")
SYMBOL = re.compile(rb"[#$%&*|]")
UPPER = bytes(range(0x41, 0x5B))
CONTINUED = bytes(range(0x80, 0xC0))


class Limits(NamedTuple):
    """Where the filters A, B and C draw their lines."""

    words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10


class Node:
    __slots__ = ("children", "label", "terminal")

    def __init__(self, label: bytes):
        self.label, self.children, self.terminal = label, {}, None


class Terminal:
    """A text in the trie: the least id seen and its rows."""

    __slots__ = ("least", "rows", "text")

    def __init__(self, text: bytes):
        self.text, self.least, self.rows = text, None, []


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` agree with ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """A compressed trie of whole texts, with the least id of each at its terminal."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, text: bytes, doc_id: int) -> Terminal:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(text) - at
                node = child
                break
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = _shared(child.label, text, at)
            parting = Node(child.label[:shared])
            child.label = child.label[shared:]
            parting.children[child.label[0]] = child
            node.children[text[at]] = parting
            node, at = parting, at + shared
        if node.terminal is None:
            node.terminal = Terminal(text)
        terminal = node.terminal
        if terminal.least is None or doc_id < terminal.least:
            terminal.least = doc_id
        return terminal

    def traverse(self) -> Iterator[tuple[Terminal, int]]:
        """Terminals in byte order, with the length of the prefix that parts each from the one before."""
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            if node.terminal is not None:
                yield node.terminal, depth + (1 if node.label else 0)
            below = depth + len(node.label)
            stack.extend((node.children[byte], below) for byte in sorted(node.children, reverse=True))


def word_counts(text: bytes) -> tuple[int, int]:
    """The number of words and of distinct words."""
    if len(text) <= LONG:
        words = text.split()
        return len(words), len(set(words))
    total, seen, at = 0, set(), 0
    while at < len(text):
        cut = BREAK.search(text, at + LONG)
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        total += len(words)
        seen.update(words)
        at = end
    return total, len(seen)


def failures(text: bytes, limits: Limits) -> int:
    """The filters other than E that a text fails, one bit each."""
    words, distinct = word_counts(text)
    points = len(text.translate(None, CONTINUED))
    upper = len(text) - len(text.translate(None, UPPER))
    return (
        (words < limits.words)
        | (100 * distinct < limits.distinct_percent * words) << 1
        | (100 * upper > limits.upper_percent * points) << 2
        | (SYMBOL.search(text) is not None) << 3
    )


SENT = "doc_id long, part string, mask int, n long, text binary, cut int"
NARROW = "doc_id long, part string, mask int, n long"


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.record_batch(arrays, [name for name, _ in fields])


def _tallied(terminal: Terminal, least: int) -> Iterator[tuple[int, str, int, int]]:
    """(doc_id, part, mask, n) of the rows of a text: all but those of the least id are duplicates."""
    counts: dict[tuple, int] = {}
    for doc_id, part, mask, n in terminal.rows:
        mask |= DUPLICATE if doc_id > least else 0
        counts[doc_id, part, mask] = counts.get((doc_id, part, mask), 0) + n
    for (doc_id, part, mask), n in counts.items():
        yield doc_id, part, mask, n


def _measured(docs: DataFrame, part: str, limits: Limits, chunk: int, step: int) -> DataFrame:
    """Rows decided inside their task (text null), and one row with text for each other document."""

    def flush(trie: RadixTrie) -> pa.RecordBatch:
        out, passed = [], 0
        for terminal, cut in trie.traverse():
            passed += len(terminal.text) + 1
            for doc_id, name, mask, n in _tallied(terminal, terminal.least):
                if mask & DUPLICATE:
                    out.append((doc_id, name, mask, n, None, 0))
                else:
                    due = passed >= step
                    out.append((doc_id, name, mask, n, terminal.text, cut if due else 0))
                    passed = 0 if due else passed
        return _batch(out, SENT)

    def scan(batches):
        trie, held = RadixTrie(), 0
        for batch in batches:
            ids, texts, parts = (batch.column(i) for i in range(3))
            alone = []
            for i in range(batch.num_rows):
                doc_id, name = ids[i].as_py(), parts[i].as_py()
                text = texts[i].as_py() or b""
                mask = failures(text, limits)
                if doc_id is None:
                    alone.append((None, name, mask, 1, None, 0))
                    continue
                terminal = trie.insert(text, doc_id)
                terminal.rows.append((doc_id, name, mask, 1))
                held += 64
                if trie.size + held > chunk:
                    yield flush(trie)
                    trie, held = RadixTrie(), 0
            if alone:
                yield _batch(alone, SENT)
        yield flush(trie)

    wanted = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
    )
    return wanted.mapInArrow(scan, SENT)


def _bounds(sent: DataFrame, ranges: int) -> list[bytes]:
    """At most ``ranges - 1`` prefixes that cut the texts into ranges of about one size.

    Each stands for one step of text. Of very many steps an even share, picked by
    hash, is read: about ``BOUNDS`` for each range, however large the input is.
    """
    named = sent.where("cut > 0").select(F.expr("substring(text, 1, cut)").alias("prefix"))
    total = named.count()
    share = min(1.0, BOUNDS * ranges / max(total, 1))
    picked = named.where(F.pmod(F.xxhash64("prefix"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    prefixes = sorted(bytes(row[0]) for row in picked.collect())
    places = (len(prefixes) * i // ranges for i in range(1, ranges))
    return sorted({prefixes[place] for place in places if place < len(prefixes)})


def masks(
    docs: DataFrame,
    part: str = "lang",
    limits: Limits = Limits(),
    ranges: int | None = None,
    chunk: int = CHUNK,
    step: int = STEP,
) -> DataFrame:
    """``(doc_id, part, mask, n)``: how many rows of a document fail just the filters in ``mask``.

    Bit i of the mask is filter i of ``FILTERS``. Null text is empty, null parts are
    the empty string. A row whose id is null duplicates nothing and is duplicated by
    nothing; rows that repeat id and text are no duplicates of each other. Texts are
    compared whole, byte by byte.
    """
    ranges = ranges or partitions(docs.sparkSession)
    sent = stored(_measured(docs, part, limits, chunk, step), "filter-texts")
    bounds = _bounds(sent, ranges)

    def route(batches):
        for batch in batches:
            found = [bisect_right(bounds, text) for text in batch.column("text").to_pylist()]
            yield batch.append_column("range", pa.array(found, pa.int32()))

    def decide(batches):
        trie, last, held = RadixTrie(), None, 0

        def flush():
            return _batch([row for terminal, _ in trie.traverse() for row in _tallied(terminal, terminal.least)], NARROW)

        for batch in batches:
            narrow = zip(*(column.to_pylist() for column in batch.columns[:4]), batch.column("text"))
            for doc_id, name, mask, n, value in narrow:
                text = value.as_py()
                if trie.size + held > chunk:
                    # Rows come by text and id, so a text in the middle already has its least id.
                    yield flush()
                    trie, held = RadixTrie(), 0
                    if last is not None and last[0] == text:
                        trie.insert(*last)
                terminal = trie.insert(text, doc_id)
                terminal.rows.append((doc_id, name, mask, n))
                last, held = (text, terminal.least), held + 64
        yield flush()

    open_rows = sent.where("text is not null").select("doc_id", "part", "mask", "n", "text")
    ordered = (
        open_rows.mapInArrow(route, "doc_id long, part string, mask int, n long, text binary, range int")
        .repartitionById(ranges, "range")
        .sortWithinPartitions("text", "doc_id")
        .drop("range")
    )
    decided = sent.where("text is null").select("doc_id", "part", "mask", "n")
    return ordered.mapInArrow(decide, NARROW).unionByName(decided)


def _steps(spark) -> DataFrame:
    """What happens to each mask at each step of each order; a fixed table, built by rule."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, gone = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            bit = 1 << f
            for mask in range(1 << len(FILTERS)):
                earlier, fails = bool(mask & gone), bool(mask & bit)
                kept = not mask & (gone | bit)
                rows.append((name, step, mask, int(kept), int(fails and not earlier), int(fails and earlier), int(mask == bit)))
            gone |= bit
    columns = "filter_order string, step int, mask int, keeps int, removes int, repeats int, alone int"
    return literal_table(spark, rows, struct(columns))


def report(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: the counts of what the step's filter does.

    ``found`` is what :func:`masks` gives. A document counts as labelled good or toxic
    if any of its rows in ``labels`` says so; null labels say nothing. A part without
    documents has no rows.
    """
    spark = found.sparkSession
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    counted = (
        found.join(told, F.col("doc_id") == F.col("_id"), "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    # 19,200 rows, whatever the input: 32 masks at 5 steps of 120 orders.
    rows = counted.join(F.broadcast(_steps(spark)), "mask").groupBy("part", "filter_order", "step").agg(
        F.sum(F.col("n") * F.col("keeps")).alias("kept"),
        F.sum(F.col("n") * F.col("removes")).alias("removed"),
        F.sum(F.col("n") * F.col("repeats")).alias("redundant"),
        F.sum(F.col("n") * F.col("alone")).alias("unique_fails"),
        F.sum(F.col("good") * F.col("removes")).alias("good_lost"),
        F.sum(F.col("toxic") * F.col("removes")).alias("toxic_lost"),
    )
    alike = Window.partitionBy("part", "filter")
    return rows.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", F.sum("removed").over(alike).alias("shapley"),
    )
