"""One JSON array in one file, read by as many tasks as the file has splits.

Spark cuts the text behind every closing brace, so the pieces of a split need no
look at its neighbours. What a piece means depends on whether it begins inside a
string and at which depth. Both are worked out per split for either beginning, and
the few results are chained over the splits of a file: quotes decide the strings,
strings decide the brackets, brackets the depth. An element, which must be an
object, ends with a brace that leads back to the array; the pieces behind the end
before it up to its own make its text.

A task reads the pieces of a split in their order, so sums along them are taken
where they are read. The text is read twice and written once; only what an element
leaves on either side of a split's border, and one row a split, is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import stored

SPLIT = ["file", "block"]


class BrokenFile(ValueError):
    """A file that ends inside a string, or with brackets open."""


QUOTE, BACKSLASH, OPEN_BRACE, OPEN_BRACKET, CLOSE_BRACKET = b'"\\{[]'


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text behind each closing brace up to the next one, ``split`` naming its file and block."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    ).withColumn("split", F.xxhash64(*SPLIT))


class _Text:
    """The bytes of consecutive pieces, and which of them are quotes and brackets."""

    def __init__(self, values: pa.Array):
        size = np.dtype(np.int64 if pa.types.is_large_string(values.type) else np.int32)
        held = np.frombuffer(values.buffers()[1], size, len(values) + 1, values.offset * size.itemsize)
        data = values.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.at = held.astype(np.int64) - held[0]  # where each piece begins, and the end
        self.data = data[held[0] : held[-1]]
        quotes = self.data == QUOTE
        quotes[self._escaped()] = False
        self.quotes_before = np.concatenate([[0], np.cumsum(quotes)])
        self.quotes = np.diff(self.quotes_before[self.at])
        opening = (self.data == OPEN_BRACE) | (self.data == OPEN_BRACKET)
        self.brackets = np.flatnonzero(opening | (self.data == CLOSE_BRACKET))
        self.change = np.where(opening[self.brackets], 1, -1)

    def _escaped(self) -> np.ndarray:
        """Places behind a backslash that is not escaped itself."""
        slashes = np.flatnonzero(self.data == BACKSLASH)
        if not len(slashes):
            return slashes
        begins = np.concatenate([[True], np.diff(slashes) != 1]) | np.isin(slashes, self.at)
        begin = np.maximum.accumulate(np.where(begins, slashes, 0))
        behind = slashes[(slashes - begin) % 2 == 0] + 1
        return behind[~np.isin(behind, self.at)]

    def steps(self, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a first piece that begins ``inside`` a string: the brackets outside of strings, and per
        piece whether it begins in a string and the change of depth up to the next.

        The brace behind a piece closes an object unless it is part of a string.
        """
        plain = (inside + self.quotes_before[self.brackets]) % 2 == 0
        where, sums = self.brackets[plain], np.concatenate([[0], np.cumsum(self.change[plain])])
        within = (inside + self.quotes_before[self.at]) % 2
        return where, within[:-1] == 1, np.diff(sums[np.searchsorted(where, self.at)]) - (within[1:] == 0)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
    """``(split, first, end)`` of the rows of one split that follow each other."""
    split = batch.column("split").to_numpy()
    cuts = np.flatnonzero(np.diff(split)) + 1
    bounds = [0, *cuts.tolist(), len(split)]
    for first, end in zip(bounds, bounds[1:]):
        if end > first:
            yield int(split[first]), first, end


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: its quotes, and its change of depth for either beginning."""
    rows: list[dict] = []
    for batch in batches:
        for split, first, end in _runs(batch):
            if not rows or rows[-1]["split"] != split:
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)
                names = {n: batch.column(n)[first].as_py() for n in (*SPLIT, "source_file")}
                rows = [{"split": split, **names, "q": 0, "d0": 0, "d1": 0}]
            now = rows[-1]
            text = _Text(batch.column("value").slice(first, end - first))
            now["d0"] += int(text.steps(now["q"] % 2)[2].sum())
            now["d1"] += int(text.steps((now["q"] + 1) % 2)[2].sum())
            now["q"] += int(text.quotes.sum())
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def _beginnings(pieces: DataFrame) -> DataFrame:
    """One row a split: how it begins, chained over the splits of its file."""
    per_split = pieces.mapInArrow(
        _totals, "split bigint, file string, block bigint, source_file string, q bigint, d0 bigint, d1 bigint"
    )
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2 == 1
    moved = per_split.withColumn("split_inside", inside).withColumn(
        "moved", F.when(F.col("split_inside"), F.col("d1")).otherwise(F.col("d0"))
    )
    return moved.select(
        "split",
        *SPLIT,
        "source_file",
        "split_inside",
        F.coalesce(F.sum("moved").over(earlier), F.lit(0)).alias("split_depth"),
        F.sum("moved").over(order).alias("depth_after"),
        (F.sum("q").over(order) % 2 == 1).alias("inside_after"),
    )


def _check(beginnings: DataFrame) -> None:
    """White space behind the last brace is a piece without a brace of its own, counted as one."""
    ends = beginnings.groupBy("file").agg(F.max_by(F.struct("depth_after", "inside_after"), "block").alias("end"))
    bad = ends.where("end.inside_after OR end.depth_after NOT IN (0, -1)").select("file").limit(1).collect()
    if bad:
        raise BrokenFile(f"{bad[0].file}: not a whole JSON document")


# What a row of the parts is: a whole element, the end of one begun in an earlier
# split, the begin of one that ends in a later split, or the counts of a split.
WHOLE, HEAD, TAIL, COUNTS = range(4)
PARTS = "split bigint, kind int, nth bigint, sure boolean, opened boolean, text string, sures bigint, within int"
ARROW_PARTS = pa.schema([
    ("split", pa.int64()), ("kind", pa.int32()), ("nth", pa.int64()), ("sure", pa.bool_()),
    ("opened", pa.bool_()), ("text", pa.string()), ("sures", pa.int64()), ("within", pa.int32()),
])
UNKNOWN = -1


class _Split:
    """A walk along the pieces of one split; until the array opens or closes in it, ``within`` is unknown."""

    def __init__(self, split: int, inside: int, depth: int, wrapper: str):
        self.split, self.quotes, self.depth, self.within = split, inside, depth, UNKNOWN
        self.wrapper, self.opening = wrapper, re.compile(_opening(wrapper))
        self.held: list[str] = []  # text since the last end
        self.untouched, self.opened = True, False  # whether the text may begin in an earlier split, or at the array
        self.maybes = self.sures = 0

    def _opens(self, value: str, inside: bool, depth: int) -> bool:
        """Whether the array opens in a piece, at depth 1."""
        bare = re.sub(r"(?s)\\.", "", value)
        bare = re.sub(r'^[^"]*("|$)', "", bare) if inside else bare
        # Strings go, but for the wrapper's name.
        outline = re.sub(rf'("{re.escape(self.wrapper)}")|"[^"]*(?:"|$)', lambda m: m[1] or "", bare)
        found = self.opening.search(outline)
        before = outline[: found.start()] if found else ""
        return bool(found) and depth + sum({"{": 1, "[": 1, "]": -1}.get(c, 0) for c in before) == 1

    def take(self, pieces: pa.Array) -> Iterator[tuple]:
        text, values = _Text(pieces), pieces.to_pylist()
        brackets, inside, step = text.steps(self.quotes % 2)
        depth = self.depth + np.cumsum(step) - step
        event = np.full(len(values), UNKNOWN)
        # The first bracket of a piece between two elements closes the array.
        first = np.searchsorted(brackets, text.at[:-1])
        has_any = first < np.searchsorted(brackets, text.at[1:])
        closing = has_any & (depth == 2)
        closing[closing] = text.data[brackets[first[closing]]] == CLOSE_BRACKET
        event[closing] = 0
        name, raw, place = f'"{self.wrapper}"'.encode(), text.data.tobytes(), -1
        while (place := raw.find(name, place + 1)) >= 0:
            i = int(np.searchsorted(text.at, place, "right")) - 1
            if event[i] != 1 and self._opens(values[i], bool(inside[i]), int(depth[i])):
                event[i] = 1
        last = np.maximum.accumulate(np.where(event != UNKNOWN, np.arange(len(event)), -1))
        within = np.where(last >= 0, event[last], self.within)
        ends = ((inside + text.quotes) % 2 == 0) & (depth + step == 2) & (within != 0)
        start = 0
        for i in np.flatnonzero(ends | (event != UNKNOWN)).tolist():
            if event[i] != UNKNOWN:
                self.held, start, self.untouched, self.opened = [], i, False, bool(event[i])
                self.within = int(event[i])
            if ends[i]:
                element = "".join([*self.held, "}".join(values[start : i + 1]), "}"])
                kind, sure = HEAD if self.untouched else WHOLE, self.within == 1
                yield self.split, kind, self._next(sure), sure, self.opened, element, None, None
                self.held, start, self.untouched, self.opened = [], i + 1, False, False
        if self.within != 0 and start < len(values):
            self.held.append("}".join(values[start:]) + "}")
        self.quotes += int(text.quotes.sum())
        self.depth += int(step.sum())

    def _next(self, sure: bool) -> int:
        if sure:
            self.sures += 1
            return self.sures - 1
        self.maybes += 1
        return self.maybes - 1

    def end(self) -> Iterator[tuple]:
        if self.held:
            yield self.split, TAIL, None, self.within == 1, self.opened, "".join(self.held), None, None
        yield self.split, COUNTS, self.maybes, None, None, None, self.sures, self.within


def _opening(wrapper: str) -> str:
    return rf'"{re.escape(wrapper)}"\s*:\s*\[(?=\s*\{{)'


def _gathered(batches: Iterator[pa.RecordBatch], wrapper: str) -> Iterator[pa.RecordBatch]:
    """The parts of the splits, in order."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in ARROW_PARTS]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, ARROW_PARTS)], schema=ARROW_PARTS
        )

    walk = None
    for batch in batches:
        rows: list[tuple] = []
        for split, first, end in _runs(batch):
            if walk is None or walk.split != split:
                if walk is not None:
                    rows.extend(walk.end())
                begin = [batch.column(n)[first].as_py() for n in ("split_inside", "split_depth")]
                walk = _Split(split, int(begin[0]), begin[1], wrapper)
            rows.extend(walk.take(batch.column("value").slice(first, end - first)))
        yield packed(rows)
    if walk is not None:
        yield packed(list(walk.end()))


def elements(spark: SparkSession, path: str | list[str], wrapper: str) -> DataFrame:
    """``(source_file, file_block, file_row, payload)``: the objects of the arrays under ``wrapper``.

    ``file_row`` counts the elements of a file from 0. Text is as in the file. An
    element that is no JSON fails when it is read.
    """
    with _same_splits(spark):
        return _elements(spark, path, wrapper)


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are cut alike in here, also if executors come or go."""
    name = "spark.sql.files.minPartitionNum"
    given = spark.conf.get(name, None)
    spark.conf.set(name, given or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)


def _elements(spark: SparkSession, path: str | list[str], wrapper: str) -> DataFrame:
    pieces = _pieces(spark, path)
    beginnings = stored(_beginnings(pieces), "json-splits")
    _check(beginnings)

    # One row a split.
    begun = F.broadcast(beginnings.select("split", "split_inside", "split_depth"))
    told = pieces.select("split", "value").join(begun, "split")
    parts = stored(told.mapInArrow(lambda batches: _gathered(batches, wrapper), PARTS), "json-parts")

    # Whether a split begins within the array, and how many elements end before it.
    counted = beginnings.select("split", *SPLIT, "source_file").join(
        parts.where(F.col("kind") == COUNTS).select("split", F.col("nth").alias("maybes"), "sures", "within"), "split"
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    left = F.when(F.col("within") != UNKNOWN, F.col("within"))
    carried = counted.withColumn("left", left).withColumn(
        "carried", F.coalesce(F.last("left", ignorenulls=True).over(earlier), F.lit(0)) == 1
    )
    maybes = F.when(F.col("carried"), F.col("maybes")).otherwise(0)
    ended = F.coalesce(F.sum(F.col("sures") + maybes).over(earlier), F.lit(0))
    chained = F.broadcast(
        carried.withColumns({"maybes": maybes, "ended": ended}).select(
            "split", *SPLIT, "source_file", "carried", "maybes", "ended"
        )
    )
    row = F.col("ended") + F.col("nth") + F.when(F.col("sure"), F.col("maybes")).otherwise(0)
    held = parts.where(F.col("kind") != COUNTS).join(chained, "split").where("sure OR carried").withColumn("file_row", row)

    # Elements across borders: what is held at the end of splits, up to the next end. Two rows a split.
    across = held.where(F.col("kind").isin(HEAD, TAIL)).withColumn("head", (F.col("kind") == HEAD).cast("int"))
    along = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, -1)
    part = F.struct("block", "kind", "text", "opened")
    joined = (
        across.withColumn("group", F.coalesce(F.sum("head").over(along), F.lit(0)))
        .groupBy("file", "group")
        .agg(
            F.sort_array(F.collect_list(part)).alias("parts"),
            F.max("head").alias("head"),
            F.first("source_file").alias("source_file"),
            F.max("block").alias("block"),
            F.max("file_row").alias("file_row"),
        )
        .where("head = 1")
        .withColumn("opened", F.exists("parts", lambda p: p["opened"]))
        .withColumn("text", F.array_join("parts.text", ""))
    )
    kept = ["source_file", "block", "file_row", "opened", "text"]
    gathered = held.where(F.col("kind") == WHOLE).select(*kept).unionByName(joined.select(*kept))
    # Without what stands before: up to the array's opening bracket, or the comma behind the element before.
    lead = F.when(F.col("opened"), F.regexp_replace("text", rf"(?s)^.*?{_opening(wrapper)}\s*", "")).otherwise(
        F.regexp_replace("text", r"^\s*,\s*", "")
    )
    broken = F.raise_error(F.concat("source_file", F.lit(": element "), "file_row", F.lit(" is no JSON")))
    return (
        gathered.withColumn("payload", lead)
        .withColumn("payload", F.when(F.try_parse_json("payload").isNull(), broken).otherwise(F.col("payload")))
        .select("source_file", F.col("block").alias("file_block"), F.col("file_row").cast("int").alias("file_row"), "payload")
    )
