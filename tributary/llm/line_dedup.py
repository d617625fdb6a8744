"""Lines within one edit of an earlier line, by deletion neighbourhoods; DataFrame functions alone.

Two lines at one edit agree outside a short piece: the same characters before it
counted from the left, and after it counted from the right. So lines are first
paired by their halves, then by all but one piece of ``PIECE`` characters, and
only pieces whose surroundings two lines share emit their deletion variants as
hashed keys. Equal keys at one place mean one substitution, and a shortened
piece equal to a whole one means one insertion. A key's earliest line is
aggregated and joined back, so no pairs are made within a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

PIECE = 32


def split_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(place, line, n, h, g)``: lines of ``min_chars`` or more, with their place in the corpus and two hashes."""
    place = F.struct("doc_id", F.xxhash64("text").alias("text_hash"), F.col("line_no").alias("line_no"))
    return (
        docs.select("doc_id", "text", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .withColumn("n", F.length("line"))
        .where(F.col("n") >= min_chars)
        .select(place.alias("place"), "line", "n", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))
    )


def _twins(cells: DataFrame) -> DataFrame:
    """The cells of ``(cell, h, ...)`` that more than one line has."""
    sizes = cells.groupBy("cell").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return cells.join(sizes.where("low <> high").select("cell"), "cell")


def _half_cells(lines: DataFrame) -> DataFrame:
    """Cells of both halves, for the line as the shorter and as the longer one of a pair."""
    cells = F.expr(
        "flatten(transform(array(n, n - 1), s -> array("
        "xxhash64(s, 0, left(line, s div 2)), xxhash64(s, 1, right(line, s - s div 2)))))"
    )
    return lines.select("h", F.explode(cells).alias("cell"))


def _piece_cells(lines: DataFrame) -> DataFrame:
    """Cells of all but one piece; ``s`` is the length of the shorter line, ``piece`` what is left out."""
    pieces = F.expr(
        f"flatten(transform(array(n, n - 1), s -> transform(sequence(0, (s - 1) div {PIECE}), j -> named_struct("
        f"'cell', xxhash64(s, j, left(line, j * {PIECE}), right(line, greatest(s - (j + 1) * {PIECE}, 0))),"
        f"'piece', substring(line, j * {PIECE} + 1, least({PIECE}, s - j * {PIECE}) + n - s),"
        "'longer', n > s))))"
    )
    return lines.select("h", "place", F.inline(pieces))


def nearest_earlier(lines: DataFrame) -> DataFrame:
    """``(h, g, earliest)``: for each distinct line the first place of it or of a line at one edit."""
    first = stored(
        lines.groupBy("h", "g").agg(F.min("place").alias("place"), F.first("n").alias("n")), "lines"
    )
    near = stored(
        _twins(_half_cells(lines.dropDuplicates(["h"]).select("h", "line", "n"))).select("h").distinct(),
        "near-lines",
    )
    texts = (
        lines.join(near, "h")
        .groupBy("h", "g")
        .agg(F.min(F.struct("place", "line", "n")).alias("x"))
        .select("h", "g", "x.*")
    )
    cells = stored(_twins(_piece_cells(texts)), "pieces")
    cut = "transform(sequence(1, length(piece)), i -> concat(left(piece, i - 1), substring(piece, i + 1)))"
    variants = F.expr(  # kind 0: the whole shorter piece, 1: a longer one cut, 2: cut at a place of both
        f"if(longer, transform({cut}, v -> named_struct('kind', 1, 'key', xxhash64(cell, 0, v))),"
        f" concat(array(named_struct('kind', 0, 'key', xxhash64(cell, 0, piece))),"
        f" transform({cut}, (v, i) -> named_struct('kind', 2, 'key', xxhash64(cell, i + 1, v)))))"
    )
    keys = cells.select("h", "place", "cell", "piece", F.inline(variants)).distinct()
    here = F.struct("place", "piece", "cell")
    least = keys.groupBy("key").agg(
        *[F.min(F.when(F.col("kind") == k, here)).alias(f"least{k}") for k in (0, 1, 2)],
        F.min("h").alias("low"),
        F.max("h").alias("high"),
    ).where("low <> high")
    other = F.expr("case kind when 0 then least1 when 1 then least0 else least2 end")
    # A piece makes a hundred keys, which Spark would not see in the size of the stored pieces: broadcast
    # by that size they would fill the driver, so both joins are told to shuffle.
    found = (
        keys.join(least.hint("merge"), "key")
        .withColumn("other", other)
        .where("other.cell = cell and levenshtein(piece, other.piece) <= 1")
        .groupBy("h")
        .agg(F.min("other.place").alias("near"))
    )
    return first.join(found.hint("merge"), "h", "left").select(
        "h", "g", F.least("place", "near").alias("earliest")
    )


def repeated_lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """Per document: doc_id, text_hash, n_lines and the numbers (from 0) of the lines to remove.

    A line goes if it, or a line at one edit (a character put in, left out or
    changed), stands earlier in the corpus, in the order of doc_id and line. Empty
    lines stay, and lines under ``min_chars`` characters where more is asked for. Null text has no lines. Rows that repeat a
    doc_id and a text count as one document; a null doc_id comes first.
    """
    ids = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    lines = split_lines(ids, max(min_chars, 1))
    earliest = nearest_earlier(lines)
    gone = (
        lines.select("place", "h", "g")
        .join(earliest, ["h", "g"])
        .where("earliest < place")
        .groupBy("place.doc_id", "place.text_hash")
        .agg(F.sort_array(F.collect_set("place.line_no")).alias("removed"))
    )
    counted = ids.select(
        "doc_id", "text_hash", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines")
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0))).distinct()
    same = counted["doc_id"].eqNullSafe(gone["doc_id"]) & (counted["text_hash"] == gone["text_hash"])
    return counted.join(gone, same, "left").select(
        counted["doc_id"],
        counted["text_hash"],
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with those lines taken out of ``text``; other columns stay as they are."""
    free = "_line"
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    key, text_hash, gone = f"{free}1", f"{free}2", f"{free}3"
    marks = found.select(
        F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.col("removed").alias(gone)
    )
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(text_hash))
    kept = F.expr(f"array_join(filter(split(text, '\\n'), (x, i) -> not array_contains({gone}, i)), '\\n')")
    joined = docs.join(marks, same, "left")
    return joined.select(*[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
