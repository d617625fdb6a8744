"""Benchmark decontamination by winnowing.

Of the hashes of all runs of ``GRAM`` words, the least of every ``WINDOW``
neighbours is kept as a fingerprint. A span of ``GRAM + WINDOW - 1`` words that
a document shares with a benchmark item holds at least one fingerprint of both
at the same place, so joining fingerprints finds every such span; hits are then
extended word by word on both sides. Items shorter than that are one run
of all their words, and for their few lengths every run of a document counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .storage import stored
from .words import LETTERS, Words, chunks, find_words, gram_hashes, signed, winnow, word_hashes

GRAM = 5
FILTER_BITS = 23  # the filter of benchmark fingerprints has 2^23 bits, whatever their number

FINGERPRINT = pa.struct(
    [("hash", pa.int64()), ("size", pa.int32()), ("place", pa.int32()), ("first", pa.int32()), ("near", pa.string())]
)
FINGERPRINT_DDL = "array<struct<hash:bigint,size:int,place:int,first:int,near:string>>"


def _places(words: Words, span: int, shorter: list[int], whole_items: bool):
    """(gram size, places, hashes) of the fingerprints of several texts."""
    hashes, last = word_hashes(words, lower=True), words.last()
    counts = words.counts[words.text_of()]
    grams = gram_hashes(hashes, GRAM)
    n = len(grams)
    usable = np.arange(n) + GRAM <= last[:n]
    marked = winnow(grams, usable, span - GRAM + 1)
    if whole_items:
        marked &= counts[:n] >= span
    places = np.flatnonzero(marked)
    yield GRAM, places, grams[places]
    for size in shorter:
        grams = gram_hashes(hashes, size)
        usable = np.arange(len(grams)) + size <= last[: len(grams)]
        if whole_items:
            usable &= counts[: len(grams)] == size
        places = np.flatnonzero(usable)
        # another length, another hash
        yield -size, places, grams[places] ^ np.uint64(size)


def fingerprints(
    table: DataFrame, key: str, span: int, shorter: list[int], known: bytes | None = None
) -> DataFrame:
    """``(key, text_hash, n_words, found)``: a row a text with its fingerprints and their surroundings.

    ``known`` limits them to hashes that the filter holds. ``near`` has the words
    around the run that a window of ``span`` words with it can reach.
    """
    items = known is None
    bits = np.unpackbits(np.frombuffer(known, np.uint8), bitorder="little") if known else None
    table = table.select(key, F.xxhash64("text").alias("text_hash"), "text")
    if bits is not None:
        held = table.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                words = find_words(part.column("text"), LETTERS)
                of = words.text_of()
                rows: list[tuple] = []
                owners: list[np.ndarray] = []
                for size, places, hashes in _places(words, span, shorter, items):
                    if not items:
                        hit = held.value[hashes >> np.uint64(64 - FILTER_BITS)] > 0
                        places, hashes = places[hit], hashes[hit]
                    owners.append(of[places])
                    length = abs(size)
                    reach = span - length if size > 0 else 0
                    base = words.bounds[of[places]]
                    low = np.maximum(places - reach, base)
                    high = np.minimum(places + length + reach, words.bounds[of[places] + 1])
                    near = [" ".join(words.spelled(a, b, lower=True)) for a, b in zip(low, high)]
                    rows += zip(signed(hashes).tolist(), [length] * len(near), (places - base).tolist(), (low - base).tolist(), near)
                owner = np.concatenate(owners)
                order = np.argsort(owner, kind="stable")
                flat = pa.array([dict(zip(("hash", "size", "place", "first", "near"), rows[i])) for i in order], FINGERPRINT)
                counts = np.bincount(owner, minlength=part.num_rows)
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(words.counts, pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                    [key, "text_hash", "n_words", "found"],
                )

    kind = table.schema[key].dataType.simpleString()
    return table.mapInArrow(
        run, f"{key} {kind}, text_hash bigint, n_words bigint, found {FINGERPRINT_DDL}"
    )


def hash_filter(hashes: DataFrame) -> bytes:
    """A bit for the leading ``FILTER_BITS`` bits of every hash: 1 MB at most, built by executors."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS) + 1
    parts = (
        hashes.select(place.alias("v"))
        .groupBy(F.bitmap_bucket_number("v").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    )
    size = 4096
    whole = bytearray(max(1 << FILTER_BITS >> 3, size))
    for row in parts.collect():  # 256 rows at most
        whole[(row.bucket - 1) * size : row.bucket * size] = row.bits
    return bytes(whole)


def _extend(batches):
    """Lengthen each pair of equal runs to both sides while the words agree."""
    for pdf in batches:
        starts, ends = [], []
        for row in pdf.itertuples(index=False):
            mine, theirs = row.near.split(" "), row.item_near.split(" ")
            a, b = row.place - row.first, row.item_place - row.item_first
            if mine[a : a + row.size] != theirs[b : b + row.size]:
                starts.append(0), ends.append(0)
                continue
            left, right = 0, row.size
            while a > left and b > left and mine[a - left - 1] == theirs[b - left - 1]:
                left += 1
            while a + right < len(mine) and b + right < len(theirs) and mine[a + right] == theirs[b + right]:
                right += 1
            starts.append(row.place - left), ends.append(row.place + right)
        yield pdf[["doc_key", "text_hash", "item_key", "needed"]].assign(start=starts, end=ends)


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = 10, key: str = "doc_id", item_key: str = "item_id"
) -> DataFrame:
    """Per document: key, n_words, n_hit (words inside any shared window) and ``items`` (sorted texts of item keys).

    Windows are ``span`` neighbouring words of an item, or the whole of an item
    with fewer; items without words and null texts have none. Items with a null
    key count, but are not listed. One row for each input row; repeated rows are
    judged alike. Empty tables give no rows, or rows without hits.
    """
    found = _verdicts(docs, benchmark, span, key, item_key)
    return found.select(F.col("doc_key").alias(key), "n_words", "n_hit", "items")


def _verdicts(docs: DataFrame, benchmark: DataFrame, span: int, key: str, item_key: str) -> DataFrame:
    """``(doc_key, text_hash, n_words, n_hit, items)``, one row for each input row."""
    if span <= GRAM:
        raise ValueError(f"span must be over {GRAM}")
    items = benchmark.select(F.col(item_key).alias("item_key"), "text")
    sized = fingerprints(items, "item_key", span, list(range(1, span)))
    found = stored(
        sized.select("item_key", "n_words", F.explode("found").alias("x")).select(
            "item_key", "n_words", "x.*"
        ),
        "benchmark-fingerprints",
    )
    lengths = found.where(F.col("n_words") < span).select("n_words").distinct().collect()  # under span rows
    shorter = sorted(r.n_words for r in lengths)
    texts = docs.select(F.col(key).alias("doc_key"), "text")
    judged = stored(
        fingerprints(texts, "doc_key", span, shorter, hash_filter(found)), "document-fingerprints"
    )
    hits = judged.select("doc_key", "text_hash", F.explode("found").alias("x")).select(
        "doc_key", "text_hash", "x.*"
    ).distinct()
    theirs = found.select(
        "hash",
        "size",
        "item_key",
        F.least("n_words", F.lit(span)).alias("needed"),
        F.col("place").alias("item_place"),
        F.col("first").alias("item_first"),
        F.col("near").alias("item_near"),
    )
    id_types = f"doc_key {docs.schema[key].dataType.simpleString()}, text_hash bigint, item_key {benchmark.schema[item_key].dataType.simpleString()}"
    spans = stored(
        hits.join(theirs, ["hash", "size"])
        .mapInPandas(_extend, f"{id_types}, needed bigint, start bigint, end bigint")
        .where("end - start >= needed")
        .distinct(),
        "spans",
    )
    identity = ["doc_key", "text_hash"]
    before = Window.partitionBy(*identity).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = (
        spans.select(*identity, "start", "end").distinct()
        .withColumn("fresh", F.greatest(F.col("end") - reached, F.lit(0)))
        .groupBy(*identity)
        .agg(F.sum("fresh").alias("n_hit"))
    )
    listed = (
        spans.select(*identity, F.col("item_key").cast("string").alias("item")).distinct()
        .groupBy(*identity)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    both = hit.join(listed, _same(hit, listed), "left").select(
        hit["doc_key"].alias("hit_key"), hit["text_hash"].alias("hit_hash"), "n_hit", "items"
    )
    same = judged["doc_key"].eqNullSafe(both["hit_key"]) & (judged["text_hash"] == both["hit_hash"])
    return judged.join(both, same, "left").select(
        judged["doc_key"],
        judged["text_hash"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _same(a: DataFrame, b: DataFrame):
    return a["doc_key"].eqNullSafe(b["doc_key"]) & (a["text_hash"] == b["text_hash"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """The documents without a word inside any benchmark window, row by row; columns stay as they are."""
    bad = _verdicts(docs, benchmark, span, "doc_id", "item_id").where("n_hit > 0")
    bad = bad.select("doc_key", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(bad["doc_key"]) & (F.xxhash64(docs["text"]) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")
