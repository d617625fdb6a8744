"""Repeated byte windows by a depth-limited radix sort of suffixes, most significant digit first.

Only suffixes of at least ``window`` bytes are ordered, and only through their
first ``window`` bytes, so equal groups of the last pass are exactly the windows
that start at several places. Nothing is sorted by the driver or inside a group:
each pass groups by one digit more, and suffixes alone in their group are done.

The first digit of a suffix is the least hash among the ``gram``-byte strings of
its window (the leftmost of equal ones) and where that string stands in the window.
Neighbouring suffixes mostly share it, so one entry stands for the whole run of
suffixes with one anchor, and one place in about 150 is sent instead of every one.
Equal runs, by a 128-bit digest of all their bytes, are repeated through and through.
Runs that share the anchor but differ go on: the second digit is a window's bytes
less up to ``STRIDE`` at either end, the same for a stride of suffixes. A stride whose
bytes are all equal to another's is repeated as a whole; only of strides that share
the second digit but differ at an end is the last digit taken, the whole window.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored
from .words import chunks, mix, signed, sliding, text_bytes

PIECE = 1 << 20  # bytes hashed at a time; longer texts are cut into overlapping pieces
GATHERED = 32 << 20  # bytes of text within which equal runs are brought together before they are sent
STRIDE = 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have an inverse modulo 2^64
PLACE_BITS = 24

ENTRY = "k1 long, k2 long, g long, a long, left int, right int, h1 long, h2 long, n long"
CONTEXT = "k1 long, k2 long, a long, g long, left int, right int, n long, bytes binary"
COARSE = "k1 long, k2 long, a long, g long, digit int, c1 long, c2 long, low int, high int, s1 long, s2 long, n long"
FINE = "k1 long, k2 long, start long, g long, d int, f1 long, f2 long, n long"


@lru_cache(4)
def _tables(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, and powers of the base and of its inverse."""
    base = BASES[which]
    values = mix(np.arange(1 + 256 * which, 257 + 256 * which, dtype=np.uint64) * np.uint64(base))
    up = np.full(size, base, np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return values, np.cumprod(up), np.cumprod(down)


class Sums:
    """Prefix sums of bytes, from which the hash of any span follows."""

    def __init__(self, data: np.ndarray, which: int):
        size = 1 << max(PIECE.bit_length(), len(data).bit_length())
        values, self.up, self.down = _tables(which, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values[data] * self.up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            sizes = (end - start).astype(np.uint64)
            return mix((self.sums[end] - self.sums[start]) * self.down[start] + sizes)

    def grams(self, size: int) -> np.ndarray:
        count = len(self.sums) - size
        with np.errstate(over="ignore"):
            terms = (self.sums[size:] - self.sums[:count]) * self.down[:count]
            return mix(terms + np.uint64(size))


def runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Runs of window starts with one anchor: (first, last, anchor, anchor hash, digests of all their bytes)."""
    count = len(data) - window + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3
    first, second = Sums(data, 0), Sums(data, 1)
    grams = first.grams(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchors = (sliding(keys, window - gram + 1, np.minimum) & low).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:count]
    starts = np.flatnonzero(np.arange(window, window + count) <= ends)
    anchors = anchors[starts]
    # Starts of different texts have different anchors.
    new = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(starts) else starts
    lo, hi = starts[new], starts[np.append(new[1:], len(starts)) - 1] if len(starts) else starts
    a = anchors[new]
    return lo, hi, a, grams[a], first.spans(lo, hi + window), second.spans(lo, hi + window)


def _pieces(texts: pa.Array, window: int):
    """(bytes, offsets, first text, shift): several whole texts, or a piece of one long text."""
    data, offsets = text_bytes(texts)
    if len(data) <= 2 * PIECE:
        yield data, offsets, 0
        return
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        for at in range(lo, max(hi - window + 1, lo), PIECE):
            end = min(at + PIECE + window - 1, hi)
            cut = np.clip(offsets, at, end) - at
            yield data[at:end], cut, at - lo


def _entries(held: list[tuple], window: int) -> pa.RecordBatch:
    """One entry for each different run; places whose run is here twice are decided (n = 0, spans of starts)."""
    k1, k2, lo, hi, a, g, h1, h2 = (np.concatenate(c) for c in zip(*held))
    left, right = a - lo, a - hi
    order = np.lexsort([left, right, h2, h1, g])
    sorted_ = [c[order] for c in (g, h1, h2, left, right)]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in sorted_:
        new[1:] |= column[1:] != column[:-1]
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(order)))
    keep = order[begins]
    again = np.zeros(len(order), bool)
    again[order] = np.repeat(sizes > 1, sizes)

    # Decided starts that touch make one span.
    mine = np.flatnonzero(again)
    mine = mine[np.lexsort([lo[mine], k2[mine], k1[mine]])]
    apart = np.ones(len(mine), bool)
    if len(mine):
        p, q = mine[:-1], mine[1:]
        apart[1:] = (k1[q] != k1[p]) | (k2[q] != k2[p]) | (lo[q] > hi[p] + 1) | (lo[q] < lo[p])
    heads = np.flatnonzero(apart)
    from_, to = lo[mine[heads]], hi[mine[np.append(heads[1:], len(mine)) - 1]] if len(mine) else lo[:0]

    def both(sent: np.ndarray, decided: np.ndarray, kind) -> pa.Array:
        return pa.array(np.concatenate([sent, decided]).astype(kind))

    zeros = np.zeros(len(heads), np.int64)
    columns = [
        both(k1[keep], k1[mine[heads]], np.int64),
        both(k2[keep], k2[mine[heads]], np.int64),
        both(signed(g[keep]), zeros, np.int64),
        both(a[keep], to, np.int64),
        both(left[keep], to - from_, np.int64).cast(pa.int64()),
        both(right[keep], zeros, np.int64),
        both(signed(h1[keep]), zeros, np.int64),
        both(signed(h2[keep]), zeros, np.int64),
        both(sizes, zeros, np.int64),
    ]
    columns[4], columns[5] = columns[4].cast(pa.int32()), columns[5].cast(pa.int32())
    return pa.record_batch(columns, [field.split()[0] for field in ENTRY.split(", ")])


def _scanned(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The first pass: the entries of all runs, brought together by task."""

    def scan(batches):
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, max_bytes=PIECE):
                ids = [part.column(i).to_numpy() for i in (0, 1)]
                for data, offsets, shift in _pieces(part.column("text"), window):
                    lo, hi, a, *hashes = runs(data, offsets, window, gram)
                    row = np.searchsorted(offsets, lo, "right") - 1
                    base = offsets[row] - shift
                    held.append((ids[0][row], ids[1][row], lo - base, hi - base, a - base, *hashes))
                    size += len(data)
                    if size > GATHERED:
                        yield _entries(held, window)
                        held, size = [], 0
        if held:
            yield _entries(held, window)

    return docs.mapInArrow(scan, ENTRY)


def _joined_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = batch.column("bytes").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _few(batches, rows: int):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy().astype(np.int64) for name in names]


def _ranged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for every value from ``first`` to ``last`` of each row."""
    sizes = last - first + 1
    row = np.repeat(np.arange(len(first)), sizes)
    within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, first[row] + within


def _table(columns: list, ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [field.split() for field in ddl.split(", ")]
    arrays = [pa.array(np.asarray(c).astype(np.int64)).cast(kinds[k]) for c, (_, k) in zip(columns, fields)]
    return pa.record_batch(arrays, [name for name, _ in fields])


def repeated_starts(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """``(k1, k2, first, last)``: runs of places where windows start that also start anywhere else."""
    entries = stored(_scanned(keyed, window, gram), "suffix-runs")
    run = ["g", "left", "right", "h1", "h2"]
    variants = entries.where("n > 0").groupBy(*run).agg(
        F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "a")]
    )
    variants = stored(variants, "suffix-variants")
    company = variants.groupBy("g").agg(F.count("*").alias("_variants")).where("_variants > 1")

    whole = (
        entries.where("n = 1")
        .join(variants.where("n > 1").select(*run), run, "left_semi")
        .select("k1", "k2", (F.col("a") - F.col("left")).alias("first"), (F.col("a") - F.col("right")).alias("last"))
    )
    local = entries.where("n = 0").select(
        "k1", "k2", (F.col("a") - F.col("left")).alias("first"), F.col("a").alias("last")
    )

    # Runs with an anchor that other runs have too: their bytes are fetched once.
    asked = (
        variants.join(company.select("g"), "g", "left_semi")
        .groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
        .agg(F.collect_list(F.struct("a", "g", "left", "right", "n")).alias("asked"))
    )
    wanted = keyed.join(asked, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")))

    def fetch(batches):
        last = None
        for batch in batches:
            for part in chunks(batch, max_bytes=PIECE):
                out: list[tuple] = []
                pairs = zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "asked")))
                for i, (k1, k2, spans) in enumerate(pairs):
                    if (k1, k2) == last:  # a row that repeats id and text
                        continue
                    last = (k1, k2)
                    text = part.column("text")[i].as_py().encode()
                    for s in spans:
                        cut = text[s["a"] - s["left"] : s["a"] - s["right"] + window]
                        out.append((k1, k2, s["a"], s["g"], s["left"], s["right"], s["n"], cut))
                columns = list(zip(*out)) or [()] * 8
                kinds = [*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                names = [field.split()[0] for field in CONTEXT.split(", ")]
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    contexts = stored(wanted.select("k1", "k2", "text", "asked").mapInArrow(fetch, CONTEXT), "suffix-contexts")

    def coarse(batches):
        for batch in _few(batches, 2048):
            data, offsets = _joined_bytes(batch)
            k1, k2, a, g, left, right, n = _numbers(batch, "k1", "k2", "a", "g", "left", "right", "n")
            row, digit = _ranged(right // STRIDE, left // STRIDE)
            anchor = (offsets[:-1] + left)[row]
            low = np.maximum(STRIDE * digit, right[row])
            high = np.minimum(STRIDE * digit + STRIDE - 1, left[row])
            core = anchor - STRIDE * digit, anchor + np.maximum(gram, window - STRIDE * (digit + 1))
            stride = anchor - high, anchor - low + window
            sums = [Sums(data, i) for i in (0, 1)]
            cores, strides = ([signed(s.spans(*span)) for s in sums] for span in (core, stride))
            yield _table([k1[row], k2[row], a[row], g[row], digit, *cores, low, high, *strides, n[row]], COARSE)

    # The second pass, with strides for what runs were in the first.
    second = stored(contexts.mapInArrow(coarse, COARSE), "suffix-second")
    group, stride = ["g", "digit", "c1", "c2"], ["low", "high", "s1", "s2"]
    strides = stored(
        second.groupBy(*group, *stride).agg(
            F.count("*").alias("_strides"), F.max("n").alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "a")]
        ),
        "suffix-strides",
    )
    whole_strides = (
        second.where("n = 1")
        .join(strides.where("_strides > 1").select(*group, *stride), [*group, *stride], "left_semi")
        .select("k1", "k2", (F.col("a") - F.col("high")).alias("first"), (F.col("a") - F.col("low")).alias("last"))
    )
    differing = strides.groupBy(*group).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    single = (F.col("_strides") == 1) & (F.col("n") == 1)
    going = (
        strides.join(differing, group, "left_semi")
        .groupBy("k1", "k2", "a")
        .agg(F.collect_list(F.struct("digit", F.when(single, 1).otherwise(2).alias("n"))).alias("digits"))
    )
    deeper = contexts.join(going, ["k1", "k2", "a"])

    def fine(batches):
        for batch in _few(batches, 1024):
            data, offsets = _joined_bytes(batch)
            k1, k2, a, g, left, right = _numbers(batch, "k1", "k2", "a", "g", "left", "right")
            lists = batch.column("digits")
            of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            told = lists.flatten()
            digit, n = (told.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            which, d = _ranged(np.maximum(STRIDE * digit, right[of]), np.minimum(STRIDE * digit + STRIDE - 1, left[of]))
            row = of[which]
            start = (offsets[:-1] + left)[row] - d
            hashes = [signed(Sums(data, i).spans(start, start + window)) for i in (0, 1)]
            yield _table([k1[row], k2[row], a[row] - d, g[row], d, *hashes, n[which]], FINE)

    columns = ["k1", "k2", "a", "g", "left", "right", "bytes", "digits"]
    third = stored(deeper.select(*columns).mapInArrow(fine, FINE), "suffix-third")
    group = ["g", "d", "f1", "f2"]
    equal = third.groupBy(*group).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    windows = (
        third.where("n = 1")
        .join(equal, group, "left_semi")
        .select("k1", "k2", F.col("start").alias("first"), F.col("start").alias("last"))
    )
    return whole.unionByName(local).unionByName(whole_strides).unionByName(windows)


def remove_repeats(docs: DataFrame, window: int = 400, gram: int | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept``, the bytes left.

    Removed is each byte of a ``window``-byte string that also starts anywhere else,
    in the same or another document, so every copy goes. Null text is empty. One row
    for each input row; rows that repeat id and text repeat each other. ``kept`` is
    binary, because a cut may fall within a character. ``gram`` (a quarter of the
    window) is the length of an anchor. Equality is of two 64-bit digests beside the
    anchor's. Other columns are ignored; an empty table gives no rows.
    """
    gram = gram or max(window // 4, 1)
    keyed = docs.select(
        F.col("doc_id"),
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = repeated_starts(keyed.select("k1", "k2", "text").where(F.octet_length("text") >= window), window, gram)
    spans = stored(
        found.groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(
            F.collect_set(F.struct("first", "last")).alias("spans")
        ),
        "suffix-spans",
    )
    joined = keyed.join(spans, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for part in chunks(batch):
                rows = []
                spans = part.column("spans")
                for i in range(part.num_rows):
                    text = part.column("text")[i].as_py().encode()
                    kept, removed, n_spans = text, 0, 0
                    if spans[i].is_valid:
                        firsts = spans[i].values.field("first").to_numpy()
                        lasts = spans[i].values.field("last").to_numpy()
                        steps = np.zeros(len(text) + 1, np.int64)
                        np.add.at(steps, firsts, 1)
                        np.add.at(steps, lasts + window, -1)
                        gone = np.cumsum(steps)[:-1] > 0
                        removed = int(gone.sum())
                        n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    rows.append((len(text), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
                kinds = [*[pa.int64()] * 3, pa.string(), pa.binary()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.record_batch([part.column("doc_id"), *columns], names)

    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
