"""Repeated passages across documents, found by hashes and marked by Aho-Corasick automata.

Recurring windows of ``window`` words are confirmed first. A task drops, chunk
by chunk, what repeats inside the chunk: of equal windows only those of the
smallest doc_id are sent on, so a passage that half of all documents share
costs one entry a chunk. Entries go, packed, to the shard of their hash, where
the smallest doc_id of each window decides. Neighbouring confirmed windows then
make passages; the passages of a run of documents are compiled into one
automaton, and these documents stream through it, which finds the confirmed
places again and no others. A passage confirmed in a
document counts in every document with the same or a larger doc_id: each of its
windows starts in a smaller one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import partitions, stored
from .words import DARK, chunks, find_words, gram_hashes, mix, word_hashes

SENT_BYTES = 8 << 20  # text of a chunk within which windows are pre-aggregated
PACKED = "shard int, docs binary, of binary, places binary, hashes binary, n long"
SPANS = "doc_id long, text_hash long, starts binary"


def _windows(part: pa.RecordBatch, window: int):
    """(hash, row, place in the row's words) of every window of a chunk."""
    words = find_words(part.column("text"), DARK)
    grams = gram_hashes(word_hashes(words, lower=False), window)
    whole = np.flatnonzero(np.arange(len(grams)) + window <= words.last()[: len(grams)])
    row = words.text_of()[whole]
    return grams[whole], row, whole - words.bounds[row]


def _later(hashes: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
    """Marks the windows that are also in a smaller doc_id of the same arrays."""
    if not len(hashes):
        return np.zeros(0, bool)
    order = np.argsort(hashes)
    ranked = hashes[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    least = np.minimum.reduceat(doc_ids[order], begins)
    out = np.empty(len(hashes), bool)
    out[order] = doc_ids[order] > np.repeat(least, np.diff(np.append(begins, len(ranked))))
    return out


def _planes(values: np.ndarray) -> bytes:
    """Small numbers as four planes of bytes, of which the upper ones are nearly all zero and compress away."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    planes = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T)
    return planes.view("<i4")[:, 0].astype(np.int64)


def _packed(shard, shards: int, ids, texts, row, place, hashes) -> pa.RecordBatch:
    """A row a shard: the documents of its windows, then document, place and hash of each."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    out: list[tuple] = []
    for s in np.flatnonzero(np.diff(ends)):
        mine = order[ends[s] : ends[s + 1]]
        rows, of = np.unique(row[mine], return_inverse=True)
        table = np.stack([ids[rows], texts[rows]]).astype("<i8")
        steps = np.diff(of, prepend=0)
        first = np.concatenate([[True], steps[1:] != 0])
        gaps = np.where(first, place[mine], np.diff(place[mine], prepend=0))
        held = hashes[mine] if len(hashes) else hashes
        out.append((int(s), table.tobytes(), _planes(steps), _planes(gaps), held.tobytes(), len(mine)))
    kinds = [pa.int32(), *[pa.binary()] * 4, pa.int64()]
    columns = list(zip(*out)) or [()] * len(kinds)
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
    return pa.record_batch(arrays, ["shard", "docs", "of", "places", "hashes", "n"])


def _unpacked(group: pa.Table):
    """(doc_ids, text hashes) of documents, and (document, place, hash) of windows."""
    tables, of, places, hashes, base = [], [], [], [], 0
    for row in group.select(["docs", "of", "places", "hashes", "n"]).to_pylist():
        n = row["n"]
        table = np.frombuffer(row["docs"], "<i8").reshape(2, -1)
        tables.append(table)
        steps, gaps = _from_planes(row["of"], n), _from_planes(row["places"], n)
        of.append(np.cumsum(steps) + base)
        first = np.flatnonzero(np.concatenate([[True], steps[1:] != 0]))
        total = np.cumsum(gaps)
        before = np.repeat(total[first] - gaps[first], np.diff(np.append(first, n)))
        places.append((total - before).astype("<i4"))
        hashes.append(np.frombuffer(row["hashes"], "<u8"))
        base += table.shape[1]
    ids, texts = np.concatenate(tables, axis=1)
    return ids, texts, np.concatenate(of), np.concatenate(places), np.concatenate(hashes)


def _bucket(ids: np.ndarray, texts: np.ndarray, shards: int) -> np.ndarray:
    """Where the windows of a document are gathered again."""
    key = mix(ids.astype(np.uint64) ^ texts.astype(np.uint64))
    return (key % np.uint64(shards)).astype(np.int64)


def repeated_windows(docs: DataFrame, window: int, shards: int) -> DataFrame:
    """``(doc_id, text_hash, starts)``: where windows start that are also in a smaller doc_id, as 32-bit places."""
    known = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )

    none = np.zeros(0, "<u8")

    def scanned(batches, inside: bool):
        for batch in batches:
            for part in chunks(batch, max_bytes=SENT_BYTES):
                ids, texts = (part.column(i).to_numpy() for i in (0, 1))
                hashes, row, place = _windows(part, window)
                later = _later(hashes, ids[row])
                if inside:
                    row, place = row[later], place[later]
                    bucket = _bucket(ids, texts, shards)[row]
                    yield _packed(bucket, shards, ids, texts, row, place, none)
                else:
                    hashes, row, place = hashes[~later], row[~later], place[~later]
                    shard = (hashes % np.uint64(shards)).astype(np.int64)
                    yield _packed(shard, shards, ids, texts, row, place, hashes)

    def decide(group: pa.Table) -> pa.Table:
        ids, texts, row, place, hashes = _unpacked(group)
        later = _later(hashes, ids[row])
        row, place = row[later], place[later]
        bucket = _bucket(ids, texts, shards)[row]
        return pa.Table.from_batches([_packed(bucket, shards, ids, texts, row, place, none)])

    def gather(group: pa.Table) -> pa.Table:
        ids, texts, row, place, _ = _unpacked(group)
        order = np.lexsort([place, texts[row], ids[row]])
        d, t, p = ids[row][order], texts[row][order], place[order]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])]))
        starts = [p[a:b].tobytes() for a, b in zip(new, [*new[1:], len(p)])]
        columns = [pa.array(d[new]), pa.array(t[new]), pa.array(starts, pa.binary())]
        return pa.table(columns, ["doc_id", "text_hash", "starts"])

    across = (
        known.mapInArrow(lambda b: scanned(b, False), PACKED).groupBy("shard").applyInArrow(decide, PACKED)
    )
    return (
        known.mapInArrow(lambda b: scanned(b, True), PACKED)
        .unionByName(across)
        .groupBy("shard")
        .applyInArrow(gather, SPANS)
    )


def _passages(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Confirmed windows that touch or overlap as word spans."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    runs = np.split(places, cuts)
    return [(int(r[0]), int(r[-1]) + window) for r in runs]


def remove_passages(docs: DataFrame, window: int = 13, shards: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and ``kept``, the words left joined by one space.

    Removed is each word inside a window of ``window`` words that also starts in a
    document with a smaller doc_id. Null text has no words; documents with a null
    doc_id are kept whole and are no source. One row for each input row; rows that
    repeat a doc_id are judged alike, not against each other.
    """
    spark = docs.sparkSession
    found = repeated_windows(docs, window, shards or partitions(spark))
    spans = stored(found, "passages").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    joined = texts.join(spans, (texts["doc_id"] == spans["_id"]) & (texts["text_hash"] == spans["_hash"]), "left")

    def locate(batches):
        import ahocorasick

        for batch in batches:
            for part in chunks(batch):
                texts = [(t or "").encode().split() for t in part.column("text").to_pylist()]
                lines = [b" ".join([b"", *w, b""]).decode() for w in texts]
                gaps = [_gaps(line) for line in lines]
                ids = part.column("doc_id").to_pylist()
                automaton, seen = ahocorasick.Automaton(), {}
                for line, gap, doc_id, starts in zip(lines, gaps, ids, part.column("starts").to_pylist()):
                    if not starts:
                        continue
                    places = np.unique(np.frombuffer(starts, "<i4"))
                    for a, b in _passages(places, window):
                        passage = line[gap[a] : gap[b] + 1]
                        seen[passage] = min(doc_id, seen.get(passage, doc_id))
                for passage, doc_id in seen.items():
                    automaton.add_word(passage, (doc_id, len(passage)))
                if seen:
                    automaton.make_automaton()
                rows = []
                for words, line, gap, doc_id in zip(texts, lines, gaps, ids):
                    gone = np.zeros(len(words) + 1, np.int64)
                    if seen and doc_id is not None:
                        for end, (since, size) in automaton.iter(line):
                            if since <= doc_id:
                                gone[np.searchsorted(gap, end - size + 1)] += 1
                                gone[np.searchsorted(gap, end)] -= 1
                    left = np.cumsum(gone)[:-1] == 0
                    kept = b" ".join([w for w, keep in zip(words, left) if keep])
                    rows.append((len(words), int((~left).sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.record_batch(
                    [part.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
                )

    return joined.select("doc_id", "text", "starts").mapInArrow(
        locate, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def _gaps(line: str) -> np.ndarray:
    """Places of the blanks of a line, in characters; words here hold no blank."""
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4")
    return np.flatnonzero(codes == 0x20)
