"""Token ids of documents in flat binary files that can be memory-mapped.

One file a shard: the ids of its documents from byte 0 on as unsigned integers
(16 bits if the vocabulary fits, else 32), each document closed by the end id;
then as signed 64-bit integers the document ids, ``n + 1`` token offsets inside
the shard, ``n``, the shard number and a mark; last one more end id, which the
line writer adds. Shards hold ascending ranges of doc_id; the place of a
document among all ids is the sum of the earlier shards plus its offset.

Files are written by Spark's own text writer (rows are the raw bytes, the "line
separator" is the end id), so any file system Spark knows will do, and a task
that runs again leaves one file.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import partitions, stored

MARK = 0x544F4B454E533031
NO_ID = -(1 << 63)  # stands for a null doc_id in the files
KNOWN_PIECES = 300_000  # pieces a Python worker remembers from task to task, beside as many older ones
LONGEST_KNOWN = 64  # characters; longer pieces are encoded each time
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
MARKS = r"!-/:-@\[-`{-~"
# Words between spaces; of words of Latin letters with marks behind them, both parts.
PIECES = re.compile(f"[{LATIN}]++(?=[{MARKS}]*+ )|[{MARKS}]++(?= )|[^ ]++").findall
LETTERS = re.compile(f"[{LATIN}]+").fullmatch
# Beyond these are marks that may join the letter before them, some with small letters alone.
BEYOND_LATIN = re.compile("[^\x00-\u02ff\u2000-\u206f]").search


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


class Encoder:
    """Encodes texts piece by piece, remembering the ids of pieces.

    Right for tokenizers that drop white space, fold case and never join letters
    with anything else, like the public ``word_bpe_49k``; ``tests/llm`` holds it
    against encoding whole texts.
    """

    def __init__(self, tokenizer_file: str, kind: np.dtype):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.kind = kind
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """The same for words of letters alone, in one call: a piece each."""
        if not words:
            return []
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found[0].ids, self.kind)
        ends = ((np.flatnonzero(self.closes[ids]) + 1) * ids.itemsize).tolist()
        if len(ends) != len(words):
            return self._each(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, pieces: set[str]) -> None:
        letters, others = [], []
        for piece in pieces:
            (letters if LETTERS(piece) else others).append(piece)
        self.known.update(zip(letters, self._letters(letters)))
        self.known.update(zip(others, self._each(others)))

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as bytes."""
        split = [PIECES(lowered(t)) for t in texts]
        here = set().union(*split)
        new = here.difference(self.known)
        if len(self.known) + len(new) > KNOWN_PIECES:  # those of late stay, in case they come again
            self.older, self.known = self.known, {}
            new = here
        again = {p: self.older[p] for p in new if p in self.older}
        self.known.update(again)
        long = [p for p in new if len(p) > LONGEST_KNOWN]
        self._learn(new.difference(again, long))
        once = dict(zip(long, self._each(long)))
        known = ChainMap(once, self.known) if once else self.known
        return (b"".join(map(known.__getitem__, pieces)) for pieces in split)


def lowered(text: str) -> str:
    """``text`` with blanks alone for space, one at the end, and A-Z in lower case.

    The tokenizer folds case itself; where it can tell the two before, the case stays.
    """
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ") + " "
    if "<|" in text or not text.isascii() and BEYOND_LATIN(text):
        return text
    return text.encode().lower().decode()


@lru_cache(1)
def encoder(tokenizer_file: str, kind: np.dtype) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(tokenizer_file, kind)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    vocabulary: int,
    end_id: int = 1,
    shards: int | None = None,
) -> None:
    """Write the ids of all documents below ``path`` in ascending doc_id order.

    Null text is empty; a null doc_id sorts first; repeated doc_ids are all
    written, in the order of their texts. Other columns are not read.
    """
    kind = id_type(vocabulary)
    blob = pa.schema([("value", pa.binary())])

    def shard(batches):
        encode = encoder(tokenizer_file, kind).batch
        ids, sizes, rows = [], [], 256
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                found = list(encode([t or "" for t in part.column(1).to_pylist()]))
                ids.append(part.column(0).fill_null(NO_ID).to_numpy())
                sizes.append(np.array([len(x) for x in found]) // kind.itemsize + 1)
                yield pa.record_batch([pa.array(found, pa.binary())], blob)
        if ids:
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            number = TaskContext.get().partitionId()
            tail = [np.concatenate(ids), ends, [len(ends) - 1, number, MARK]]
            whole = np.concatenate(tail).astype("<i8").tobytes()
            yield pa.record_batch([pa.array([whole], pa.binary())], blob)

    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange(shards or partitions(docs.sparkSession), *order)
        .sortWithinPartitions(*order, "text")
        .mapInArrow(shard, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", np.array([end_id], kind).tobytes().decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


def parse_shard(content, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Ids, document ids, offsets and number of a shard; ``content`` may be a memory map."""
    end = len(content) - kind.itemsize
    n, number, mark = np.frombuffer(content[end - 24 : end], "<i8")
    if mark != MARK:
        raise ValueError("not a token shard")
    tail = np.frombuffer(content[end - 24 - 8 * (2 * n + 1) : end - 24], "<i8")
    doc_ids, offsets = tail[:n], tail[n:]
    return np.frombuffer(content, kind, int(offsets[-1])), doc_ids, offsets, int(number)


def open_shard(file: str, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same from a file of this machine, memory-mapped."""
    return parse_shard(np.memmap(file, np.uint8, "r"), kind)


def read_tokens(spark: SparkSession, path: str, vocabulary: int) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of its ids.

    An empty table wrote no shard and gives no rows.
    """
    kind = id_type(vocabulary)
    out = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "shard", "offset", "n_tokens", "ids_crc32")]
    )

    def documents(batches):
        for batch in batches:
            for content in batch.column(0):
                if not len(content.as_buffer()):
                    continue
                ids, doc_ids, offsets, number = parse_shard(memoryview(content.as_buffer()), kind)
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1], offsets[1:])
                ]
                known = pa.array(doc_ids, mask=doc_ids == NO_ID)
                shard = np.full(len(doc_ids), number)
                columns = [known, shard, offsets[:-1], np.diff(offsets), sums]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    columns = "doc_id long, shard long, offset long, n_tokens long, ids_crc32 long"
    found = stored(files.select("content").mapInArrow(documents, columns), "tokens-read")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # a row a shard
        found.groupBy("shard")
        .agg(F.sum("n_tokens").alias("_n"))
        .select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    return found.join(bases, "shard").select(
        "doc_id", (F.col("_base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
