"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two halves. Fingerprints at two or fewer differing
bits agree on the lower half, or differ by at most one bit in the upper one, so
probing the table of halves with the lower half itself and with the Hamming
ball of radius one around the upper half finds every pair; the whole distance
is then verified. Halves that many fingerprints share are left out of the table
and their members matched by the balls of radius one around whole fingerprints:
two fingerprints share a member of these balls just if they differ by at most
two bits, and a ball's centre has 65 members at most, so nothing is squared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .storage import stored

SEED = 42
CROWDED = 64  # fingerprints that share a half; beyond, whole balls are matched
SLICE = 1 << 16
FOLD = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of a text as a signed number; without words it is 0."""
    from xxhash import xxh64_intdigest

    folded = b" ".join(text.translate(FOLD).split())
    if not folded:
        return 0
    gaps = np.flatnonzero(np.frombuffer(folded, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(folded)][min(shingle, len(starts)) - 1 :]
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(ends), SLICE):
        spans = zip(starts[lo : lo + SLICE], ends[lo : lo + SLICE])
        hashes = np.array([xxh64_intdigest(folded[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(set_bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` and the fingerprint of ``text`` as a bigint; null text has no words."""

    def add(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
            yield batch.append_column(name, pa.array(found, pa.int64()))

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(add, ", ".join([*columns, f"`{name}` bigint"]))


def link(fingerprints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Edges ``(a, b)`` over distinct ``fp`` whose components are those of all pairs at 2 bits or fewer."""
    upper, lower = "shiftrightunsigned(fp, 32)", "(fp & 4294967295L)"
    tag = "shiftleft(1L, 32)"  # parts the upper halves from the lower ones
    cells = fingerprints.select("fp", F.explode(F.expr(f"array({lower}, {upper} + {tag})")).alias("cell"))
    ball = (  # each pair once: from the one whose bit is 0
        f"filter(transform(sequence(0, 31), i -> {upper} ^ shiftleft(1L, i)), v -> v > {upper})"
    )
    probes = fingerprints.select(
        F.col("fp").alias("a"),
        F.explode(
            F.expr(f"concat(array({lower}, {upper} + {tag}), transform({ball}, v -> v + {tag}))")
        ).alias("cell"),
    )
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    table = cells.join(sizes.where(F.col("n") <= crowded), "cell").withColumnRenamed("fp", "b")
    pairs = (
        probes.join(table, "cell")
        .where("a <> b and bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    members = (
        probes.join(sizes.where(F.col("n") > crowded), "cell").select(F.col("a").alias("fp")).distinct()
    )
    whole = "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))"
    balls = members.select("fp", F.explode(F.expr(whole)).alias("centre"))
    least = balls.groupBy("centre").agg(F.min("fp").alias("b"))
    stars = (
        balls.join(least, "centre")
        .where("fp <> b and bit_count(fp ^ b) <= 2")
        .select(F.col("fp").alias("a"), "b")
    )
    return pairs.unionByName(stars)


def groups(fingerprinted: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(fp, root, component_id)`` from rows of ``(doc_id, fp)``.

    ``root`` names the group, also one without ids; component_id is its smallest doc_id.
    """
    distinct = stored(
        fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints"
    )
    roots = connected(link(distinct.select("fp"), crowded))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return stored(rooted.join(least, "root").select("fp", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, shingle: int = 3, crowded: int = CROWDED) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id.

    One row for each input row. Texts without words share the fingerprint zero
    and are linked like any other. A group whose doc_ids are all null has a null
    component_id. An empty table gives no rows.
    """
    found = stored(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).drop("text"), "simhash")
    return found.join(groups(found, crowded), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, crowded: int = CROWDED) -> DataFrame:
    """The documents with one of each group left: that with the smallest doc_id.

    A document without an id is left only where its whole group has none; of several
    texts with the chosen id the one of least hash stays. Columns stay as they are.
    Rows that repeat a doc_id and a text count as one document.
    """
    name = "_simhash"
    while name in docs.columns:
        name += "_"
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = stored(with_fingerprint(hashed, "fp", shingle).drop("text"), "simhash")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = (
        found.join(groups(found, crowded).select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min(first).alias("keep"))
        .select(F.col("keep.doc_id").alias("_id"), F.col("keep.text_hash").alias("_hash"))
    )
    marked = docs.withColumn(name, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[name] == kept["_hash"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
