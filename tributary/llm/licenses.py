"""Licences of files by sparse TF-IDF cosine, and of their directories by inheritance.

A file has its own licence if any line of its text, the whole text, or any run
of about as many words as a template is near enough to that template. Other
files take the licence of the licence file in the nearest directory above them.

Document frequencies of all words are counted in Spark. Tasks hold those of the
templates' words and of the most frequent others; any other word weighs at least
as much as the rarest they hold, which bounds a cosine from above. Only
what may then still be near enough has its remaining words joined to their weights.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored
from .words import Words, chunks, find_words, signed, word_hashes

NEAR = 0.8
KNOWN_WORDS = 20_000  # most frequent words whose weights tasks hold; bounds memory, not the result
HELD_COUNTS = 1 << 20  # counts that a task gathers before it sends them
SLACK = 1e-9  # of sums in floating point
LICENSE_FILE = "(?i)^(license|licence|copying|notice)([.].*)?$"

# Word characters: ASCII digits and letters.
ASCII_LETTERS = np.zeros(256, bool)
ASCII_LETTERS[0x30:0x3A] = ASCII_LETTERS[0x41:0x5B] = ASCII_LETTERS[0x61:0x7B] = True

PENDING = pa.list_(
    pa.struct(
        [
            ("name", pa.string()),
            ("dot", pa.float64()),
            ("square", pa.float64()),
            ("terms", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int64())),
        ]
    )
)
PENDING_TYPE = "array<struct<name string, dot double, square double, terms array<bigint>, counts array<bigint>>>"

# Notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

def _cut(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of each text and their hashes, in lower case."""
    for upper, lower in (("\u0130", "i\u0307"), ("\u212a", "k")):  # no other letter becomes an ASCII one
        texts = pc.replace_substring(texts, upper, lower)
    words = find_words(texts, ASCII_LETTERS)
    return words, word_hashes(words, lower=True)


def term_counts(files: DataFrame) -> DataFrame:
    """``(term, n)``: in how many files each word is, by its hash."""

    def merged(held):
        terms, where = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([n for _, n in held]), minlength=len(terms))
        return pa.record_batch([pa.array(signed(terms)), pa.array(n.astype(np.int64))], ["term", "n"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch):
                words, hashes = _cut(part.column("text"))
                terms, where = np.unique(hashes, return_inverse=True)
                each = np.unique(where * part.num_rows + words.text_of())
                held.append((terms, np.bincount(each // part.num_rows, minlength=len(terms))))
                size += len(terms)
                if size > HELD_COUNTS:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    rows = files.select("text").mapInArrow(count, "term long, n long")
    return stored(rows.groupBy("term").agg(F.sum("n").alias("n")), "term-counts")


class _Judge:
    """The templates' unit vectors and the weights that tasks hold."""

    def __init__(self, counts: DataFrame, total: int, templates: dict[str, str], near: float):
        self.names, self.near = sorted(templates), near
        cut = {name: _cut(pa.array([templates[name]]))[1] for name in self.names}
        vocabulary = np.unique(np.concatenate(list(cut.values())))
        listed = [int(t) for t in signed(vocabulary)]
        found = {t: 0 for t in listed}
        found.update((r.term, r.n) for r in counts.where(F.col("term").isin(listed)).collect())
        often = counts.orderBy(F.desc("n"), "term").limit(KNOWN_WORDS).collect()
        rarest = often[-1].n if len(often) == KNOWN_WORDS else 0
        found.update((r.term, r.n) for r in often)
        terms = np.array(list(found), np.int64).view(np.uint64)
        order = np.argsort(terms)
        n = np.array(list(found.values()), np.int64)[order]
        self.known = terms[order]
        self.weights = np.log((1 + total) / (1 + n)) + 1
        self.floor = math.log((1 + total) / (1 + rarest)) + 1
        # by template: the unit vector over the known words, and a last 0 for any other
        self.units, self.sizes = [], []
        for name in self.names:
            own, times = np.unique(cut[name], return_counts=True)
            unit = np.zeros(len(self.known) + 1)
            at = np.searchsorted(self.known, own)
            unit[at] = times * self.weights[at]
            self.units.append(unit / np.linalg.norm(unit))
            self.sizes.append(len(cut[name]))

    def judge(self, texts: pa.Array) -> list[tuple[str | None, float | None, list | None]]:
        """Of each text the licence and cosine, or what needs more weights to decide on."""
        words, hashes = _cut(texts)
        at = np.searchsorted(self.known, hashes)
        at[self.known[np.minimum(at, len(self.known) - 1)] != hashes] = len(self.known)
        sure = at < len(self.known)
        weight = np.append(self.weights, self.floor)[at]
        squares = np.concatenate([[0.0], np.cumsum(weight * weight)])
        last, fixed = words.last(), self._spans(words)
        tried = []
        for number, unit in enumerate(self.units):
            dots = unit[at] * weight
            sums = np.concatenate([[0.0], np.cumsum(dots)])
            for starts, ends in (fixed, *self._windows(np.flatnonzero(dots), last, self.sizes[number])):
                dot = sums[ends] - sums[starts]
                bound = dot / np.sqrt(squares[ends] - squares[starts])
                for i in np.flatnonzero(bound >= self.near - SLACK):
                    tried.append((bound[i], number, starts[i], ends[i]))
        by_text = {}
        for one in tried:
            by_text.setdefault(int(np.searchsorted(words.bounds, one[2], "right")) - 1, []).append(one)
        out = [(None, None, None)] * len(texts)
        for text, spans in by_text.items():
            out[text] = self._best(spans, hashes, at, sure, weight)
        return out

    def _spans(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Every line and every text that has words, as places among all words."""
        lines = np.searchsorted(words.starts, np.flatnonzero(words.data == 0x0A))
        edges, texts = np.unique(np.concatenate([lines, words.bounds])), np.unique(words.bounds)
        return np.concatenate([edges[:-1], texts[:-1]]), np.concatenate([edges[1:], texts[1:]])

    def _windows(self, starts: np.ndarray, last: np.ndarray, size: int):
        """Runs of words that begin with a word of the template, up to a quarter shorter or longer than it."""
        for length in range(size - size // 4, size + size // 4 + 1):
            starts = starts[starts + length <= last[starts]]
            yield starts, starts + length

    def _best(self, spans, hashes, at, sure, weight):
        found, known, pending = (self.near - SLACK), [], []
        for bound, number, a, b in sorted(spans, key=lambda x: (-x[0], x[1:])):
            if bound < found - SLACK:
                break
            terms, first, times = np.unique(hashes[a:b], return_index=True, return_counts=True)
            first += a
            square, held = (times * weight[first]) ** 2, sure[first]
            dot = float((times * weight[first] * self.units[number][at[first]]).sum())
            cosine = dot / math.sqrt(square.sum())  # with words not held, the most it can be
            entry = {
                "name": self.names[number],
                "dot": dot,
                "square": float(square[held].sum()),
                "terms": signed(terms[~held]).tolist(),
                "counts": times[~held].tolist(),
            }
            if not held.all():
                pending.append((cosine, entry))
            elif cosine >= self.near:
                found = max(found, cosine)
                known.append((-round(cosine, 9), self.names[number], cosine, entry))
        still = [entry for cosine, entry in pending if cosine >= found - SLACK]
        if still:
            return None, None, still + [min(known, key=lambda x: x[:2])[3]] if known else still
        if known:
            best = min(known, key=lambda x: x[:2])
            return best[1], best[2], None
        return None, None, None


def _decided(judged: DataFrame, counts: DataFrame, total: int, near: float) -> DataFrame:
    """``judged`` with the pending rows decided by the weights of all their words."""
    columns = ["key", "path", "is_license", "own", "similarity"]
    marks = [F.xxhash64("pending").alias("h"), F.xxhash64(F.lit(1), "pending").alias("g")]
    waiting = judged.where("pending is not null").select("*", *marks)
    asked = waiting.select("h", "g", "pending").dropDuplicates(["h", "g"])
    asked = asked.select("h", "g", F.posexplode("pending").alias("i", "x")).select("h", "g", "i", "x.*")
    idf = F.log((F.lit(total) + 1) / (F.col("n") + 1)) + 1
    rest = (
        asked.select("h", "g", "i", F.inline(F.arrays_zip("terms", "counts")))
        .withColumnsRenamed({"terms": "term", "counts": "times"})
        .join(counts, "term")
        .groupBy("h", "g", "i")
        .agg(F.sum(F.pow(F.col("times") * idf, F.lit(2))).alias("rest"))
    )
    cosine = F.col("dot") / F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0)))
    best = (
        asked.join(rest, ["h", "g", "i"], "left")
        .withColumn("cosine", cosine)
        .where(F.col("cosine") >= near)
        .groupBy("h", "g")
        .agg(F.min(F.struct((-F.round("cosine", 9)).alias("rank"), "name", "cosine")).alias("x"))
        .select("h", "g", F.col("x.name").alias("own"), F.col("x.cosine").alias("similarity"))
    )
    late = waiting.drop("own", "similarity").join(best, ["h", "g"], "left")
    return judged.where("pending is null").select(columns).unionByName(late.select(columns))


def own_licenses(files: DataFrame, templates: dict[str, str] = TEMPLATES, near: float = NEAR) -> DataFrame:
    """``files`` with ``own`` and ``similarity``: the nearest template of any line or run of words, the first by name on a tie."""
    counts, total = term_counts(files), files.count()
    judge = _Judge(counts, total, templates, near)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                own, similarity, pending = zip(*judge.judge(part.column("text")))
                yield pa.record_batch(
                    [
                        part.column("key"),
                        part.column("path"),
                        part.column("is_license"),
                        pa.array(own, pa.string()),
                        pa.array(similarity, pa.float64()),
                        pa.array(pending, PENDING),
                    ],
                    ["key", "path", "is_license", "own", "similarity", "pending"],
                )

    name = F.coalesce(F.element_at(F.split("path", "/"), -1), F.lit(""))
    marked = files.withColumn("is_license", name.rlike(LICENSE_FILE)).select("key", "path", "is_license", "text")
    kind = files.schema["key"].dataType.simpleString()
    judged = marked.mapInArrow(
        run, f"key {kind}, path string, is_license boolean, own string, similarity double, pending {PENDING_TYPE}"
    )
    return stored(_decided(stored(judged, "judged-files"), counts, total, near), "own-licenses")


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES, near: float = NEAR) -> DataFrame:
    """``(key, path, license, how, similarity)`` for ``files(key, path, text)``; ``how`` is own, inherited or null.

    Of several licence files in a directory the first by path and licence counts.
    Null texts have no licence of their own, null paths nothing to inherit.
    One row for each input row; an empty table gives none.
    """
    judged = own_licenses(files, templates, near)
    parents = "transform(sequence(1, size(split(path, '/')) - 1), i -> array_join(slice(split(path, '/'), 1, i), '/'))"
    above = F.expr(f"if(instr(path, '/') > 0, concat(array(''), {parents}), array(''))")
    held = (
        judged.where("is_license and own is not null")
        .groupBy(F.element_at(above, -1).alias("dir"))
        .agg(F.min(F.struct("path", "own")).alias("x"))
        .select("dir", F.col("x.own").alias("license"))
    )
    places = (
        judged.where("own is null and path is not null").select("path").distinct()
        .select("path", F.posexplode(above).alias("depth", "dir"))
        .join(held, "dir")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "license")).alias("x"))
        .select(F.col("path").alias("_path"), F.col("x.license").alias("inherited"))
    )
    return judged.join(places, judged["path"] == places["_path"], "left").select(
        "key",
        "path",
        F.coalesce("own", "inherited").alias("license"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").alias("how"),
        "similarity",
    )
