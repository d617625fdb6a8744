"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Each rule looks only at the documents that the rules before it let through. The
order comes from a sample: every rule runs on all of it, and rules are sorted by
the share they reject over the time they take. A document is kept if no rule
rejects it, so the order decides the time and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import DARK, chunks, find_words, gram_hashes, mix, text_bytes, word_hashes

SAMPLE_ROWS = 2000  # documents on which cost and selectivity are estimated

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


class Measures:
    """What rules look at, for several texts at once; each measure is taken when first asked for."""

    def __init__(self, texts: pa.Array):
        self.texts = texts

    def only(self, rows: np.ndarray) -> Measures:
        return Measures(self.texts.take(pa.array(rows)))

    def _per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return np.diff(sums[self._bytes[1]])

    @cached_property
    def _bytes(self):
        return text_bytes(self.texts)

    @cached_property
    def _words(self):
        return find_words(self.texts, DARK)

    @cached_property
    def n_words(self) -> np.ndarray:
        return self._words.counts

    @cached_property
    def word_chars(self) -> np.ndarray:
        data = self._bytes[0]
        return self._per_text(DARK[data] & ((data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(SYMBOLS[self._bytes[0]])

    @cached_property
    def n_exclamations(self) -> np.ndarray:
        return self._per_text(self._bytes[0] == ord("!"))

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        total, repeated = [], []
        for text in self.texts.to_pylist():
            lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
            total.append(len(lines))
            repeated.append(len(lines) - len(set(lines)))
        return np.array(total, np.int64), np.array(repeated, np.int64)

    @property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        words = self._words
        grams = gram_hashes(word_hashes(words, lower=False), 3)
        whole = np.arange(len(grams)) + 3 <= words.last()[: len(grams)]
        places, of = np.flatnonzero(whole), words.text_of()
        keys = grams[places] ^ mix(of[places].astype(np.uint64))
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        covered = np.zeros(len(words.starts), bool)
        for step in range(3):
            covered[places[again] + step] = True
        return np.bincount(of[covered], minlength=len(words.bounds) - 1)


@dataclass(frozen=True)
class Rule:
    """Marks the texts that it rejects."""

    name: str
    rejects: Callable[[Measures], np.ndarray]


BASE = [
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
]
RULES = [
    *BASE,
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("shouting", lambda m: 2 * m.n_exclamations > m.n_words),
    Rule("repeated_lines", lambda m: 10 * m.n_dup_lines > 5 * m.n_lines),
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 20 * m.n_words),
]


def rule_costs(docs: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds a text and share rejected of each rule, on about ``rows`` ids of least hash.

    The share of ids taken follows from the row count, so tasks send only the texts that are
    measured, one of each id. One task measures them; only its figures come to the driver.
    """
    names = [r.name for r in rules]

    def measure(batches):
        cost, rejected, seen = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            for part in chunks(batch):
                seen += part.num_rows
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected[i] += rule.rejects(Measures(part.column("text"))).sum()
                    cost[i] += time.perf_counter() - began
        if seen:
            yield pa.record_batch(
                [pa.array(names), pa.array(cost / seen), pa.array(rejected / seen)],
                ["rule", "cost", "rejected"],
            )

    share = min(1.0, rows / max(docs.count(), 1))
    greatest = min(int(-(2**63) + share * 2**64), 2**63 - 1)
    sample = (
        docs.select(F.xxhash64("doc_id").alias("key"), "text")
        .where(F.col("key") <= greatest)
        .groupBy("key")
        .agg(F.min("text").alias("text"))
    )
    found = sample.select("text").coalesce(1).mapInArrow(measure, "rule string, cost double, rejected double")
    return [r.asDict() for r in found.collect()]


def cascade_order(costs: list[dict], rules: list[Rule] = RULES) -> list[Rule]:
    """Rules by share rejected per second, best first; as given where nothing was measured."""
    worth = {c["rule"]: c["rejected"] / max(c["cost"], 1e-9) for c in costs}
    return sorted(rules, key=lambda r: -worth.get(r.name, 0.0))


def first_rejection(measures: Measures, rules: list[Rule]) -> np.ndarray:
    """The place of the first rule that rejects each text, -1 if none does."""
    verdict = np.full(len(measures.texts), -1)
    left, held = np.arange(len(verdict)), measures
    for place, rule in enumerate(rules):
        if not len(left):
            break
        bad = np.asarray(rule.rejects(held), bool)
        verdict[left[bad]] = place
        if bad.any():
            left = left[~bad]
            held = measures.only(left)
    return verdict


def judge(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: the base measures, ``kept`` and the name of the rule that rejected it first.

    Null text counts as empty, has no words and is rejected; which of several
    rules is named depends on the order found. One row for each input row; an
    empty table gives none. Other columns are not read.
    """
    ordered = cascade_order(rule_costs(docs, rules, sample_rows), rules)
    names = pa.array([r.name for r in ordered], pa.string())
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                texts = part.column("text")
                measures = Measures(texts)
                first = first_rejection(measures, ordered)
                columns = [part.column("doc_id")]
                columns += [pa.array(getattr(measures, c), pa.int64()) for c in counts]
                columns.append(pa.array(first < 0))
                columns.append(names.take(pa.array(first, mask=first < 0)))
                yield pa.record_batch(columns, ["doc_id", *counts, "kept", "rule"])

    longs = ", ".join(f"{c} long" for c in counts)
    return (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(run, f"doc_id long, {longs}, kept boolean, rule string")
        .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    )
