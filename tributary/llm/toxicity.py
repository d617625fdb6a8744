"""Toxicity by weak supervision.

Words and word beginnings that mark toxic texts are mined from training labels
and dealt to voters, some of whole words and some of beginnings. A generative
model of their votes over all documents estimates by expectation maximization
how often each voter speaks on toxic and on other texts; voters that agree
more than the model allows are correlated and count less. A linear classifier
over the same marks is then fitted to the model's posterior labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import FILTER_BITS, hash_filter
from .storage import stored
from .words import LETTERS, Words, chunks, find_words, mix, signed, word_hashes

SAMPLE_ROWS = 20_000  # labelled rows that the classifier is fitted to
BEGINNINGS = (3, 4, 5, 6)  # bytes
PRIOR_ROWS = 4.0  # rows of the overall toxic share that a mark's own rows are smoothed with
MIN_ODDS = 2.0  # log odds of a mark over the overall ones, smoothed
MARKS = 600  # the strongest; bounds the classifier
HELD_COUNTS = 1 << 20  # counts that a task gathers before it sends them
VOTERS = 12  # of whole words, and as many of beginnings
ROUNDS = 12
RIDGE = 1.0
TABLE_BITS = 20


@dataclass
class Model:
    marks: np.ndarray  # sorted hashes
    voter: np.ndarray  # the voter of each mark
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; no label of these is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _kinds(words: Words):
    """(kind, words that have it, hashes): whole words as kind 0, then beginnings by their length."""
    size = words.ends - words.starts
    yield 0, np.arange(len(size)), word_hashes(words, lower=True)
    for prefix in BEGINNINGS:
        longer = np.flatnonzero(size > prefix)
        some = words._replace(starts=words.starts[longer], ends=words.ends[longer])
        yield prefix, longer, mix(word_hashes(some, lower=True, prefix=prefix) + np.uint64(prefix))


def labelled_sample(training: DataFrame, rows: int) -> DataFrame:
    """Up to ``rows`` of the labelled texts at hand, those of least hash.

    Labels of documents that are not here have no text, so they use up none of the sample.
    """
    place = F.xxhash64("text")
    last = training.select(place.alias("place")).orderBy("place").limit(rows).agg(F.max("place")).first()[0]
    return training.where(F.lit(False) if last is None else place <= last)


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)`` of all labelled training rows; equal texts once, toxic if one of them is.

    A filter of labelled ids, 1 MB whatever their number, keeps most other texts
    out of the shuffle; the joins are exact.
    """
    told = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    held = docs.sparkSession.sparkContext.broadcast(hash_filter(told.select(F.xxhash64("doc_id").alias("hash"))))

    def listed(batches):
        bits = np.unpackbits(np.frombuffer(held.value, np.uint8), bitorder="little")
        for batch in batches:
            place = batch.column("hash").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            yield batch.filter(pa.array(bits[place] > 0)).select(["doc_id", "text", "text_hash"])

    usable = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    hashed = usable.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    near = hashed.withColumn("hash", F.xxhash64("doc_id")).mapInArrow(
        listed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, text_hash long"
    )
    picked = (
        hashed.select("doc_id", "text_hash").join(told, "doc_id")
        .groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    )
    found = near.join(picked, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    return found.select("text", "toxic")


def mine_marks(rows: DataFrame, keep: int = MARKS) -> list[tuple[int, int]]:
    """The ``keep`` strongest ``(hash, kind)`` of ``(text, toxic)``; counts are by document."""

    def merged(held):
        terms, where = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        kind = np.zeros(len(terms), np.int64)
        kind[where] = np.concatenate([h[1] for h in held])
        bad, good = (np.bincount(where, np.concatenate([h[i] for h in held]), len(terms)) for i in (2, 3))
        columns = [signed(terms), kind, bad.astype(np.int64), good.astype(np.int64)]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["mark", "kind", "bad", "good"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch):
                words = find_words(part.column("text"), LETTERS)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False) > 0
                of = words.text_of()
                for kind, places, hashes in _kinds(words):
                    marks, where = np.unique(hashes, return_inverse=True)
                    each = np.unique(where * part.num_rows + of[places])
                    n = np.bincount(each // part.num_rows, minlength=len(marks))
                    n_bad = np.bincount(each // part.num_rows, toxic[each % part.num_rows], len(marks))
                    held.append((marks, np.full(len(marks), kind), n_bad, n - n_bad))
                    size += len(marks)
                if size > HELD_COUNTS:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    totals = rows.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    overall = (totals[0] + 0.5) / (totals[0] + totals[1] + 1.0)
    odds = F.log((F.col("bad") + PRIOR_ROWS * overall) / (F.col("good") + PRIOR_ROWS * (1 - overall)))
    found = (
        rows.mapInArrow(count, "mark long, kind long, bad long, good long")
        .groupBy("mark", "kind")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where("bad > 0")
        .withColumn("odds", odds - math.log(overall / (1 - overall)))
        .where(F.col("odds") >= MIN_ODDS)
        .orderBy((F.col("odds") * F.sqrt("bad")).desc(), "mark")
        .limit(keep)
    )
    return [(r.mark, r.kind) for r in found.collect()]


def _deal(found: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the voter of each: words and beginnings apart, in turn by strength."""
    place, dealt = {0: 0, 1: 0}, []
    for mark, kind in found:
        side = int(kind > 0)
        dealt.append((mark & ((1 << 64) - 1), side * VOTERS + place[side] % VOTERS))
        place[side] += 1
    dealt.sort()
    return np.array([m for m, _ in dealt], np.uint64), np.array([v for _, v in dealt], np.int64)


def _present(texts: pa.Array, marks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, mark) pairs, each once: which marks are in which texts."""
    words = find_words(texts, LETTERS)
    of, hits = words.text_of(), []
    for _, places, hashes in _kinds(words):
        near = np.flatnonzero(table[hashes >> np.uint64(64 - TABLE_BITS)])
        place = np.searchsorted(marks, hashes[near])
        same = marks[np.minimum(place, len(marks) - 1)] == hashes[near] if len(marks) else np.zeros(0, bool)
        hits.append(of[places[near[same]]] * len(marks) + place[same])
    hits = np.unique(np.concatenate(hits))
    return (hits // len(marks), hits % len(marks)) if len(marks) else (hits, hits)


def _lookup(marks: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << TABLE_BITS, bool)
    table[marks >> np.uint64(64 - TABLE_BITS)] = True
    return table


def vote_patterns(docs: DataFrame, marks: np.ndarray, voter: np.ndarray) -> DataFrame:
    """``(votes, n)``: how many documents show each pattern of votes, as bits."""

    def run(batches):
        table = _lookup(marks)
        for batch in batches:
            for part in chunks(batch):
                text, mark = _present(part.column("text"), marks, table)
                votes = np.zeros(part.num_rows, np.int64)
                np.bitwise_or.at(votes, text, np.left_shift(1, voter[mark]))
                yield pa.record_batch([pa.array(votes)], ["votes"])

    return docs.select("text").mapInArrow(run, "votes long").groupBy("votes").agg(F.count("*").alias("n"))


def label_model(
    patterns: DataFrame, speaks: np.ndarray, silent: np.ndarray, prior: float, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Log-likelihood ratio of each voter's silence and vote, ``(2, voters)``, and the prior log odds.

    Starts from the rates of votes on toxic texts (``speaks``) and on others
    (``silent``) that training labels show, and runs on all documents: each
    round is one sum over their vote patterns.
    """
    voters = len(speaks)
    bit = [F.shiftright("votes", j).bitwiseAND(1).cast("double") for j in range(voters)]
    n = F.col("n").cast("double")
    share = np.ones(voters)  # how far a voter counts, for its correlations
    for round_ in range(rounds):
        ratio = _ratios(speaks, silent, share)
        logit = F.lit(float(math.log(prior / (1 - prior)) + ratio[0].sum()))
        for j in range(voters):
            logit = logit + bit[j] * float(ratio[1][j] - ratio[0][j])
        weighed = patterns.withColumn("p", 1 / (1 + F.exp(-logit)) * n)
        sums = [F.sum(n), F.sum("p")]
        sums += [F.sum(b * F.col("p")) for b in bit] + [F.sum(b * n) for b in bit]
        if round_ == rounds // 2:  # by now rates are near; look for agreement beyond them
            pairs = [(i, j) for i in range(voters) for j in range(i)]
            sums += [F.sum(bit[i] * bit[j] * n) for i, j in pairs]
        row = np.array([x or 0.0 for x in weighed.agg(*sums).first()])
        total, toxic = max(row[0], 1.0), row[1]
        bad, every = row[2 : 2 + voters], row[2 + voters : 2 + 2 * voters]
        speaks = (bad + 0.5) / (toxic + 1)
        silent = (every - bad + 0.05) / (total - toxic + 1)
        prior = min(max(toxic / total, 1e-6), 0.5)
        if round_ == rounds // 2:
            share = _shares(row[2 + 2 * voters :], pairs, speaks, silent, prior, every, total)
    return _ratios(speaks, silent, share), math.log(prior / (1 - prior))


def _ratios(speaks, silent, share) -> np.ndarray:
    return np.stack([np.log((1 - speaks) / (1 - silent)), np.log(speaks / silent)]) * share


def _shares(both, pairs, speaks, silent, prior, every, total) -> np.ndarray:
    """1 / (1 + the correlations that conditional independence does not explain)."""
    excess = np.zeros(len(speaks))
    for seen, (i, j) in zip(both, pairs):
        expected = prior * speaks[i] * speaks[j] + (1 - prior) * silent[i] * silent[j]
        a, b = every[i] / total, every[j] / total
        spread = math.sqrt(max(a * (1 - a) * b * (1 - b), 1e-18))
        found = max(0.0, (seen / total - expected) / spread)
        if found > 0.05:
            excess[i] += found
            excess[j] += found
    return 1 / (1 + excess)


def fit(presence: np.ndarray, labels: np.ndarray, counts: np.ndarray, ridge: float = RIDGE, steps: int = 25):
    """Weights and bias of a ridge logistic regression on soft labels of rows seen ``counts`` times, by Newton steps."""
    w, bias = np.zeros(presence.shape[1]), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(presence @ w + bias, -30, 30)))
        miss, spread = counts * (p - labels), counts * p * (1 - p)
        cross = presence.T @ spread
        curve = np.empty((len(w) + 1, len(w) + 1))
        curve[:-1, :-1] = (presence.T * spread) @ presence + np.diag(np.full(len(w), ridge))
        curve[-1, :-1] = curve[:-1, -1] = cross
        curve[-1, -1] = spread.sum() + 1e-6
        step = np.linalg.solve(curve, np.append(presence.T @ miss + ridge * w, miss.sum()))
        w, bias = w - step[:-1], bias - step[-1]
        if np.abs(step).max() < 1e-6:
            break
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, marks: int = MARKS) -> Model:
    """Learn from the texts of all documents and from training labels.

    Marks are counted over all training labels; the classifier is fitted to ``sample_rows`` of them.
    Without marks, or where the labels of the documents at hand are all alike, every score is 0.
    """
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), -30.0)
    training = stored(training_texts(docs, labels), "toxic-training")
    sample = stored(labelled_sample(training, sample_rows), "toxic-sample")
    if sample.select((F.col("toxic") > 0).alias("bad")).distinct().count() < 2:
        return nothing
    hashes, voter = _deal(mine_marks(training, marks))
    if not len(hashes):
        return nothing
    def present(batches):
        table = _lookup(hashes)
        for batch in batches:
            for part in chunks(batch):
                text, mark = _present(part.column("text"), hashes, table)
                counts = np.bincount(text, minlength=part.num_rows)
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                marks = pa.ListArray.from_arrays(ends, pa.array(mark, pa.int64()))
                yield pa.record_batch([marks, part.column("toxic").cast(pa.int32())], ["marks", "toxic"])

    rows = (  # bounded by the sample; most of its texts have no marks and make one row
        sample.mapInArrow(present, "marks array<long>, toxic int")
        .groupBy("marks")
        .agg(F.count("*").alias("n"), F.count_if(F.col("toxic") > 0).alias("bad"))
        .orderBy("marks")
        .collect()
    )
    x = np.zeros((len(rows), len(hashes)))
    votes = np.zeros((len(rows), 2 * VOTERS), bool)
    for i, row in enumerate(rows):
        x[i, row.marks] = 1
        votes[i, voter[row.marks]] = True
    counts, bad = (np.array([r[c] for r in rows], float) for c in ("n", "bad"))
    good = counts - bad
    ratios, prior = label_model(
        stored(vote_patterns(docs, hashes, voter), "votes"),
        (bad @ votes + 0.5) / (bad.sum() + 1),
        (good @ votes + 0.05) / (good.sum() + 1),
        min(max(bad.sum() / counts.sum(), 1e-6), 0.5),
    )
    logit = prior + np.where(votes, ratios[1], ratios[0]).sum(axis=1)
    weights, bias = fit(x, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), counts)
    return Model(hashes, voter, weights, bias)


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """All columns of ``docs`` and the score of ``text``; null text scores as an empty one."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        table = _lookup(m.marks)
        for batch in batches:
            for part in chunks(batch):
                text, mark = _present(part.column("text"), m.marks, table)
                logit = m.bias + np.bincount(text, weights=m.weights[mark], minlength=part.num_rows)
                yield part.append_column(name, pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*columns, f"`{name}` double"]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. One row for each input row.

    Labels are only learned from; several rows for a document count as toxic if
    one of them does, and null labels are left out.
    """
    model = train(docs, labels)
    return with_score(docs.select("doc_id", "text"), model, "score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under 0.5; columns stay as they are."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, train(docs, labels), name).where(F.col(name) < 0.5).drop(name)
