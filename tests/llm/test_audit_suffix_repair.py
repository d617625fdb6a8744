"""Filter audit, suffix dedup and conversation repair against plain Python, on odd and on made rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tributary.literals import literal_table
from tributary.llm import conversation_repair, filter_audit, suffix_dedup
from tributary.schemas import struct


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- filter audit ----------------------------------------------------------------


def plain_masks(rows):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = Counter()
    for doc_id, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            doc_id is not None and least[text] < doc_id,
        ]
        out[doc_id, part or "", sum(f << i for i, f in enumerate(fails))] += 1
    return out


def plain_report(masks, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {p for _, p, _ in masks}:
        mine = [(d, m, n) for (d, p, m), n in masks.items() if p == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = mine, []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                removed = [r for r in left if r[1] & bit]
                redundant = sum(n for _, m, n in gone if m & bit)
                left = [r for r in left if not r[1] & bit]
                gone = gone + removed
                shapley[letter] += sum(n for *_, n in removed)
                out[part, "".join(order), step] = [
                    sum(n for *_, n in left),
                    sum(n for *_, n in removed),
                    redundant,
                    sum(n for _, m, n in mine if m == bit),
                    sum(n for d, _, n in removed if d in good),
                    sum(n for d, _, n in removed if d in toxic),
                ]
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[letter])
    return sorted((*k, *v) for k, v in out.items())


def audit_rows(seed):
    rng = random.Random(seed)
    bodies = ["", None, "a b c", "A B C", "x $ y", " ".join(f"w{i}" for i in range(120)), "w " * 130, "Ä" * 9 + "AB"]
    bodies += ["shared beginning " * 40 + tail for tail in ("", "a", "b", "ab", "é", "e")]
    rows = [(rng.choice([None, *range(40)]), rng.choice(bodies), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    return [*rows, *rows[:20], *[(100 + i, "copy of one text", "en") for i in range(90)]]


AUDIT_COLUMNS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
]


@pytest.mark.parametrize(("seed", "chunk", "step"), [(1, 1 << 25, 1 << 18), (2, 3000, 50), (3, 400, 1)])
def test_masks_and_report_equal_plain_python(spark, seed, chunk, step):
    rows = audit_rows(seed)
    docs = literal_table(spark, rows, struct("doc_id bigint, text string, lang string")).repartition(3)
    # Columns with the names used inside do no harm.
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("mask", "n", "part", "cut", "range", "_id", "good")])
    found = filter_audit.masks(docs, ranges=5, chunk=chunk, step=step)
    expected = plain_masks(rows)
    got = Counter()
    for doc_id, part, mask, n in found.select("doc_id", "part", "mask", "n").collect():
        got[doc_id, part, mask] += n
    assert got == expected
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 200, 3)] + [(3, 0, 0), (3, None, 1), (None, 1, 1), (5000, 1, 1)]
    told = literal_table(spark, labels, struct("doc_id bigint, quality int, toxic int"))
    report = filter_audit.report(found, told)
    assert sorted(map(tuple, report.select(*AUDIT_COLUMNS).collect())) == plain_report(expected, labels)


def test_audit_of_nothing(spark):
    docs = literal_table(spark, [], struct("doc_id bigint, text string, lang string"))
    labels = literal_table(spark, [], struct("doc_id bigint, quality int, toxic int"))
    assert filter_audit.report(filter_audit.masks(docs), labels).collect() == []


def test_long_texts_are_counted_whole():
    text = b"one two " * 300_000 + b"three"
    assert filter_audit.word_counts(text) == (600_001, 3)
    assert filter_audit.word_counts(b"x" * (3 << 20)) == (1, 1)


def test_trie_holds_the_least_id_of_each_text():
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab", k=rng.randrange(9))).encode() for _ in range(400)]
    trie, least = filter_audit.RadixTrie(), {}
    for i, text in enumerate(texts):
        trie.insert(text, 1000 - i)
        least[text] = 1000 - i
    found = [(t.text, t.least) for t, _ in trie.traverse()]
    assert found == sorted(least.items())
    ordered = sorted(least)
    for (terminal, cut), earlier in zip(list(trie.traverse())[1:], ordered):
        assert earlier < terminal.text[:cut] <= terminal.text


# --- suffix dedup ------------------------------------------------------------------


def plain_suffix(texts, window):
    found = Counter()
    raw = [(t or "").encode() for t in texts]
    for t in raw:
        for i in range(len(t) - window + 1):
            found[t[i : i + window]] += 1
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if found[t[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def suffix_texts(seed):
    rng = random.Random(seed)

    def prose(size):
        return "".join(rng.choices("abcdeé \n", k=size))

    shared = [prose(rng.randrange(30, 160)) for _ in range(8)]
    texts = [None, "", "a", "ab" * 90, "a" * 300, "a" * 41, prose(39)]
    for _ in range(60):
        parts = [rng.choice(shared)[rng.randrange(20) :] if rng.random() < 0.5 else prose(rng.randrange(80)) for _ in range(6)]
        texts.append("".join(parts))
    whole = prose(400)
    texts += [whole] * 4
    for _ in range(8):  # near copies with one change each
        at = rng.randrange(400)
        texts.append(whole[:at] + "#" + whole[at + rng.randrange(2) :])
    return texts


@pytest.mark.parametrize(("seed", "window", "gathered"), [(1, 40, 1 << 25), (2, 41, 500), (3, 64, 1), (4, 21, 2000)])
def test_windows_are_those_of_plain_python(spark, monkeypatch, seed, window, gathered):
    texts = suffix_texts(seed)
    ids = [None if i % 17 == 3 else i // 2 for i in range(len(texts))]
    rows = [*zip(ids, texts), (5, texts[10]), (5, texts[10])]
    docs = literal_table(spark, rows, struct("doc_id bigint, text string")).repartition(4)
    clashing = ("k1", "k2", "_k1", "spans", "kept", "first")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in clashing])
    monkeypatch.setattr(suffix_dedup, "GATHERED", gathered)
    got = suffix_dedup.remove_repeats(docs, window)
    plain = plain_suffix([t for _, t in rows], window)
    expected = sorted(((i, *r) for (i, _), r in zip(rows, plain)), key=repr)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    found = sorted(((*r[:5], bytes(r[5])) for r in got.select(*columns).collect()), key=repr)
    assert found == expected


def test_runs_hold_every_window_once_and_agree():
    """Equal windows have equal anchors at equal distances, also over pieces of a long text."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcd", k=900))
    text = "".join(rng.choices("abcd", k=3000)) + passage + "x" * 700 + passage + "abab" * 300
    seen, anchors = [], {}
    for data, offsets, shift in suffix_dedup._pieces(pa.array([text, "short" * 100]), 400):
        lo, hi, a, g, *_ = suffix_dedup.runs(data, offsets, 400, 100)
        for first, last, at, anchor in zip(lo, hi, a, g):
            for s in range(first, last + 1):
                seen.append(s + shift)
                told = anchors.setdefault(data[s : s + 400].tobytes(), (at - s, anchor))
                assert told == (at - s, anchor)
    assert len(seen) == len(text) - 399 + 101


def test_a_text_of_many_pieces(spark, monkeypatch):
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=1200))
    text = "".join(rng.choices("abcdefgh ", k=9000)) + passage + "".join(rng.choices("abcdefgh ", k=9000)) + passage
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 10)
    rows = [(1, text), (2, passage[100:700]), (3, passage[:399])]
    docs = literal_table(spark, rows, struct("doc_id bigint, text string"))
    held = [r[:-1] for r in plain_suffix([t for _, t in rows], 400)]
    got = rows_of(suffix_dedup.remove_repeats(docs, 400), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == [(i + 1, *h) for i, h in enumerate(held)]


def test_suffixes_of_nothing(spark):
    docs = literal_table(spark, [], struct("doc_id bigint, text string"))
    assert suffix_dedup.remove_repeats(docs).collect() == []
    short = literal_table(spark, [(1, "x" * 399), (2, None)], struct("doc_id bigint, text string"))
    assert rows_of(suffix_dedup.remove_repeats(short), "doc_id", "n_removed") == [(1, 0), (2, 0)]


# --- conversation repair -------------------------------------------------------------


def plain_damage(rows):
    """conv_id -> rows (turn, role, text) in order."""
    out = {}
    for conv_id, turn, role, text in rows:
        mine = out.setdefault(conv_id, [])
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine.extend([(turn, role, text)] * (2 if kind == 3 else 1))
    for mine in out.values():
        mine.sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1].encode(), r[2].encode()))
    return out


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        dark = re.findall(r"[^\x20\x09-\x0D]", text)
        if not dark:
            faults.append(1)
        elif (role, text) in seen:
            faults.append(2)
        else:
            faults.append(0 if dark[-1] in ".!?" else 3)
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """Shortest path with the audit string itself as the tie break."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    into = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, text = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest(), text
        if (at, state) in done:
            continue
        done.add((at, state))
        after, name = into[state]
        heapq.heappush(heap, (cost + 5, audit + "I", at, after, (*text, f"{name}:")))
        if at == len(rows):
            continue
        _, role, body = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, text))
        if faults[at] in (1, 2):
            continue
        extra = 5 if faults[at] == 3 else 0
        heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, after, (*text, f"{name}:{body}")))
        if (state, role[:1]) in step:
            kept = step[state, role[:1]]
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, kept, (*text, f"{role}:{body}")))


def plain_conversations(rows):
    out = []
    for conv_id, mine in plain_damage(rows).items():
        faults = plain_faults(mine)
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, digest, _ = plain_repair(mine, faults)
        out.append((conv_id, gaps, *[faults.count(f) for f in (1, 2, 3)], illegal, cost, audit, digest))
    return sorted(out, key=repr)


REPAIR_COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed, n=80):
    rng = random.Random(seed)
    texts = ["yes.", "no!", "well", "", " \n", None, "Ende?\t", "same.", "same."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u2"]
    rows = [(-1, t, "user", "x.") for t in range(30) if zlib.crc32(f"-1:{t}".encode()) % 20 == 0]
    for conv in [None, *range(n)]:
        turn = rng.randrange(3)
        for _ in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 2])
    return rows


CONVERSATION = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize(("seed", "prime", "settle"), [(1, conversation_repair.PRIME, 4096), (2, 3, 4096), (3, 7, 1)])
def test_repairs_are_the_least_of_all(spark, seed, prime, settle):
    """Also with so few hash values that nearly all nodes collide, and with a new root after every row."""
    rows = conversations(seed)
    table = literal_table(spark, rows, struct(CONVERSATION)).repartition(3)
    table = table.select("*", *[F.lit(1).alias(c) for c in ("kind", "copy", "fault", "dropped", "audit")])
    got = conversation_repair.repair(conversation_repair.damage(table), prime, settle)
    assert rows_of(got, *REPAIR_COLUMNS) == plain_conversations(rows)


def test_repaired_turns_are_those_hashed(spark):
    rows = conversations(4)
    damaged = conversation_repair.damage(literal_table(spark, rows, struct(CONVERSATION)))
    summary = conversation_repair.repair(damaged)
    turns = conversation_repair.repaired(damaged, summary.select("conv_id", "audit"))
    texts = {}
    for conv_id, place, role, text in turns.select("conv_id", "place", "role", "text").collect():
        texts.setdefault(conv_id, {})[place] = f"{role}:{text}"
    for conv_id, digest in summary.select("conv_id", "repaired_sha256").collect():
        mine = texts.get(conv_id, {})
        joined = "\n".join(mine[i] for i in range(len(mine)))
        assert hashlib.sha256(joined.encode()).hexdigest() == digest


def test_a_long_conversation_is_settled_on_the_way():
    rng = random.Random(7)
    rows = [(i, rng.choice(["user", "assistant", "user", "assistant", "system"]), f"t{i}" + rng.choice([".", ""])) for i in range(700)]
    faults = plain_faults(rows)
    found = []
    for settle in (16, 1 << 30):
        dp = conversation_repair.Repair(settle=settle)
        dp.settle_after = settle
        for (_, role, text), fault in zip(rows, faults):
            dp.row(role, text, fault)
            if settle == 16 and max(w[1].depth for w in dp.ways if w) >= 16:
                dp._settle()
        found.append(dp.result())
    assert found[0] == found[1] == plain_repair(rows, faults)[:3]


def test_repair_of_nothing(spark):
    table = literal_table(spark, [], struct(CONVERSATION))
    assert conversation_repair.repair(conversation_repair.damage(table)).collect() == []
