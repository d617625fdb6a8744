"""Cheapest repairs of conversations, found by a persistent audit DP.

The rows of a conversation are read once, in order. After each row there is one
best way into each of four states of the role pattern ``(s?(ua)+)?``; a way is
its cost and its audit, the initials of its edits. Audits are linked nodes:
ways share the nodes of their common beginning, and every node knows its
ancestors at distances of powers of two and a rolling hash of the whole string
up to it. Two audits of one cost are compared by a search for their longest
common prefix over these ancestors, in logarithmic time; where two different
nodes have one hash, the strings themselves are compared.

The hash of the repaired text runs along with each way, so no text is held.
What the four ways have in common is settled and cut off from time to time, so
that a conversation of any length needs bounded memory beside its audit string.
Faults of rows are found by Spark before (duplicates by a window that spills).
One conversation is one stream, because one hash over its whole text in order is
asked for; all that is done per row comes before it, spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRIME = (1 << 61) - 1
BASE = 0x1F3D5B79A8C6E421 % PRIME
SETTLE = 4096  # rows after which the common beginning of all ways is cut off
SPACE = " \t\n\x0b\x0c\r"

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
DROPPED = -1

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = (2, 2, 3, 2)
ROLE_INTO = {2: "user", 3: "assistant"}
ACCEPTED = (0, 3)
LEGAL = {"su", "ua", "au"}


class Node:
    """The last edit of an audit; ``up[k]`` is the node 2^k edits before."""

    __slots__ = ("char", "depth", "hash", "up")

    def __init__(self, char: str = "", parent: Node | None = None, prime: int = PRIME):
        self.char = char
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, []
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(char)) % prime
        up = [parent]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        self.up = up

    def ancestor(self, depth: int) -> Node:
        node, gap = self, self.depth - depth
        while gap:
            step = gap.bit_length() - 1
            node, gap = node.up[step], gap - (1 << step)
        return node


def same(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth spell one string: by hash, and then letter by letter."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.char != b.char:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Whether the audit of ``a`` is ASCII-less than that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if same(x, y):
        return a.depth < b.depth
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and not same(x.up[k], y.up[k]):
            x, y = x.up[k], y.up[k]
    return x.char < y.char


def meeting(a: Node, b: Node) -> Node:
    """The last node that two audits share."""
    depth = min(a.depth, b.depth)
    a, b = a.ancestor(depth), b.ancestor(depth)
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and a.up[k] is not b.up[k]:
            a, b = a.up[k], b.up[k]
    return a if a is b else a.up[0]


def spelled(node: Node, root: Node) -> str:
    """The edits from ``root`` (without it) to ``node``."""
    out = []
    while node is not root:
        out.append(node.char)
        node = node.up[0]
    return "".join(reversed(out))


class Repair:
    """The best ways through the rows of one conversation so far.

    A way is (cost, last node, hash object of the repaired text); hash objects are
    shared and copied before they grow.
    """

    def __init__(self, prime: int = PRIME, settle: int = SETTLE):
        self.prime, self.settle_after = prime, settle
        self.root = Node()
        self.settled = ""
        self.ways = [(0, self.root, hashlib.sha256()), None, None, None]

    def _offer(self, ways: list, state: int, cost: int, parent: Node, edit: str, sha, added: bytes | None) -> None:
        held = ways[state]
        if held is not None and held[0] < cost:
            return
        node = Node(edit, parent, self.prime)
        if held is None or cost < held[0] or before(node, held[1]):
            ways[state] = (cost, node, sha, added)

    @staticmethod
    def _closed(ways: list) -> list:
        """The ways with their pending text hashed."""
        out = []
        for way in ways:
            if way is not None and len(way) == 4:
                cost, node, sha, added = way
                if added is not None:
                    sha = sha.copy()
                    sha.update(added)
                way = (cost, node, sha)
            out.append(way)
        return out

    def _insert(self, ways: list) -> list:
        """The ways after any turns inserted here; more than two in a row never pay."""
        out = list(ways)
        for target, sources in ((2, (0, 1, 3)), (3, (2,))):
            here = self._closed(out)
            for state in sources:
                if here[state] is not None:
                    cost, node, sha = here[state]
                    lead = b"" if state == 0 else b"\n"
                    self._offer(out, target, cost + 5, node, "I", sha, lead + ROLE_INTO[target].encode() + b":")
        return self._closed(out)

    def row(self, role: str, text: str, fault: int) -> None:
        """Take one row; ``fault`` is one of the constants above."""
        initial, body = role[:1], b":" + text.encode()
        extra = 5 if fault == TRUNCATED else 0
        ways: list = [None] * 4
        for state, way in enumerate(self._insert(self.ways)):
            if way is None:
                continue
            cost, node, sha = way
            self._offer(ways, state, cost + 2, node, "D", sha, None)
            if fault in (BLANK, DUPLICATE):
                continue
            lead = b"" if state == 0 else b"\n"
            kept = KEEP.get((state, initial))
            if kept is not None:
                self._offer(ways, kept, cost + extra, node, "K", sha, lead + role.encode() + body)
            into = NEXT[state]
            self._offer(ways, into, cost + 1 + extra, node, "R", sha, lead + ROLE_INTO[into].encode() + body)
        self.ways = self._closed(ways)
        if max(way[1].depth for way in self.ways if way) >= self.settle_after:
            self._settle()

    def _settle(self) -> None:
        """Cut off what all ways share, and hang the rest on a new root."""
        alive = [way[1] for way in self.ways if way]
        common = alive[0]
        for node in alive[1:]:
            common = meeting(common, node)
        self.settled += spelled(common, self.root)
        root = Node()
        made = {id(common): root}
        for node in alive:
            chain = []
            while id(node) not in made:
                chain.append(node)
                node = node.up[0]
            for old in reversed(chain):
                made[id(old)] = Node(old.char, made[id(old.up[0])], self.prime)
        self.ways = [way and (way[0], made[id(way[1])], way[2]) for way in self.ways]
        self.root = root
        longest = max(way[1].depth for way in self.ways if way)
        self.settle_after = max(SETTLE, 2 * longest)

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, sha256 of the repaired text) of the cheapest accepted way."""
        best = None
        ends = self._insert(self.ways)
        for state in ACCEPTED:
            way = ends[state]
            if way is None:
                continue
            if best is None or way[0] < best[0] or (way[0] == best[0] and before(way[1], best[1])):
                best = way
        return best[0], self.settled + spelled(best[1], self.root), best[2].hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: rows damaged by their checksum; null role and text are one space.

    Dropped rows stay as markers without role and text, so that their conversation is known.
    """
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(name) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    there = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    changed = there.select(
        "conv_id",
        "turn",
        F.expr("case when kind = 0 then null when kind = 4 then 'user' else role end").alias("role"),
        F.expr("case when kind = 0 then null when kind = 1 then '' "
               "when kind = 2 then translate(text, '.!?', '') else text end").alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.expr("explode(array_repeat(0, if(kind = 3, 2, 1)))").alias("copy"),
    )
    return changed.drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """The rows with ``fault``, each conversation in one partition and in order.

    Order: turn (null first), role, text. Rows alike in all three are told apart
    by their fault: the first is judged by itself, the others are duplicates.
    """
    solid = F.rtrim("text", F.lit(SPACE))
    same_text = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    fault = (
        F.when(F.col("dropped"), DROPPED)
        .when(solid == "", BLANK)
        .when(F.row_number().over(same_text) > 1, DUPLICATE)
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )
    return (
        rows.repartition("conv_id")
        .withColumn("fault", fault)
        .select("conv_id", "turn", "role", "text", "fault")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "fault")
    )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


SUMMARY = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def repair(rows: DataFrame, prime: int = PRIME, settle: int = SETTLE) -> DataFrame:
    """One row for each conv_id of ``rows(conv_id, turn, role, text, dropped)``.

    gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 as
    the cheapest edits give them. A null conv_id is a conversation of its own. One
    whose rows are all dropped has zeros, an empty audit and the hash of nothing.
    Roles with other initials than s, u and a can be deleted or made user or
    assistant. Other columns are ignored; an empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType
    summary = f"conv_id {kind.simpleString()}, {SUMMARY}"

    def stream(batches):
        out: list[tuple] = []
        names, current, state = None, object(), None
        schema = None

        def finish():
            conv_id, dp, counts, turns, illegal = state
            distinct, least, most, _ = turns
            gaps = most - least + 1 - distinct if distinct else 0
            cost, audit, digest = dp.result()
            out.append((conv_id, gaps, *counts[BLANK:], illegal, cost, audit, digest))

        def flushed():
            columns = list(zip(*out)) or [()] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, schema)]
            out.clear()
            return pa.record_batch(arrays, names)

        for batch in batches:
            if names is None:
                names = ["conv_id", *[part.split()[0] for part in SUMMARY.split(", ")]]
                longs, texts = [pa.int64()] * 6, [pa.string()] * 2
                schema = [batch.schema.field("conv_id").type, *longs, *texts]
            for conv_id, turn, role, text, fault in _rows([batch]):
                if state is None or conv_id != current:
                    if state is not None:
                        finish()
                    current = conv_id
                    state = [conv_id, Repair(prime, settle), [0] * 4, (0, None, None, None), 0]
                    last = None
                if fault == DROPPED:
                    continue
                state[2][fault] += 1
                distinct, least, most, seen = state[3]
                if turn is not None and turn != seen:
                    state[3] = (distinct + 1, turn if least is None else least, turn, turn)
                if last is not None and last + role[:1] not in LEGAL:
                    state[4] += 1
                last = role[:1]
                state[1].row(role, text, fault)
            if out:
                yield flushed()
        if state is not None:
            finish()
            yield flushed()

    return judged(rows).mapInArrow(stream, summary)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the turns that ``audits(conv_id, audit)`` leave, numbered from 0.

    The audit of a conversation comes ahead of its rows in one sorted stream.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    told = audits.select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(DROPPED).alias("fault"),
    )
    both = told.unionByName(judged(rows).select(
        "conv_id", F.lit(1).alias("_kind"), F.col("turn").cast("bigint").alias("turn"), "role", "text", "fault"
    ))
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "_kind", F.asc_nulls_first("turn"), "role", "text", "fault"
    )

    def stream(batches):
        audit, at, state, place, conv_id = "", 0, 0, 0, None

        def inserted(out):
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                out.append((conv_id, place, "I", ROLE_INTO[state], ""))
                at, place = at + 1, place + 1

        for batch in batches:
            out: list[tuple] = []
            for conv, kind, _, role, text, fault in _rows([batch]):
                if kind == 0:
                    audit, at, state, place, conv_id = text, 0, 0, 0, conv
                    inserted(out)
                    continue
                if fault == DROPPED:
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = KEEP[state, role[:1]] if edit == "K" else NEXT[state]
                    out.append((conv, place, edit, role if edit == "K" else ROLE_INTO[state], text))
                    place += 1
                inserted(out)
            columns = list(zip(*out)) or [()] * 5
            types = [batch.schema.field("conv_id").type, pa.int64(), *[pa.string()] * 3]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.record_batch(arrays, ["conv_id", "place", "edit", "role", "text"])

    return ordered.mapInArrow(stream, f"conv_id {kind}, place long, edit string, role string, text string")
