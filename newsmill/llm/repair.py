"""Repair of the structure of conversations by the cheapest audit, a string of edits.

An audit keeps (K), gives another role to (R) or deletes (D) each row in turn and inserts (I) rows without text, so that the role
initials read ``(s?(ua)+)?``.  Blank rows and repeats must go.  Of all cheapest audits the least in ASCII order is taken.

The audit is found row by row: for each of the four states of the grammar the cheapest edits so far are a node that links to the node before
it, so that states share what they have in common.  A node knows its ancestors at distances 1, 2, 4, ... and a rolling hash of
all its edits; where costs tie, the longest common prefix of two nodes is searched over those ancestors by their hashes and the
next edits decide, after the common prefix has been verified.  Two equally cheap audits of the same rows that end in one state are never prefixes of
each other (the longer one would hold inserts more), so the order of two of them never changes with what follows."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DELETE, KEEP, REROLE, INSERT, TRUNCATED = 2, 0, 1, 5, 5  # costs; the last one of an undeleted truncated row
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows so far end with
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state after a user or assistant row
ROLE = {USER: "user", ASSISTANT: "assistant"}
_MOD, _BASE = 2**61 - 1, 0x1F35A9C3D
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\x0b\x0c\r"


class Node:
    """The last edit of an audit, linked to the edits before it."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, edit: str = "", before: Node | None = None):
        self.edit = edit
        self.depth = before.depth + 1 if before else 0
        self.hash = (before.hash * _BASE + ord(edit)) % _MOD if before else 0
        self.up: list[Node] = [before] if before else []
        while before and len(self.up) <= len(self.up[-1].up):  # the ancestor 2^k up is 2^(k-1) above the one 2^(k-1) up
            self.up.append(self.up[-1].up[len(self.up) - 1])


def _lift(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.up[min((node.depth - depth).bit_length(), len(node.up)) - 1]
    return node


def _same(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth hold the same edits, without trusting hashes."""
    while a is not b:
        if a.edit != b.edit or not a.up or not b.up:
            return a.edit == b.edit and not a.up and not b.up
        a, b = a.up[0], b.up[0]
    return True


def _edits(node: Node, root: Node | None = None) -> str:
    out = []
    while node is not root and node.up:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def precedes(a: Node, b: Node) -> bool:
    """Whether the edits of ``a`` come before those of ``b`` in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = _lift(a, depth), _lift(b, depth)
    if x.hash == y.hash:
        return a.depth < b.depth if _same(x, y) else _edits(a) < _edits(b)
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and k < len(y.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    # before x and y all hashes agree
    if x.up and y.up and not _same(x.up[0], y.up[0]):
        return _edits(a) < _edits(b)
    return x.edit < y.edit


class Audit:
    """The cheapest edits of the rows so far for every state."""

    def __init__(self):
        self.root = Node()
        self.cost: list[int | None] = [0, None, None, None]
        self.node: list[Node | None] = [self.root, None, None, None]
        self._insert()

    def _offer(self, cost: list, made: list, state: int, price: int, before: Node, edit: str) -> None:
        if cost[state] is not None and price > cost[state]:
            return
        node = Node(edit, before)
        if cost[state] is None or price < cost[state] or precedes(node, made[state]):
            cost[state], made[state] = price, node

    def _insert(self) -> None:
        cost, node = self.cost, self.node
        for state in (START, SYSTEM, ASSISTANT, USER):
            if cost[state] is not None:
                self._offer(cost, node, NEXT[state], cost[state] + INSERT, node[state], "I")
        # states that no audit through them can be cheapest any more: what another state costs, and at most needs more to catch up
        for state, others in ((START, ((ASSISTANT, DELETE), (USER, DELETE + INSERT))), (SYSTEM, ((ASSISTANT, 0), (USER, INSERT))),
                              (USER, ((ASSISTANT, INSERT),)), (ASSISTANT, ((USER, INSERT),))):
            if cost[state] is not None and any(cost[o] is not None and cost[state] > cost[o] + more for o, more in others):
                cost[state] = node[state] = None

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        """Take one more row into account."""
        old, nodes = self.cost, self.node
        cost, made = [None] * 4, [None] * 4
        extra = TRUNCATED if truncated else 0
        for state in range(4):
            if old[state] is None:
                continue
            self._offer(cost, made, state, old[state] + DELETE, nodes[state], "D")
            if must_go:
                continue
            after = NEXT[state]
            if initial == ROLE[after][0]:
                self._offer(cost, made, after, old[state] + KEEP + extra, nodes[state], "K")
            else:
                self._offer(cost, made, after, old[state] + REROLE + extra, nodes[state], "R")
            if initial == "s" and state == START:
                self._offer(cost, made, SYSTEM, old[state] + KEEP + extra, nodes[state], "K")
        self.cost, self.node = cost, made
        self._insert()

    def _settle(self, node: Node) -> str:
        out = _edits(node, self.root)
        node.up = []  # nothing before it is compared any more
        self.root = node
        return out

    def settled(self) -> str:
        """Edits since the last call that all states share, which later rows cannot change."""
        live = [n for n in self.node if n is not None]
        depth = min(n.depth for n in live)
        live = [_lift(n, depth) for n in live]
        while any(n is not live[0] for n in live):
            live = [n.up[0] for n in live]
        return self._settle(live[0]) if live[0] is not self.root else ""

    def finish(self) -> str:
        """The other edits of the cheapest audit."""
        ends = [s for s in (START, ASSISTANT) if self.cost[s] is not None]
        best = min(self.cost[s] for s in ends)
        ends = [self.node[s] for s in ends if self.cost[s] == best]
        return self._settle(ends[1] if len(ends) > 1 and precedes(ends[1], ends[0]) else ends[0])


EDITS = "conv_id {key}, step long, edit string, role string, text string, turn long, was_role string, fault string, cost long"
_NAMES = ["conv_id", "step", "edit", "role", "text", "turn", "was_role", "fault", "cost"]
HELD_ROWS, HELD_CHARS = 256, 1_000_000


class _Conversation:
    """Rows of one conversation in order; edits leave as soon as they are settled."""

    def __init__(self, key, out: list[list]):
        self.key, self.out = key, out
        self.audit, self.state, self.steps = Audit(), START, 0
        self.held: deque[tuple] = deque()
        self.chars, self.room = 0, HELD_CHARS
        self.rows = HELD_ROWS
        self.seen: set[bytes] = set()

    def add(self, turn, role: str, text: str) -> None:
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if not _SOLID.search(text):
            fault = "blank"
        elif digest in self.seen:
            fault = "duplicate"
        else:
            fault = None if text.rstrip(_SPACE)[-1] in ".!?" else "truncated"
        self.seen.add(digest)
        self.held.append((turn, role, text, fault))
        self.chars += len(text)
        self.audit.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        if len(self.held) > self.rows or self.chars > self.room:
            self._emit(self.audit.settled())
            self.rows, self.room = max(HELD_ROWS, 2 * len(self.held)), max(HELD_CHARS, 2 * self.chars)

    def _emit(self, edits: str) -> None:
        for edit in edits:
            turn = role = text = was = fault = None
            if edit == "I":
                self.state = NEXT[self.state]
                role, text, cost = ROLE[self.state], "", INSERT
            else:
                turn, was, text, fault = self.held.popleft()
                self.chars -= len(text)
                extra = TRUNCATED if fault == "truncated" else 0
                if edit == "D":
                    text, cost = None, DELETE
                elif edit == "R":
                    self.state = NEXT[self.state]
                    role, cost = ROLE[self.state], REROLE + extra
                else:
                    self.state = SYSTEM if was[:1] == "s" else NEXT[self.state]
                    role, cost = was, KEEP + extra
            for column, v in zip(self.out, (self.key, self.steps, edit, role, text, turn, was, fault, cost)):
                column.append(v)
            self.steps += 1

    def close(self) -> None:
        self._emit(self.audit.finish())
        if not self.steps:
            for column, v in zip(self.out, (self.key, 0, *[None] * 7)):
                column.append(v)


def repair_conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         present: str | None = None) -> DataFrame:
    """(conv_id, step, edit, role, text, turn, was_role, fault, cost): the cheapest audit of every conversation, one row an edit.

    ``role`` and ``text`` are those of the repaired row (null for a deleted one), ``turn``, ``was_role`` and ``fault`` (blank,
    duplicate, truncated or null) those of the row it came from (null for an inserted one).  A conversation without rows, or none of whose rows has a true
    ``present``, has one row with a null edit.

    Rows are taken by turn (nulls first), then role and text.  Null roles and texts count as one space.  Rows with a null id form one conversation.
    Other columns are ignored, whatever their names; an empty table gives an empty result.  Rows of a conversation are brought together sorted by the shuffle, and are streamed:
    a task holds the rows whose edit is not settled, and 16 bytes for every different row of the conversation.  Edits of a conversation leave in
    order, in one partition."""
    kind = rows.schema[key].dataType.simpleString()
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    ordered = (rows.select(F.col(key).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                           F.coalesce(F.col(text), F.lit(" ")).alias("text"), there.alias("there"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in _NAMES]
        now, ids = None, None

        def flush() -> pa.RecordBatch:
            kinds = [ids, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], _NAMES)
            for c in out:
                c.clear()
            return batch

        for b in batches:
            ids = b.schema.field(0).type
            for k, t, r, x, is_there in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or k != now.key:
                    if now is not None:
                        now.close()
                    now = _Conversation(k, out)
                if is_there:
                    now.add(t, r, x)
            if len(out[0]) >= 1000 or sum(len(x or "") for x in out[4]) > HELD_CHARS:
                yield flush()
        if now is not None:
            now.close()
            yield flush()

    return ordered.mapInArrow(run, EDITS.format(key=kind))


DIGESTS = ("conv_id {key}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_LEGAL = {"su", "ua", "au"}


def audit_digests(edits: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) from the output of
    :func:`repair_conversations`, whose edits of a conversation follow each other in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        done: list[tuple] = []
        ids, key = None, None
        state: dict | None = None

        def close() -> None:
            gaps = state["last"] - state["first"] + 1 - state["turns"] if state["turns"] else 0
            done.append((key, gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"], state["cost"],
                         "".join(state["audit"]), state["sha"].hexdigest()))

        def flush() -> pa.RecordBatch:
            kinds = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names)
            done.clear()
            return batch

        for b in batches:
            ids = b.schema.field(0).type
            for k, step, edit, role, text, turn, was, fault, cost in zip(*(c.to_pylist() for c in b.columns)):
                if step == 0:
                    if state is not None:
                        close()
                    key, state = k, {"first": None, "last": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                                     "cost": 0, "audit": [], "sha": hashlib.sha256(), "was": None, "rows": 0}
                if edit is None:
                    continue
                state["audit"].append(edit)
                state["cost"] += cost
                if edit != "I":
                    if fault:
                        state[fault] += 1
                    if state["was"] is not None and state["was"][:1] + was[:1] not in _LEGAL:
                        state["illegal"] += 1
                    state["was"] = was
                    if turn is not None and turn != state["last"]:
                        state["first"] = turn if state["first"] is None else state["first"]
                        state["last"] = turn
                        state["turns"] += 1
                if edit != "D":
                    state["sha"].update(f"{chr(10) if state['rows'] else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    state["rows"] += 1
            if len(done) >= 1000:
                yield flush()
        if state is not None:
            close()
            yield flush()

    return edits.mapInArrow(run, DIGESTS.format(key=edits.schema["conv_id"].dataType.simpleString()))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): conversations with known faults, by the checksum of ``conv_id:turn`` modulo 20.

    0 drops the row (``present`` is false), 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's.
    A null counts as one space, in the checksum too; a null turn stays null."""
    space = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                       (F.crc32(name.cast("binary")) % 20).alias("kind"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 0, space).when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"),
                       (F.col("kind") != 0).alias("present"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


# four states a conversation: cost in eight digits, then the audit, so that the least string is the cheapest and first audit
REPAIR_SQL = r"""
WITH RECURSIVE bits AS (SELECT list(v ORDER BY i) AS tbl FROM (SELECT i, list_reduce([i] || [0 FOR z IN range(8)],
        lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM (SELECT unnest(range(256)) AS i))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
summed AS (SELECT conv_id, turn, role, text, xor(list_reduce([4294967295] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(name, '')],
        lambda a, b: xor(a // 256, tbl[(xor(a, b) % 256) + 1])), 4294967295) % 20 AS kind FROM named, bits),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM summed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
judged AS MATERIALIZED (SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
steps(conv_id, i, e, s, u, a) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '00000000', CAST(NULL AS VARCHAR), '00000005I', '00000010II' FROM judged
    UNION ALL
    SELECT conv_id, i, e, s, u, least(a, printf('%08d', CAST(u[:8] AS INT) + 5) || u[9:] || 'I') FROM (
        SELECT conv_id, i, e, s, a, least(u, printf('%08d', CAST(e[:8] AS INT) + 5) || e[9:] || 'I', printf('%08d', CAST(s[:8] AS INT) + 5) || s[9:] || 'I',
            printf('%08d', CAST(a[:8] AS INT) + 5) || a[9:] || 'I') AS u FROM (
            SELECT p.conv_id, j.i, printf('%08d', CAST(p.e[:8] AS INT) + 2) || p.e[9:] || 'D' AS e,
                least(printf('%08d', CAST(p.s[:8] AS INT) + 2) || p.s[9:] || 'D',
                    CASE WHEN ok AND r = 's' THEN printf('%08d', CAST(p.e[:8] AS INT) + extra) || p.e[9:] || 'K' END) AS s,
                least(printf('%08d', CAST(p.u[:8] AS INT) + 2) || p.u[9:] || 'D',
                    CASE WHEN ok THEN printf('%08d', CAST(p.e[:8] AS INT) + extra + (r <> 'u')::INT) || p.e[9:] || CASE r WHEN 'u' THEN 'K' ELSE 'R' END END,
                    CASE WHEN ok THEN printf('%08d', CAST(p.s[:8] AS INT) + extra + (r <> 'u')::INT) || p.s[9:] || CASE r WHEN 'u' THEN 'K' ELSE 'R' END END,
                    CASE WHEN ok THEN printf('%08d', CAST(p.a[:8] AS INT) + extra + (r <> 'u')::INT) || p.a[9:] || CASE r WHEN 'u' THEN 'K' ELSE 'R' END END) AS u,
                least(printf('%08d', CAST(p.a[:8] AS INT) + 2) || p.a[9:] || 'D',
                    CASE WHEN ok THEN printf('%08d', CAST(p.u[:8] AS INT) + extra + (r <> 'a')::INT) || p.u[9:] || CASE r WHEN 'a' THEN 'K' ELSE 'R' END END) AS a
            FROM steps p JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS ok, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM judged) j
                ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = p.i + 1))),
facts AS (SELECT conv_id, max(i) AS n, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM judged GROUP BY conv_id),
best AS MATERIALIZED (SELECT f.*, least(p.e, p.a) AS found FROM facts f JOIN steps p ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i),
edits AS (SELECT conv_id, k, edit, CAST(sum((edit <> 'I')::INT) OVER w AS BIGINT) AS i, CAST(sum((edit <> 'D')::INT) OVER w AS BIGINT) AS place
    FROM (SELECT conv_id, unnest(range(1, length(found) - 7)) AS k, unnest(string_split(found[9:], '')) AS edit FROM best WHERE length(found) > 8)
    WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
lines AS (SELECT e.conv_id, e.k, e.edit, e.place, j.role, CASE e.edit WHEN 'I' THEN '' ELSE j.text END AS text,
    max(CASE WHEN e.place = 1 AND e.edit = 'K' AND j.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
    FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.i = j.i),
repaired AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY k) AS whole FROM lines WHERE edit <> 'D' GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(b.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(b.blank, 0) AS BIGINT) AS blank, CAST(coalesce(b.duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(b.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(b.illegal, 0) AS BIGINT) AS illegal,
    CAST(coalesce(CAST(b.found[:8] AS BIGINT), 0) AS BIGINT) AS cost, coalesce(b.found[9:], '') AS audit, sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""
