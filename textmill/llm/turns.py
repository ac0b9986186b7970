"""Repair of conversation structure at least cost, with an audit of the edits.

A conversation is to read: nothing, or an optional system turn and then pairs of user and assistant. Turns are
kept (K), given another role (R) or deleted (D), and empty turns are inserted (I). A dynamic program goes along the
turns with four states, by what has been written last: nothing, system, user, assistant. Each state holds the least
cost and the edits that lead there; of equal costs, the edits whose letters are least.

Edits are kept as linked nodes, so all states share their common beginnings. A node knows its ancestors 1, 2, 4 ...
edits before and a rolling hash of all letters up to it. Two sequences are compared by a search for their longest
common prefix: both climb in powers of two while their hashes differ. Equal hashes are then verified on the nodes.
Edits that all states share are final: they leave, with their turns, so a conversation is never held whole.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import columns

# What edits cost, and what an undeleted turn costs that is cut short.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
LOG = (
    "conv_id long, place long, edit string, cost long, turn long, role string, text string, fault string, illegal boolean"
)
_BASE, _PRIME = 1_000_003, (1 << 61) - 1
# Turns between two looks for edits that are final, and log rows (or characters) that leave together.
LOOK, ROWS_OUT, CHARS_OUT = 32, 4096, 4 << 20


class Edits:
    """Sequences of letters as nodes of a tree. Node 0 is the empty sequence."""

    def __init__(self):
        self.letter, self.depth, self.value, self.up = [""], [0], [0], [()]

    def after(self, node: int, letter: str) -> int:
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.value.append((self.value[node] * _BASE + ord(letter)) % _PRIME)
        up = [node]
        while len(self.up[up[-1]]) >= len(up):
            up.append(self.up[up[-1]][len(up) - 1])
        self.up.append(tuple(up))
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def letters(self, node: int, above: int = 0) -> str:
        """The letters after ``above``, an ancestor, up to ``node``."""
        out = []
        while node != above:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def shared(self, a: int, b: int) -> int:
        """The last node that both sequences go through."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, depth), self.ancestor(b, depth)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                a, b = self.up[a][k], self.up[b][k]
        return a if a == b else self.up[a][0]

    def _alike(self, a: int, b: int) -> bool:
        """Whether two sequences of one length are equal, letter by letter back to a node that they share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the letters of ``a`` come before those of ``b``; a beginning comes before what goes on from it."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.value[x] == self.value[y]:
            if self._alike(x, y):
                return self.depth[a] < self.depth[b]
        else:
            for k in reversed(range(len(self.up[x]))):
                if k < len(self.up[x]) and self.value[self.up[x][k]] != self.value[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            if self.letter[x] != self.letter[y] and self._alike(self.up[x][0], self.up[y][0]):
                return self.letter[x] < self.letter[y]
        return self.letters(a) < self.letters(b)  # two hashes collided

    def cut(self, root: int, nodes: list[int]) -> tuple[Edits, list[int]]:
        """A new tree from ``root`` on, with just the ways to ``nodes``."""
        made, place = Edits(), {root: 0}
        out = []
        for node in nodes:
            way = []
            while node not in place:
                way.append(node)
                node = self.up[node][0]
            for step in reversed(way):
                place[step] = made.after(place[node], self.letter[step])
                node = step
            out.append(place[node])
        return made, out


def initial(role: str) -> str:
    return role[:1]


# What each role (by its initial) may follow, and where it leads.
FOLLOWS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GIVEN = FOLLOWS["u"] | FOLLOWS["a"]
WRITTEN = {USER: "user", ASSISTANT: "assistant"}


class Conversation:
    """The states of one conversation; ``take`` gives the log rows that have become final."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.edits = Edits()
        self.states: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}
        self.held: deque[tuple] = deque()
        self.place, self.written, self.since = 0, NOTHING, 0
        self.last: tuple | None = None

    def _offer(self, states: dict, to: int, cost: int, node: int, letter: str) -> bool:
        if to in states and states[to][0] < cost:
            return False
        made = self.edits.after(node, letter)
        if to in states and states[to][0] == cost and not self.edits.less(made, states[to][1]):
            return False
        states[to] = (cost, made)
        return True

    def _insert(self) -> None:
        changed = True
        while changed:
            changed = False
            for state in sorted(self.states):
                cost, node = self.states[state]
                changed |= self._offer(self.states, GIVEN[state], cost + INSERT, node, "I")
        # From the assistant's state all can be done that can be done from these, but for one kept system turn, which
        # it can delete. Dearer ones lead to no best repair.
        most = self.states[ASSISTANT][0]
        for state, spare in ((NOTHING, DELETE), (SYSTEM, 0)):
            if state in self.states and self.states[state][0] > most + spare:
                del self.states[state]

    def take(self, turn, role: str, text: str, repeated: bool) -> list[tuple]:
        same = self.last is not None and self.last == (turn, role, text)
        bare = text.strip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if repeated or same else "truncated" if bare[-1] not in ".!?" else None
        illegal = self.last is not None and initial(self.last[1]) + initial(role) not in ("su", "ua", "au")
        self.last = (turn, role, text)
        self.held.append((turn, role, text, fault, illegal))
        self._insert()
        new: dict[int, tuple[int, int]] = {}
        more = CUT if fault == "truncated" else 0
        for state, (cost, node) in self.states.items():
            self._offer(new, state, cost + DELETE, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            kept = FOLLOWS.get(initial(role), {}).get(state)
            if kept is not None:
                self._offer(new, kept, cost + KEEP + more, node, "K")
            if GIVEN[state] != kept:
                self._offer(new, GIVEN[state], cost + REROLE + more, node, "R")
        self.states = new
        self.since += 1
        if self.since < LOOK:
            return []
        self.since = 0
        return self._settle()

    def _settle(self) -> list[tuple]:
        nodes = [node for _, node in self.states.values()]
        root = nodes[0]
        for node in nodes[1:]:
            root = self.edits.shared(root, node)
        out = self._write(self.edits.letters(root))
        self.edits, nodes = self.edits.cut(root, nodes)
        self.states = {s: (cost, node) for (s, (cost, _)), node in zip(self.states.items(), nodes, strict=True)}
        return out

    def _write(self, letters: str) -> list[tuple]:
        out = []
        for edit in letters:
            turn, role, text, fault, illegal = (None, "", "", None, False) if edit == "I" else self.held.popleft()
            more = CUT if fault == "truncated" else 0
            if edit == "D":
                cost = DELETE
            elif edit == "K":
                self.written = FOLLOWS[initial(role)][self.written]
                cost = KEEP + more
            else:
                self.written = GIVEN[self.written]
                role, cost = WRITTEN[self.written], (INSERT if edit == "I" else REROLE + more)
            out.append((self.conv_id, self.place, edit, cost, turn, role, text, fault, illegal))
            self.place += 1
        return out

    def finish(self) -> list[tuple]:
        self._insert()
        ends = [self.states[s] for s in (NOTHING, ASSISTANT) if s in self.states]
        best = ends[0]
        for cost, node in ends[1:]:
            if cost < best[0] or (cost == best[0] and self.edits.less(node, best[1])):
                best = (cost, node)
        return self._write(self.edits.letters(best[1]))


KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, KINDS[kind]) for v, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields]
    )


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    talk: Conversation | None = None
    out: list[tuple] = []
    chars = 0
    for batch in batches:
        cells = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "repeated")]
        for conv_id, *said in zip(*cells, strict=True):
            if talk is None or talk.conv_id != conv_id:
                if talk is not None:
                    out += talk.finish()
                talk = Conversation(conv_id)
            out += talk.take(*said)
            chars += len(said[2])
            if len(out) >= ROWS_OUT or (chars >= CHARS_OUT and out):
                yield _batch(out, LOG)
                out, chars = [], 0
    if talk is not None:
        out += talk.finish()
    if out:
        yield _batch(out, LOG)


def repair(conversations: DataFrame) -> DataFrame:
    """The edit log of (conv_id, turn, role, text): conv_id, place, edit, cost, turn, role, text, fault, illegal.

    Rows with another edit than ``D`` are the repaired conversation, by ``place``, in their new roles. ``fault`` is
    the first that holds of a turn: ``blank`` (only ASCII white space), ``duplicate`` (role and text were there
    before), ``truncated`` (the last other character is none of ``.!?``). Blank and duplicate turns are deleted.
    ``illegal``: the turn's role may not follow the one before it in the conversation as it came.

    Turns go by turn (nulls first), then role, then text. Null roles and texts are one space. Roles count by their
    initial; a role that is none of the three is given another or deleted. A null conv_id is a conversation. Of
    repeated rows all but the first are duplicates. Other columns are left out; no rows give no rows.

    The turns of a conversation stream by in order through one task; it holds those whose edits are still open. Every
    turn kept in its role settles those before it, so memory grows with the longest stretch of turns that are blank,
    duplicate or of no known place, not with the conversation. Turns of one role
    and text are counted before they are joined, so a hot text does not gather them.
    """
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string").fillna(" ", ["role", "text"])
    owner = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    said = F.concat_ws(":", owner, F.length("role").cast("string"), F.concat("role", "text"))
    rows = rows.withColumn("_said", F.unhex(F.sha2(said, 256)))
    # Only turns of a role and text that stands at several turns need to know the first.
    first = rows.groupBy("_said").agg(F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.max(F.col("turn").isNull()).alias("_bare"))
    first = first.where("_first < _last or (_bare and _first is not null)").drop("_last")
    later = F.col("turn").isNotNull() & (F.col("_bare") | (F.col("turn") > F.col("_first")))
    marked = rows.join(first, "_said", "left").select(
        "conv_id", "turn", "role", "text", F.coalesce(later, F.lit(False)).alias("repeated")
    )
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_repair, LOG)


SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class _Summary:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.low = self.high = None
        self.turns = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False

    def take(self, edit, cost, turn, role, text, fault, illegal) -> None:
        if turn is not None and turn != self.high:  # turns ascend
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if fault:
            self.count[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.audit.append(edit)
        if edit != "D":
            self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def summarise(log: DataFrame) -> DataFrame:
    """Counts, audit and digest of each conversation of an edit log as :func:`repair` gives it, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Summary | None = None
        for batch in batches:
            done = []
            cells = [batch.column(c).to_pylist() for c in ("conv_id", "edit", "cost", "turn", "role", "text", "fault", "illegal")]
            for conv_id, *entry in zip(*cells, strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Summary(conv_id)
                now.take(*entry)
            if done:
                yield _batch(done, SUMMARY)
        if now is not None:
            yield _batch([now.result()], SUMMARY)

    return log.mapInArrow(run, SUMMARY)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults by a hash of conv_id and turn; a null counts as one space."""
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string").fillna(" ", ["role", "text"])
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.pmod(F.crc32(F.concat_ws(":", *named).cast("binary")), F.lit(20))
    rows = rows.withColumn("_kind", kind).where("_kind != 0")
    rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
    )


def audits(conversations: DataFrame, broken: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``: the summary of the repair of ``broken``, its damaged rows.

    A conversation without rows in ``broken`` has zeros, an empty audit and the digest of nothing.
    """
    made = summarise(repair(broken)).withColumnRenamed("conv_id", "_conv")
    every = columns(conversations, conv_id="long").distinct()
    joined = every.join(made, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    none = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.fillna(none | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
