"""Repair of conversations against a search of all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from textmill.llm import queries, turns

FOLDER = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")
OPEN = re.compile(r"(s?(ua)*u?)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by plain sequences: every way of editing, kept apart by the roles written so far."""
    ways = {(): (0, "", ())}

    def offer(into, roles, cost, audit, said):
        if OPEN.fullmatch("".join(r[:1] for r in roles)) and ((roles not in into) or (cost, audit) < into[roles][:2]):
            into[roles] = (cost, audit, said)

    def inserted(ways, limit=3):
        for _ in range(limit):
            more = dict(ways)
            for roles, (cost, audit, said) in ways.items():
                for role in ("user", "assistant"):
                    offer(more, (*roles, role), cost + 2, audit + "I", (*said, (role, "")))
            ways = more
        return ways

    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for roles, (cost, audit, said) in inserted(ways).items():
            offer(new, roles, cost + 3, audit + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if role:
                offer(new, (*roles, role), cost + more, audit + "K", (*said, (role, text)))
            for other in ("user", "assistant"):
                offer(new, (*roles, other), cost + 2 + more, audit + "R", (*said, (other, text)))
        least = min(c for c, *_ in new.values())
        ways = {k: v for k, v in new.items() if v[0] <= least + 8}
    done = [v for k, v in inserted(ways).items() if PATTERN.fullmatch("".join(r[:1] for r in k))]
    return min(done, key=lambda v: v[:2])


def wanted(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    cost, audit, said = cheapest(rows)
    known = [t for t, *_ in rows if t is not None]
    roles = [r[:1] for _, r, _ in rows]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(found.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(),
    )


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{FOLDER}/conversations.parquet'").fetchall()
    broken = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        broken[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.queries()["op13_turns"](spark, FOLDER).collect()}
    assert got == {conv: wanted(said) for conv, said in broken.items()}
    assert any("I" in g[6] for g in got.values()) and any("R" in g[6] for g in got.values())


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    draw = random.Random(seed)
    said, every = defaultdict(list), []
    for conv in range(150):
        for _ in range(draw.randrange(1, 9)):
            role = draw.choice(["system", "user", "assistant", "assistant", "user", "tool", "", "ok"])
            text = draw.choice(["Yes.", "no", " \n", "", "Why? ", f"t{draw.randrange(9)}!", "é…"])
            said[conv].append((draw.choice([None, *range(9)]), role, text))
            every.append((conv, *said[conv][-1]))
    table = spark.createDataFrame(every, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turns.audits(table, table).collect()}
    assert got == {conv: wanted(rows) for conv, rows in said.items()}


def plain(rows):
    """Cost and letters by the same grammar on whole strings (long conversations)."""
    best = {"": (0, "")}
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(into, k, v):
        if k not in into or v < into[k]:
            into[k] = v

    def grow(best):
        for _ in range(3):
            for k, (c, w) in list(best.items()):
                put(best, nexts[k], (c + 2, w + "I"))
        return best

    for (_, role, _), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for k, (c, w) in grow(best).items():
            put(new, k, (c + 3, w + "D"))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if nexts[k] == role[:1] or (k == "" and role[:1] == "s"):
                    put(new, role[:1], (c + more, w + "K"))
                put(new, nexts[k], (c + 2 + more, w + "R"))
        best = new
    best = grow(best)
    return min(best[k] for k in ("", "a") if k in best)


@pytest.mark.parametrize("kind", ["mixed", "users", "systems", "blank"])
def test_long_conversations(spark, kind):
    draw = random.Random(kind)
    roles = {"mixed": ["system", "user", "assistant", "tool"], "users": ["user"], "systems": ["system"], "blank": ["user"]}[kind]
    rows = [(i, draw.choice(roles), "" if kind == "blank" else f"said {i}" + draw.choice([".", ""])) for i in range(3000)]
    table = spark.createDataFrame([(7, *r) for r in rows], "conv_id long, turn long, role string, text string")
    row = turns.audits(table, table).collect()[0]
    assert (row.cost, row.audit) == plain(rows)


def test_edits_stay_right_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(turns, "_PRIME", 3)
    draw = random.Random(3)
    edits = turns.Edits()
    nodes = [0]
    for _ in range(600):
        nodes.append(edits.after(draw.choice(nodes[-40:]), draw.choice("DIKR")))
    for _ in range(3000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert edits.less(a, b) == (edits.letters(a) < edits.letters(b))
        assert edits.letters(a).startswith(edits.letters(edits.shared(a, b)))


def test_open_edits_do_not_grow():
    talk = turns.Conversation(1)
    for i in range(5000):
        talk.take(i, "user" if i % 3 else "assistant", f"said {i}.", False)
        assert len(talk.held) < 200 and len(talk.edits.letter) < 2000


def test_odd_rows(spark):
    rows = [(None, None, None, None, "x"), (1, None, "user", "Hi.", "x"), (1, None, "user", "Hi.", "x"), (1, 0, "user", "Hi.", "x"),
            (1, 4, "assistant", "w" * 300_000 + "!", "x"), (2, 0, "", "a", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.cost, r.audit) for r in turns.audits(table, table).collect()}
    assert got == {None: (0, 1, 0, 0, 3, "D"), 1: (3, 0, 2, 0, 6, "KDDK"), 2: (0, 0, 0, 1, 3, "D")}
    assert turns.repair(table.limit(0)).collect() == [] and turns.audits(table.limit(0), table.limit(0)).collect() == []
    empty = turns.audits(table, table.limit(0)).collect()
    assert len(empty) == 3 and all(r.audit == "" and r.cost == 0 and r.repaired_sha256 == hashlib.sha256().hexdigest() for r in empty)
    said = turns.repair(table).where("edit != 'D' and conv_id = 1").orderBy("place").collect()
    assert [(r.role, len(r.text)) for r in said] == [("user", 3), ("assistant", 300_001)]
