"""Conversation repair against a search through all edits, and against a plain DP over strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import SMALL_SF
from pyspark.sql import functions as F

from lakestrata.llm.conversations import AuditTree, Cheapest, damaged, mended, repair
from lakestrata.llm.queries import QUERIES

GOAL = re.compile(r"(s?(ua)+)?\Z")
FULL = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest_strings(rows, faults):
    """(cost, audit, lines): the DP with whole strings and whole lines in place of nodes."""
    states = {"": (0, "", ())}  # the roles so far, shortened to what decides

    def offer(best, roles, cost, audit, lines):
        key = roles if roles in ("", "s") else roles[-1]
        if key not in best or (cost, audit) < best[key][:2]:
            best[key] = (cost, audit, lines)

    def roles_ok(key, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[key].find(initial) >= 0 and len(initial) == 1

    def inserted(states):
        for _ in range(3):
            best = dict(states)
            for key, (cost, audit, lines) in states.items():
                for initial in "ua":
                    if roles_ok(key, initial):
                        offer(best, initial, cost + 5, audit + "I", (*lines, f"{FULL[initial]}:"))
            states = best
        return states

    for (role, text), fault in zip(rows, faults, strict=True):
        best = {}
        extra = 5 if fault == "truncated" else 0
        for key, (cost, audit, lines) in inserted(states).items():
            offer(best, key, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            if roles_ok(key, role[:1]):
                offer(best, role[:1] if role[:1] != "s" else "s", cost + extra, audit + "K", (*lines, f"{role}:{text}"))
            for initial in "ua":
                if roles_ok(key, initial):
                    offer(best, initial, cost + extra + 1, audit + "R", (*lines, f"{FULL[initial]}:{text}"))
        states = best
    ends = [states for key, states in inserted(states).items() if key in ("", "a")]
    return min(ends)


def every_edit(rows, faults):
    """The same by looking at every sequence of edits with at most two rows put in."""
    found = []
    for edits in itertools.product("KDua", repeat=len(rows)):
        for places in itertools.chain.from_iterable(
            itertools.combinations_with_replacement([(n, r) for n in range(len(rows) + 1) for r in "ua"], k) for k in range(3)
        ):
            cost, audit, lines = 5 * len(places), "", []
            ok = True
            for n in range(len(rows) + 1):
                for _, r in (p for p in places if p[0] == n):
                    audit += "I"
                    lines.append((FULL[r], ""))
                if n == len(rows):
                    break
                edit, (role, text) = edits[n], rows[n]
                if edit == "D":
                    cost, audit = cost + 2, audit + "D"
                    continue
                if faults[n] in ("blank", "duplicate"):
                    ok = False
                    break
                cost += (edit != "K") + 5 * (faults[n] == "truncated")
                audit += "K" if edit == "K" else "R"
                lines.append((role if edit == "K" else FULL[edit], text))
            if ok and GOAL.match("".join(role[:1] or "-" for role, _ in lines)):
                found.append((cost, audit, tuple(f"{r}:{t}" for r, t in lines)))
    return min(found)


def plain_report(rows):
    """rows: (turn, role, text) in order, after damage."""
    pairs = [(role, text) for _, role, text in rows]
    faults = faults_of(pairs)
    cost, audit, lines = cheapest_strings(pairs, faults)
    turns = {turn for turn, _, _ in rows if turn is not None}
    initials = [role[:1] for role, _ in pairs]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {conv: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0)) for conv, kept in out.items()}


def reports(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def talk(draw, n):
    roles, texts = ["system", "user", "user", "assistant", "assistant", "tool", ""], ["Yes.", "No", "", " \t", "Why?", "Well.", "So!"]
    return [(draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_costs_equal_a_search_through_all_edits():
    draw = random.Random(1)
    for _ in range(60):
        rows = talk(draw, draw.randrange(5))
        faults = faults_of(rows)
        expected = every_edit(rows, faults)
        assert cheapest_strings(rows, faults) == expected
        best = Cheapest(0)
        for (role, _), fault in zip(rows, faults, strict=True):
            best.row(role[:1], ["", "blank", "duplicate", "truncated"].index(fault))
        cost, audit = best.end()
        assert (cost, audit) == expected[:2]
        assert tuple(f"{r}:{t}" for r, t in mended(rows, audit)) == expected[2]


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7])
def test_sequences_compare_like_strings(monkeypatch, modulus):
    """Also when nearly all hashes collide."""
    monkeypatch.setattr("lakestrata.llm.conversations._HASH_PRIME", modulus)
    draw, tree = random.Random(2), AuditTree()
    nodes = {"": 0}
    for _ in range(400):
        text = draw.choice(list(nodes))
        longer = text + draw.choice("DIKR")
        if longer not in nodes:
            nodes[longer] = tree.child(nodes[text], longer[-1])
    some = draw.sample(list(nodes), 120)
    for a, b in itertools.product(some, repeat=2):
        assert tree.before(nodes[a], nodes[b]) == (a < b)
        assert "".join(tree.symbols(nodes[a])) == a


@pytest.mark.parametrize("held", [16_384, 3])
def test_reports_equal_the_plain_version(spark, held):
    draw = random.Random(3)
    rows = []
    for conv in range(120):
        rows += [(conv, turn, *pair) for turn, pair in enumerate(talk(draw, draw.choice([0, 1, 2, 3, 8, 15])))]
    rows += [(None, turn, *pair) for turn, pair in enumerate(talk(draw, 9))]
    rows += [(500, turn, None, None) for turn in range(4)] + [(501, None, "user", "Only one turn, null."), (502, 3, "user", None)]
    # One conversation has most of the rows.
    rows += [(900, turn * 2, *pair) for turn, pair in enumerate(talk(draw, 1500))]
    draw.shuffle(rows)
    table = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, part string, closed boolean")
    got = reports(repair(damaged(table.repartition(5)), present=F.col("present"), held=held))
    assert got == {conv: plain_report(kept) for conv, kept in plain_damage(rows).items()}


def test_query_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = reports(QUERIES["op12_conversation_repair"](spark, SMALL_SF))
    assert got == {conv: plain_report(kept) for conv, kept in plain_damage(rows).items()}


def test_repeated_rows_and_one_turn_for_all(spark):
    rows = [(1, 5, "user", "Hello there.")] * 300 + [(2, 5, "assistant", "Yes.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = reports(repair(table, held=20))
    assert got[1] == plain_report([r[1:] for r in rows[:300]])
    assert got[2] == plain_report([r[1:] for r in rows[300:]])


def test_text_ids_and_an_empty_table(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert repair(spark.createDataFrame([], schema)).count() == 0
    table = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Ho."), ("b", 1, "user", "é" * 100_000)], schema)
    got = reports(repair(table))
    assert got["a"][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert got["b"] == plain_report([(1, "user", "é" * 100_000)])
