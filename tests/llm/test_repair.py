"""Conversation repair against every sequence of edits, and its streams over whole tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from storyloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
INSERTS = [("", "")] + [("I", r) for r in "ua"] + [("II", r + s) for r in "ua" for s in "ua"]


def _every(rows):
    """Cost and edits by trying all edits of ``(initial, fault)`` rows with at most two insertions."""
    best = None
    choices = []
    for initial, fault in rows:
        more = 5 if fault == "t" else 0
        kept = [] if fault == "x" else [("K", more, initial.strip("-")), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        choices.append([("D", 2, "")] + kept)
    slots = [s for s in itertools.product(INSERTS, repeat=len(rows) + 1) if sum(len(e) for e, _ in s) <= 2]
    for edits in itertools.product(*choices):
        for put in slots:
            cost = sum(c for _, c, _ in edits) + 5 * sum(len(e) for e, _ in put)
            audit = "".join(i + e for (i, _), (e, _, _) in itertools.zip_longest(put, edits, fillvalue=("", "", ""))) if edits else put[0][0]
            roles = "".join(r + k for (_, r), (_, _, k) in itertools.zip_longest(put, edits, fillvalue=("", "", ""))) if edits else put[0][1]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def _plain(rows):
    """Faults, cheapest edits and hash of one conversation given as (turn, role, text)."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("x" if not shown or (role, text) in seen else "." if shown[-1] in ".!?" else "t")
        seen.add((role, text))
    code = [(r[2][:1] or "-", f) for r, f in zip(rows, faults)]
    cost, audit = _every(code)
    state, lines, at = "", [], 0
    for edit in audit:
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state[-1:]]
        name = {"u": "user", "a": "assistant"}[after]
        if edit == "I":
            lines.append(f"{name}:")
            state += after
            continue
        _, _, role, text = rows[at]
        at += 1
        if edit != "D":
            lines.append(f"{role if edit == 'K' else name}:{text}")
            state += role[:1] if edit == "K" else after
    known = sorted({r[1] for r in rows if r[0]})
    gaps = known[-1] - known[0] + 1 - len(known) if known else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_search_equals_all_edits_whatever_the_blocks():
    rng = random.Random(8)
    for _ in range(60):
        rows = [(rng.choice("suuaa-x"), rng.choice("....tx")) for _ in range(rng.randint(0, 4))]
        want = _every(rows)
        for size in (1, 2, 9):
            codes = ["".join(a + b for a, b in rows[i:i + size]) for i in range(0, len(rows), size)]
            ways = [repair.solve(c) if i else repair.solve(c, (repair.START,)) for i, c in enumerate(codes)]
            assert repair.join_blocks(ways) == want, (rows, size)


def test_long_conversations_cost_the_same_in_any_blocks():
    rng = random.Random(2)
    rows = [("ua"[i % 2] if rng.random() < 0.9 else rng.choice("sua"), rng.choice("........tx")) for i in range(300)]
    found = set()
    for size in (20, 64, 150):
        codes = ["".join(a + b for a, b in rows[i:i + size]) for i in range(0, len(rows), size)]
        found.add(repair.join_blocks([repair.solve(c) for c in codes]))
    assert len(found) == 1


@pytest.fixture(scope="module")
def talks():
    """Conversations of up to four rows with nulls, gaps, ties, repeated rows and odd roles."""
    rng = random.Random(4)
    words = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Yes.", "é."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    out = [(c, rng.choice([None, 0, 1, 2, 5]), rng.choice(roles), rng.choice(words)) for c in range(60) for _ in range(rng.randint(1, 4))]
    return out + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]


def test_repair_equals_plain(spark, talks):
    got = repair.repair(spark.createDataFrame([(*r, 7) for r in talks], SCHEMA + ", cost int").repartition(5)).collect()
    by = {}
    for c, *row in talks:
        by.setdefault(c, []).append(row)
    assert len(got) == len(by)
    for r in got:
        assert (r.gaps, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == _plain(by[r.conv_id]), r.conv_id
        assert r.blank == sum(not (x if x is not None else " ").strip(" \n") for _, _, x in by[r.conv_id])


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(1)
    rows = [(7, i, "ua"[i % 2] == "u" and "user" or "assistant", f"row {i % 700}" + rng.choice(["."] * 9 + [""])) for i in range(900)]
    rows += [(c, 0, "user", "alone.") for c in (1, 9)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = repair.with_faults(frame).repartitionByRange("conv_id", "turn")
        assert sum(n > 0 for n in parts.rdd.mapPartitions(lambda p: [sum(r.conv_id == 7 for r in p)]).collect()) > 1
        got = {r.conv_id: r for r in repair.repair(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    codes = ["".join(r[2][0] + ("x" if (r[2], r[3]) in {(q[2], q[3]) for q in rows[:i]} else "." if r[3][-1] == "." else "t") for i, r in enumerate(rows[:900]))]
    cost, audit = repair.join_blocks([repair.solve(codes[0])])
    assert (got[7].cost, got[7].audit) == (cost, audit) and got[7].duplicate == codes[0].count("x")
    # A lone question is dropped: that is cheaper than an answer.
    assert {(got[c].cost, got[c].audit) for c in (1, 9)} == {(2, "D")}


def test_damage(spark, talks):
    rows = [(c, t, "assistant", "Yes. No! cut") for c in range(30) for t in (None, 0, 1)]
    got = sorted(map(tuple, repair.damage(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        how = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if how == 4 else role, "" if how == 1 else "Yes No cut" if how == 2 else text)
        want += [row] * (0 if how == 0 else 2 if how == 3 else 1)
    assert got == sorted(want, key=str) and len(want) != len(rows)


def test_conversations_that_lose_every_row_and_empty_tables(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    got = repair.repair_damaged(spark.createDataFrame([(gone, 1, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_damaged(none).count() == 0 and repair.repair(none).count() == 0
