"""Repair of conversations by iterative-deepening A* over edits of their rows.

The roles of a sound conversation, by their initials, are ``(s?(ua)+)?``. A search state is how
many rows are done and what came last: nothing, ``s``, ``u`` or ``a``. From it the edits
are tried in the ASCII order of their initials: ``D`` delete (2), ``I`` insert an empty row of the
one role that may follow (5), ``K`` keep (0), ``R`` change the role to the one that may follow (1).
A kept or changed row whose text is cut off costs 5 more; blank and repeated rows have to go.

* The estimate of the cost that is left is 2 for each row with a fault, which it costs at least.
* A depth-first search goes no further than a bound; if it fails, the bound rises to the
  least total that it refused. A table holds for each failed state the cost that is still
  needed from there, and no state is tried again with less. So the first path that is
  accepted is a cheapest one, and of these the first in ASCII order.

A conversation of any length is searched in blocks of ``BLOCK`` rows, which tasks do on their
own: a block yields its cheapest edits from each state to each state. Blocks are then joined along
the conversation, where the costs known from the end backwards leave only cheapest ways.
No block ends with an insertion, so no block's edits begin another's, and the first ones in ASCII
order stay first when they are put together.

Rows are range-partitioned by conversation and turn, so one conversation that holds a third of
all rows is spread over tasks. Its texts pass one task only to be hashed in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.session import durable

BLOCK = 64
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what an inserted or changed row becomes
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DELETE, INSERT, RENAME, CUT = 2, 5, 1, 5
SPACES = " \t\n\x0b\x0c\r"
END = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


@lru_cache(maxsize=1 << 16)
def cheapest(rows: str, start: int, goal: int) -> tuple[int, str] | None:
    """Cost and edits of the cheapest way over ``rows`` from a state to a state, or None.
    ``rows`` has two characters a row: its role's initial (``-`` for an empty role, which a kept
    row adds nothing with) and ``.`` (sound), ``t`` (cut off) or ``x`` (has to go)."""
    n = len(rows) // 2
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if rows[2 * i + 1] != "." else 0)
    least: dict[tuple[int, int], int] = {}  # what failed states still need
    most = DELETE * n + 4 * INSERT  # deleting every row and inserting what is missing costs less

    def need(i: int, state: int) -> int:
        return max(rest[i], least.get((i, state), 0))

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        initial, fault = rows[2 * i], rows[2 * i + 1]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, NEXT[state]
        if fault == "x":
            return
        more = CUT if fault == "t" else 0
        kept = state if initial == "-" else KEPT.get((state, initial))
        if kept is not None:
            yield "K", more, i + 1, kept
        yield "R", RENAME + more, i + 1, NEXT[state]

    bound = need(0, start)
    while bound <= most:
        # Depth first: a frame is a state, what may still be spent there, and its moves.
        path: list[str] = []
        stack = [(0, start, bound, iter(moves(0, start)) if n else iter(()))]
        if not n and start == goal:
            return 0, ""
        while stack:
            i, state, left, edits = stack[-1]
            for edit, cost, j, to in edits:
                if cost + need(j, to) > left or to > goal < USER:
                    continue  # too dear, or past a state that nothing leads back to
                path.append(edit)
                if j == n and to == goal:
                    return bound, "".join(path)
                stack.append((j, to, left - cost, iter(moves(j, to)) if j < n else iter(())))
                break
            else:
                stack.pop()
                if path:
                    path.pop()
                onward = [cost + need(j, to) for _, cost, j, to in moves(i, state) if not to > goal < USER] if i < n else []
                least[i, state] = max(need(i, state), left + 1, min(onward, default=most + 1))
        bound = need(0, start)
    return None


def solve(rows: str, starts: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> list[tuple[int, int, int, str]]:
    """``from, to, cost, edits`` for every pair of states of a block."""
    out = []
    for start in starts:
        for goal in range(4):
            # Nothing leads back to an earlier kind of state but standing still.
            if goal >= start or goal >= USER:
                found = cheapest(rows, start, goal)
                if found:
                    out.append((start, goal, *found))
    return out


def join_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and edits of a whole conversation from the ways over its blocks."""
    left = [{state: cost for state, (cost, _) in END.items()}]
    for ways in reversed(blocks):
        after = left[-1]
        left.append({s: min(c + after[t] for a, t, c, _ in ways if a == s) for s in {w[0] for w in ways}})
    left.reverse()
    state, edits = START, []
    for k, ways in enumerate(blocks):
        best = min((e, t) for a, t, c, e in ways if a == state and c + left[k + 1][t] == left[k][state])
        edits.append(best[0])
        state = best[1]
    return left[0][START], "".join(edits) + END[state][1]


_BLOCKS = ("conv_id {id}, first long, rows long, turns long, low {turn}, high {turn}, blank long, duplicate long, truncated long, illegal long, "
           "head string, tail string, ways array<struct<a: int, b: int, cost: long, edits: string>>")


def _number(kind: str) -> pa.DataType:
    return {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]


def _fold(batches: Iterator[pa.RecordBatch], id_kind: str, turn_kind: str) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of sorted partitions."""
    kinds = [_number(id_kind), pa.int64(), pa.int64(), pa.int64(), _number(turn_kind), _number(turn_kind), *[pa.int64()] * 4, pa.string(), pa.string(),
             pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))]
    names = ["conv_id", "first", "rows", "turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "head", "tail", "ways"]
    out: list[tuple] = []
    held: list[tuple] = []
    now, at, begin, opens = None, 0, 0, False

    def close() -> None:
        nonlocal held
        if not held:
            return
        turns = [t for t, _, _ in held if t is not None]
        initials = [r for _, r, _ in held]
        faults = [f for _, _, f in held]
        code = "".join((r or "-") + {"": ".", "truncated": "t"}.get(f, "x") for r, f in zip(initials, faults))
        out.append((now, begin, len(held), len(set(turns)), min(turns, default=None), max(turns, default=None),
                    *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), initials[0], initials[-1],
                    [dict(zip(("a", "b", "cost", "edits"), w)) for w in (solve(code, (START,)) if opens else solve(code))]))
        held = []

    def flush() -> pa.RecordBatch:
        rows, out[:] = list(out), []
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")]
        for conv, turn, initial, fault in zip(*columns):
            if held and (conv != now or len(held) == BLOCK):
                close()
            if not held:
                # A conversation that follows another one here has no rows in earlier tasks.
                opens, now, begin = at > 0 and conv != now, conv, at
            held.append((turn, initial, fault))
            at += 1
        yield flush()
    close()
    yield flush()


def _join(group: pa.Table, id_kind: str) -> pa.Table:
    """The blocks of one conversation, in order, to its row."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["first"]))
    cost, audit = join_blocks([[(w["a"], w["b"], w["cost"], w["edits"]) for w in r["ways"]] for r in rows])
    known = [r for r in rows if r["low"] is not None]
    turns = sum(r["turns"] for r in rows) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    gaps = int(known[-1]["high"]) - int(known[0]["low"]) + 1 - turns if known else 0
    seams = sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    total["illegal"] += seams
    return pa.table({"conv_id": pa.array([rows[0]["conv_id"]], _number(id_kind)), "gaps": pa.array([gaps], pa.int64())}
                    | {c: pa.array([v], pa.int64()) for c, v in total.items()}
                    | {"cost": pa.array([cost], pa.int64()), "audit": pa.array([audit], pa.string())})


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with ``initial`` of the role and the first ``fault`` that counts: ``blank`` (nothing but
    white space), ``duplicate`` (role and text of an earlier row), ``truncated`` (the last other
    character is none of ``.!?``) or an empty string.

    Role and text are compared by two 64-bit hashes; copies of a row are numbered by a window
    that streams, so any number of them takes no memory."""
    shown = F.rtrim("text", F.lit(SPACES))
    marked = rows.withColumns({"_size": F.length(shown), "_last": F.right(shown, F.lit(1)),
                               "_h": F.xxhash64("role", F.lit(0), "text"), "_g": F.xxhash64("text", F.lit(1), "role")})
    order = Window.partitionBy("conv_id", "_h", "_g").orderBy(F.asc_nulls_first("turn"))
    marked = marked.withColumn("_nth", F.row_number().over(order))
    fault = (F.when(F.col("_size") == 0, "blank").when(F.col("_nth") > 1, "duplicate")
             .when(~F.col("_last").isin(".", "!", "?"), "truncated").otherwise(""))
    return marked.withColumns({"initial": F.left("role", F.lit(1)), "fault": fault}).drop("_size", "_last", "_h", "_g", "_nth")


def _hash(batches: Iterator[pa.RecordBatch], id_kind: str) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's repaired rows: its edits come first, then its rows.
    Only the edits and the state of the hash are held."""
    done: list[tuple] = []
    now = edits = digest = None
    at = state = lines = 0

    def put(role: str, text: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        lines += 1

    def inserted() -> None:
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            state = NEXT[state]
            put(ROLE[state], "")
            at += 1

    def close() -> None:
        if digest is not None:
            inserted()
            done.append((now, digest.hexdigest()))

    def flush() -> pa.RecordBatch:
        rows, done[:] = list(done), []
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], _number(id_kind)), pa.array([r[1] for r in rows], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    for batch in batches:
        for conv, audit, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]):
            if audit is not None:
                close()
                now, edits, digest, at, state, lines = conv, audit, hashlib.sha256(), 0, START, 0
                continue
            inserted()
            edit = edits[at]
            at += 1
            if edit == "K":
                state = state if role == "" else KEPT[state, role[0]]
                put(role, text)
            elif edit == "R":
                state = NEXT[state]
                put(ROLE[state], text)
        yield flush()
    close()
    yield flush()


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every
    conversation of ``conv_id, turn, role, text``.

    Rows are taken by turn, nulls first; rows of one turn by role and text. A null role or text
    is one space. A null id is a conversation like others. ``gaps`` counts the turns that are missing
    between the lowest and the highest. An empty table gives an empty result."""
    id_kind, turn_kind = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    given = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    flat = with_faults(given).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _BLOCKS.format(id=id_kind, turn=turn_kind)
    blocks = flat.select("conv_id", "turn", "initial", "fault").mapInArrow(lambda b: _fold(b, id_kind, turn_kind), schema)
    # The partition number orders the blocks of a conversation that spans several tasks.
    blocks = durable(blocks.withColumn("part", F.spark_partition_id()))
    found = durable(blocks.groupBy("conv_id").applyInArrow(
        lambda g: _join(g, id_kind), f"conv_id {id_kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
    head = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turn_kind).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    body = given.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    turn_order = [F.asc_nulls_first(c) for c in ("conv_id", "kind", "turn", "role", "text")]
    both = head.union(body).repartition("conv_id").sortWithinPartitions(*turn_order)
    hashed = both.select("conv_id", "audit", "role", "text").mapInArrow(lambda b: _hash(b, id_kind), f"conv_id {id_kind}, repaired_sha256 string")
    left, right = found.alias("f"), hashed.withColumnRenamed("conv_id", "_id")
    return left.join(right, F.col("f.conv_id").eqNullSafe(F.col("_id"))).select("f.*", "repaired_sha256")


def damage(rows: DataFrame) -> DataFrame:
    """Rows with the faults that ``crc32(conv_id:turn) % 20`` names: 0 drops a row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes its role ``user``. Nulls are one space."""
    space = F.lit(" ")
    given = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    marked = given.withColumn("how", F.explode(F.array(F.crc32(key) % 20))).filter("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                         F.explode(times).alias("copy")).drop("copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, with a row for each original one: those that lost
    every row have zeros, no edits and the hash of nothing."""
    fixed = repair(damage(rows)).withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct()
    joined = every.join(fixed, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
