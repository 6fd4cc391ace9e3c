"""DuckDB SQL for spelling variants and conversation repair."""

from __future__ import annotations

from storyloom.llm import repair


def crc32_table() -> list[int]:
    """What four bits add to a crc32 (reflected polynomial 0xEDB88320)."""
    out = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        out.append(v)
    return out


def crc32(text: str) -> str:
    """The unsigned crc32 of the UTF-8 of a non-empty SQL string, four bits at a time; the low half of a byte comes
    first."""
    digits = f"list_transform(range(0, length(hex(encode({text})))), lambda i: instr('0123456789ABCDEF', hex(encode({text}))[i + 2 - 2 * (i % 2)]) - 1)"
    known = "[" + ", ".join(map(str, crc32_table())) + "]"
    step = f"lambda c, d: xor(c >> 4, {known}[(xor(c, d) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, ({digits})::BIGINT[]), {step}), 4294967295)"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

VARIANTS = f"""
    WITH RECURSIVE r AS (SELECT doc_id, run, count(*) AS k FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
    h AS (SELECT run, k, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r),
    w AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM h),
    c AS (SELECT word, sum(k)::BIGINT AS n FROM w GROUP BY 1 HAVING length(word) >= 6 AND sum(k) >= 5),
    d AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM c)),
    p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
        UNION SELECT d.word, c.word, c.n FROM d JOIN c ON d.less = c.word
        UNION SELECT c.word, d.word, d.n FROM d JOIN c ON d.less = c.word),
    b AS (SELECT word, count(*) AS n_near, max(near_n) AS top, arg_min(near, (-near_n, near)) AS best FROM p GROUP BY 1),
    f AS (SELECT c.word, c.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 5 * c.n THEN best END AS form, CASE WHEN top >= 5 * c.n THEN top END AS form_n
        FROM c LEFT JOIN b USING (word)),
    up AS (SELECT word, form, word AS top, 0 AS step FROM f UNION ALL SELECT up.word, f.form, up.form, step + 1 FROM up JOIN f ON f.word = up.form)
    SELECT f.word, f.form, u.root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(top, step) AS root FROM up GROUP BY 1) u USING (word)"""


def _best(options: list[str]) -> str:
    """The cheapest of structs of cost, edits and text; of equal costs the first edits."""
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


def _after(state: str, cost: str, edit: str, line: str = "''", when: str = "true") -> str:
    text = f"CASE WHEN {line} = '' THEN {state}.o WHEN {state}.o = '' THEN {line} ELSE {state}.o || chr(10) || {line} END"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'o': {text}}} END"


_STATES = ("s0", "s1", "s2", "s3")
_ROLES = {2: "user", 3: "assistant"}


def _inserted(name: str) -> str:
    """Select list with up to two rows inserted before the next one."""
    first = {2: [_after("s0", "5", "I", "'user:'"), _after("s1", "5", "I", "'user:'"), _after("s3", "5", "I", "'user:'")], 3: [_after("s2", "5", "I", "'assistant:'")]}
    return ", ".join([f"s0 AS {name}0", f"s1 AS {name}1"] + [f"{_best([f's{q}', *first[q]])} AS {name}{q}" for q in (2, 3)])


def _row(q: int) -> str:
    """State ``q`` after a row, from the states before it."""
    may, more = "fault <> 'x'", "(CASE WHEN fault = 't' THEN 5 ELSE 0 END)"
    line = "role || ':' || text"
    options = [_after(f"s{q}", "2", "D"), _after(f"s{q}", more, "K", line, f"{may} AND role = ''")]
    for (before, initial), to in repair.KEPT.items():
        if to == q:
            options.append(_after(f"s{before}", more, "K", line, f"{may} AND left(role, 1) = '{initial}'"))
    for before, to in repair.NEXT.items():
        if to == q:
            options.append(_after(f"s{before}", f"1 + {more}", "R", f"'{_ROLES[to]}:' || text", may))
    return _best(options)


_TURN_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_EMPTY = "NULL::STRUCT(c BIGINT, e VARCHAR, o VARCHAR)"

REPAIR = f"""
    WITH RECURSIVE g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_TURN_KEY)} % 20 AS how FROM conversations),
    d AS (SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
        CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE how WHEN 3 THEN 2 ELSE 1 END)) AS k FROM g WHERE how <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, k) AS nth, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM d),
    v AS (SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS why,
        left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, count(*) OVER (PARTITION BY conv_id) AS m FROM o),
    z AS (SELECT *, CASE why WHEN '' THEN '.' WHEN 'truncated' THEN 't' ELSE 'x' END AS fault FROM v),
    s AS (SELECT conv_id, 0 AS done, {{'c': 0::BIGINT, 'e': '', 'o': ''}} AS s0, {_EMPTY} AS s1, {_EMPTY} AS s2, {_EMPTY} AS s3 FROM (SELECT DISTINCT conv_id FROM z)
        UNION ALL
        SELECT conv_id, i, {", ".join(_row(q) for q in range(4))}
        FROM (SELECT t.conv_id, z.i, z.role, z.text, z.fault, {", ".join(f"t.s{q}" for q in range(4))}
            FROM (SELECT conv_id, done, s0, s1, s2, {_best(["s3", _after("s2", "5", "I", "'assistant:'")])} AS s3
                FROM (SELECT conv_id, done, {_inserted("s")} FROM s)) t
            JOIN z ON z.conv_id IS NOT DISTINCT FROM t.conv_id AND z.i = t.done + 1)),
    e AS (SELECT s.conv_id, {_best(["s0", "s3", _after("s2", "5", "I", "'assistant:'")])} AS x
        FROM s JOIN (SELECT conv_id, max(i) AS m FROM z GROUP BY 1) l ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND s.done = l.m),
    n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (why = 'blank') AS blank,
        count(*) FILTER (why = 'duplicate') AS duplicate, count(*) FILTER (why = 'truncated') AS truncated,
        count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM z GROUP BY 1)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(x.c, 0) AS cost, coalesce(x.e, '') AS audit, sha256(coalesce(x.o, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""
