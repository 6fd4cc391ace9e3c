"""Chat formatting that can be read back exactly.

Grammar of a formatted conversation, one turn after another::

    turn      = user | assistant | system | other
    user      = "[INST] " body " [/INST]"
    assistant = "<s> " body " </s>"
    system    = "<<SYS>> " body " <</SYS>>"
    other     = "<<ROLE>> " body " <</ROLE>>" "<<SYS>> " body " <</SYS>>"    (role, text)
    body      = text without any of the marks

The parser is deterministic: it reads an opening mark, takes everything up to the next
closing mark of that kind, refuses a body with a mark, and takes one ``~`` out of each escaped mark. A body
is escaped by one more ``~`` before the last character of every string that looks like a
mark with any number of them (``[INST]`` becomes ``[INST~]``, ``[INST~]`` ``[INST~~]``). A turn
is first written as it is; if the parser recovers anything else than the turn, it is
written again with its bodies escaped, and compared again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of the template (fixed).
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>"),
         "role": ("<<ROLE>> ", " <</ROLE>>")}
_LOOKS = re.compile(r"(\[/?INST|</?s|<</?(?:SYS|ROLE)>)(~*)([>\]])")
_MARK = re.compile(r"\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>")
_OPEN = {mark: kind for kind, (mark, _) in MARKS.items()}


def escape(body: str) -> str:
    return _LOOKS.sub(r"\1\2~\3", body)


def unescape(body: str) -> str:
    return _LOOKS.sub(lambda m: m[1] + m[2][:-1] + m[3], body)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of formatted text."""
    turns, at, role = [], 0, None
    while at < len(text):
        mark = next((m for m in _OPEN if text.startswith(m, at)), None)
        if mark is None:
            raise ValueError(f"no turn begins at {at}")
        kind, close = _OPEN[mark], MARKS[_OPEN[mark]][1]
        end = text.find(close, at + len(mark))
        if end < 0:
            raise ValueError(f"the turn at {at} does not end")
        if _MARK.search(text, at + len(mark), end):
            raise ValueError(f"a mark inside the turn at {at}")
        body, at = unescape(text[at + len(mark):end]), end + len(close)
        if kind == "role":
            role = body
        else:
            turns.append((kind if role is None else role, body))
            role = None
    if role is not None:
        raise ValueError("a role without a text")
    return turns


def _write(role: str, text: str, change) -> tuple[str, int, int]:
    head = "" if role in MARKS and role != "role" else MARKS["role"][0] + change(role) + MARKS["role"][1]
    before, after = MARKS[role if not head else "system"]
    body = change(text)
    return head + before + body + after, len(head) + len(before), len(body)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses back to itself, and where in it the body lies."""
    for change in (str, escape):
        made = _write(role, text, change)
        try:
            if parse(made[0]) == [(role, text)]:
                return made
        except ValueError:
            pass
    raise ValueError(f"a turn of {role!r} cannot be written")


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, formatted, loss_start, loss_length``: one row per turn, in order. The
    concatenated parts are the conversation; the loss span (null but for assistants) is the
    body of the part, in code points from the part's start.

    A null role or text is an empty one, and rows of one conversation are ordered by turn,
    role and text, nulls first, so repeated turns stay side by side. Conversations without
    an id are one conversation of id null. Only the order within a conversation needs one
    task; a task reads turns as a stream and holds no conversation, so that its memory does
    not grow with the longest one."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                part = part + 1 if conv == last else 0
                last = conv
                made, start, size = render(role, text)
                learn = role == "assistant"
                out.append((conv, part, made, start if learn else None, size if learn else None))
            cols = zip(*out) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["conv_id", "part", "formatted", "loss_start", "loss_length"])

    return rows.mapInArrow(write, "conv_id long, part long, formatted string, loss_start long, loss_length long")


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """Parse what ``format_chats`` wrote: for each conversation ``n_turns``, ``turns_sha256``
    (role, line feed, text, line feed per turn), ``loss_chars`` and ``loss_sha256`` (the
    unescaped text under the loss spans) and ``formatted_chars``. ``ordered`` says that the rows
    come straight from ``format_chats``, each conversation in one partition and in order."""
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, None
        done: list[tuple] = []

        def close() -> None:
            done.append((last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, made, start, size in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length")]):
                if state is None or conv != last:
                    if state is not None:
                        close()
                    state, last = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                for role, text in parse(made):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learnt = unescape(made[start:start + size])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(made)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [[]] * 6, kinds)], names)
            done = []
        if state is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
