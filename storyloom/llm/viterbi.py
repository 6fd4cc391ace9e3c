"""SentencePiece encoding by streaming Viterbi, and decoding.

Of all ways to cut a text into pieces of a vocabulary, the one with the best sum of scores is
found from left to right. Only the last positions from which a piece can still reach
forward (the longest piece's length) are alive. Each live position knows the first boundary
of its best path since the last commit; once all know the same one, every surviving path
runs through it, and the piece up to it is committed and forgotten. Between characters
that no piece of the vocabulary holds side by side (before a word, in most vocabularies) all
paths meet at once; what lies between two such places is cut by itself, and the first ``MOST`` of those cuts
are remembered.

Vocabularies trained as BPE are read as scored pieces too. Characters without a piece are
their UTF-8 bytes if the vocabulary has byte pieces, else the unknown id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.textbytes import chunks

SPACE = "▁"  # stands for a blank in pieces (fixed)
MOST = 500_000


class Pieces:
    """Pieces, scores and special ids of a model file, and the memory of cut words."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        texts = model.id_to_piece(list(every))
        own = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {texts[i]: (i, model.get_score(i)) for i in own}
        self.bytes = {int(texts[i][3:5], 16): i for i in every if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.penalty = min(s for _, s in self.pieces.values()) - 10
        self.longest = max(map(len, self.pieces))
        self.shown = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else t.encode() for i, t in enumerate(texts)]
        # Where no piece holds a blank after anything else, every word is cut by itself.
        apart = all(SPACE not in p.lstrip(SPACE) for p in self.pieces)
        self.word = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if apart else r"(?s).+")
        # Scores of pieces, None for what only begins one.
        self.reach: dict[str, float | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.reach |= {p: s for p, (_, s) in self.pieces.items()}
        self.packed = {p: i.to_bytes(4, "little") for p, (i, _) in self.pieces.items()}
        self.memory: dict[str, bytes] = {}

    def cut(self, text: str) -> tuple[list[int], int]:
        """Ids of a text, and the most characters that were ever held without a commit."""
        pieces, longest, ids, widest = self.pieces, self.longest, [], 0
        base, best, back, first = 0, [0.0], [0], [0]  # from the last commit on
        for i in range(1, len(text) + 1):
            low = max(base, i - longest)
            top, start = None, i - 1
            for j in range(low, i):
                found = pieces.get(text[j:i])
                if found is not None:
                    score = best[j - base] + found[1]
                elif j == i - 1:
                    score = best[j - base] + self.penalty
                else:
                    continue
                if top is None or score > top:
                    top, start = score, j
            best.append(top)
            back.append(start)
            first.append(i if start == base else first[start - base])
            widest = max(widest, i - base)
            while i - base >= longest:
                live = first[max(1, i - longest + 1 - base):]
                if live.count(live[0]) != len(live):
                    break
                b = live[0]
                if b == i:
                    break
                self._emit(text, base, b, ids)
                gone = b - base
                del best[:gone], back[:gone], first[:gone]
                base = b
                for k in range(1, len(first)):
                    s = back[k]
                    first[k] = base + k if s == base else first[s - base] if s > base else -1
        ends, at = [], len(text)
        while at > base:
            ends.append(at)
            at = back[at - base]
        for end in reversed(ends):
            self._emit(text, base, end, ids)
            base = end
        return ids, widest

    def cut_short(self, text: str) -> bytes:
        """Packed ids of a text too short for any commit before its end."""
        reach, n = self.reach, len(text)
        best, back = [0.0] + [-float("inf")] * n, [0] * (n + 1)
        for j in range(n):
            here = best[j]
            for i in range(j + 1, n + 1):
                score = reach.get(text[j:i], False)
                if score is None:
                    if i > j + 1:
                        continue
                    score = self.penalty
                elif score is False:
                    if i > j + 1:
                        break
                    score = self.penalty
                if here + score > best[i]:
                    best[i], back[i] = here + score, j
        out, at = [], n
        while at:
            start = back[at]
            out.append(self.packed.get(text[start:at]) or self._spelled(text[start:at]))
            at = start
        return b"".join(reversed(out))

    def _spelled(self, char: str) -> bytes:
        ids: list[int] = []
        self._emit(char, 0, 1, ids)
        return np.array(ids, "<u4").tobytes()

    def _emit(self, text: str, start: int, end: int, ids: list[int]) -> None:
        found = self.pieces.get(text[start:end])
        if found is not None:
            ids.append(found[0])
        elif self.bytes:
            ids.extend(self.bytes[b] for b in text[start:end].encode())
        else:
            ids.append(self.unknown)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        if not text:
            return b""
        words = self.word.findall(SPACE + text.replace(" ", SPACE))
        try:
            return b"".join(map(self.memory.__getitem__, words))
        except KeyError:
            out, memory = [], self.memory
            for w in words:
                made = memory.get(w)
                if made is None:
                    made = self.cut_short(w) if len(w) <= self.longest else np.array(self.cut(w)[0], "<u4").tobytes()
                    if len(memory) < MOST and len(w) <= 64:
                        memory[w] = made
                out.append(made)
            return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; ids that spell no valid UTF-8 give replacement characters."""
        text = b"".join(map(self.shown.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per worker process and model."""
    return Pieces(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, n_ids`` of every row: ``ids`` as little-endian 32-bit numbers.

    A blank is put before the text, as the vocabulary wants it. A null or empty text has no
    ids; repeated rows come back as often as they are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in chunks(batches):
            ids = [model.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                                             ["doc_id", "ids", "n_ids"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids binary, n_ids long")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, n_ids, text``: what ``encode`` gave, read back; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in chunks(batches, "ids"):
            text = [model.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "ids", "n_ids")], pa.array(text, pa.string())],
                                             ["doc_id", "ids", "n_ids", "text"])

    return encoded.select("doc_id", "ids", "n_ids").mapInArrow(run, "doc_id long, ids binary, n_ids long, text string")
