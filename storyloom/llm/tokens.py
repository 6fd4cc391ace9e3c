"""Byte-level BPE ids with a memory of the pieces between which no merge crosses."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken

# The pre-tokenizer of the vocabulary (fixed): merges never cross its matches.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for texts of Latin characters, whose letters and numbers are spelled out. Other
# texts go to the library whole, so nothing depends on two editions of Unicode.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")
OTHER = re.compile("[^\t\n\r -~¡-ɏ]")
MOST = 300_000


def _merger(vocabulary: str) -> tiktoken.Encoding | None:
    """A quick encoder of single pieces for a vocabulary whose ids follow its merges, as
    the ranks of that encoder do; None for others."""
    model = json.loads(vocabulary)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(other)}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    if any(model["vocab"].get(m.replace(" ", "")) != 256 + k for k, m in enumerate(merged)):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(merged)}
    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizer:
    """``encode(text)``: ids, and a number for each piece of the text (its word).
    ``spans(text)``: ids, and the characters from and to which each id stands for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.library.no_padding()
        self.library.no_truncation()
        merger = _merger(self.library.to_str())
        plain = lambda piece: self.library.encode(piece, add_special_tokens=False).ids
        self.merge = merger.encode_ordinary if merger else plain
        # Bytes of each id, where every id stands for bytes.
        self.sizes = np.array([len(merger.decode_single_token_bytes(i)) for i in range(merger.max_token_value + 1)]) if merger else None
        self.clear()

    def clear(self) -> None:
        self.number, self.lengths, self.flat, self.starts, self.filled = {}, np.zeros(1024, np.int64), np.zeros(8192, np.uint32), np.zeros(1024, np.int64), 0

    def _learn(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self.number]
        ids = list(map(self.merge, new))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        n, filled = len(self.number), self.filled + int(size.sum())
        if n + len(new) > len(self.lengths):
            self.lengths, self.starts = (np.resize(x, 2 * (n + len(new))) for x in (self.lengths, self.starts))
        if filled > len(self.flat):
            self.flat = np.resize(self.flat, 2 * filled)
        self.flat[self.filled:filled] = np.fromiter(chain.from_iterable(ids), np.uint32, filled - self.filled)
        self.lengths[n:n + len(new)] = size
        self.starts[n:n + len(new)] = self.filled + np.cumsum(size) - size
        self.number.update(zip(new, range(n, n + len(new))))
        self.filled = filled

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) character of every token."""
        if self.sizes is None:
            marked = self.library.encode(text, add_special_tokens=False).offsets
            both = np.array(marked, np.int64).reshape(-1, 2)
            return both[:, 0], both[:, 1]
        return characters(text, self.sizes[self(text)[0]])

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = PIECE.findall(text)
        try:
            word = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        except KeyError:
            self._learn(pieces)
            word = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        if OTHER.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32), word
        size = self.lengths[word]
        where = np.repeat(self.starts[word] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return self.flat[where], word


def characters(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) character of each of consecutive runs of bytes; a
    character whose bytes are in several runs belongs to each of them."""
    end = np.cumsum(lengths)
    start = end - lengths
    if text.isascii():
        return start, end
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(lead)])
    return np.where(np.append(lead, True)[start], upto[start], upto[start] - 1), upto[end]


@lru_cache(maxsize=2)
def _made(path: str) -> Tokenizer:
    return Tokenizer(path)


def tokenizer(path: str) -> Tokenizer:
    """One per worker process and vocabulary; between groups a large memory starts anew."""
    made = _made(path)
    if len(made.number) > MOST:
        made.clear()
    return made
