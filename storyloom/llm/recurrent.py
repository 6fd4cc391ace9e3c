"""A gated recurrent language model over words, trained and applied inside Spark tasks.

Words of the vocabulary (the most frequent ones) have a class each and a place in it; words
outside it have a class by the shape of their ending, and within such a class the probability
``(c + 0.5) / (N + 0.5 (V + 1))`` of their training count ``c``. The output is factored: first a
softmax over classes, then one over the words of the class. One gated layer carries its state
from window to window through a whole document, so a document's score is its complete
log-likelihood; gradients are truncated at the window.
"""

from __future__ import annotations

import zlib

import numpy as np

END = 0  # the word number of a text's end
SHAPES = 96


def shape(word: bytes) -> int:
    """Class of a word outside the vocabulary: by its last bytes and whether it is long."""
    return zlib.crc32(word[-3:]) % (SHAPES // 2) * 2 + (len(word) > 8)


class Model:
    """Parameters as one flat array, so that replicas can be averaged place by place."""

    def __init__(self, words: int, classes: int, hidden: int, flat: np.ndarray | None = None, seed: int = 7):
        self.words, self.classes, self.hidden = words, classes, hidden
        self.per = -(-words // classes)
        inputs, outputs = words + SHAPES, classes + SHAPES
        shapes = {"E": (inputs, 3 * hidden), "U": (hidden, 3 * hidden), "b": (3 * hidden,), "C": (hidden + 1, outputs),
                  "W": (classes, hidden + 1, self.per)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = (rng.standard_normal(size) * 0.1).astype(np.float32)
        self.flat, at = flat, 0
        for name, s in shapes.items():
            n = int(np.prod(s))
            setattr(self, name, flat[at:at + n].reshape(s))
            at += n
        # Places beyond the last word of a class have no probability.
        self.spare = (np.arange(classes)[:, None] + classes * np.arange(self.per)) >= words

    def start(self, class_counts: np.ndarray, word_counts: np.ndarray) -> None:
        """Begin from the training counts: biases are their logarithms."""
        self.C[-1] = np.log(class_counts + 0.5) - np.log(class_counts.sum() + 0.5)
        padded = np.zeros(self.classes * self.per)
        padded[:self.words] = word_counts
        self.W[:, -1] = np.log(padded + 0.5).reshape(self.per, self.classes).T

    def split(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place of word numbers; a class beyond the vocabulary's has one place."""
        known = number < self.words
        return np.where(known, number % self.classes, number - self.words + self.classes), np.where(known, number // self.classes, -1)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple:
        """State after one word for many documents at once."""
        k = self.hidden
        a, u = self.E.take(x, axis=0), h @ self.U
        a += self.b
        both = np.exp(-(a[:, :2 * k] + u[:, :2 * k]))
        both += 1
        np.reciprocal(both, out=both)
        z, r = both[:, :k], both[:, k:]
        n = np.tanh(a[:, 2 * k:] + r * u[:, 2 * k:])
        return n + z * (h - n), z, r, n, u[:, 2 * k:]

    def loss(self, h: np.ndarray, number: np.ndarray, grad: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of words given states; adds gradients of its negative."""
        h1 = np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)
        cls, place = self.split(number)
        rows = np.arange(len(h))
        logits = h1 @ self.C
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        total = e.sum(axis=1)
        out = logits[rows, cls] - np.log(total)
        dh = None
        if grad is not None:
            d = e / total[:, None]
            d[rows, cls] -= 1
            grad["C"] += h1.T @ d
            dh = d @ self.C.T
        order = np.argsort(cls, kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(self.classes + 1))
        for c in range(self.classes):
            at = order[cuts[c]:cuts[c + 1]]
            if not len(at):
                continue
            inner = h1[at] @ self.W[c]
            inner[:, self.spare[c]] = -1e9
            inner -= inner.max(axis=1, keepdims=True)
            e = np.exp(inner)
            total = e.sum(axis=1)
            own = np.arange(len(at))
            out[at] += inner[own, place[at]] - np.log(total)
            if grad is not None:
                d = e / total[:, None]
                d[own, place[at]] -= 1
                grad["W"][c] += h1[at].T @ d
                dh[at] += d @ self.W[c].T
        return out, dh[:, :-1] if grad is not None else None


def _columns(docs: list[np.ndarray], lanes: int) -> list[list[np.ndarray]]:
    """Deal documents to lanes of about equal length, longest first."""
    out, size = [[] for _ in range(lanes)], np.zeros(lanes, np.int64)
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        k = int(size.argmin())
        out[k].append(d)
        size[k] += len(docs[d])
    return out


def run(model: Model, docs: list[np.ndarray], window: int = 32, lanes: int = 512, rate: float = 0.0, clip: float = 1.0,
        memory: np.ndarray | None = None, learn_every: int = 1) -> np.ndarray:
    """Log-probability of every document (arrays of word numbers that finish with END). Lanes
    read documents one after another in lockstep, and a lane's state is zero where a document
    begins; there are no more lanes than ones of the longest document's length would hold. With a ``rate``, every ``learn_every``-th window is learnt from (Adagrad, whose
    squares stand in ``memory``), and the scores are those of these windows."""
    scores = np.zeros(len(docs))
    if not docs:
        return scores
    size = [len(d) for d in docs]
    dealt = _columns(docs, min(lanes, len(docs), -(-sum(size) // max(size))))
    streams = [np.concatenate([docs[d] for d in lane]) for lane in dealt]
    owners = [np.repeat(lane, [len(docs[d]) for d in lane]) for lane in dealt]
    longest = max(map(len, streams))
    order = np.argsort([-len(s) for s in streams], kind="stable")
    words = np.zeros((longest, len(streams)), np.int64)
    owner = np.full((longest, len(streams)), -1)
    for k, lane in enumerate(order):
        words[:len(streams[lane]), k] = streams[lane]
        owner[:len(owners[lane]), k] = owners[lane]
    live = (owner >= 0).sum(axis=1)
    before = np.vstack([np.full((1, len(streams)), END), words[:-1]])
    fresh = np.vstack([np.ones((1, len(streams)), bool), owner[1:] != owner[:-1]])
    begins = fresh.any(axis=1)
    h = np.zeros((len(streams), model.hidden), np.float32)
    k = model.hidden
    for number, at in enumerate(range(0, longest, window)):
        rows = range(at, min(longest, at + window))
        learn = rate > 0 and number % learn_every == 0
        kept, states = [], []
        for t in rows:
            n = live[t]
            h = np.where(fresh[t, :n, None], np.float32(0), h[:n]) if begins[t] else h[:n]
            after, *gates = model.step(before[t, :n], h)
            if learn:
                kept.append((h, *gates))
            states.append(after)
            h = after
        if rate > 0 and not learn:
            continue
        flat = np.concatenate(states)
        target = np.concatenate([words[t, :live[t]] for t in rows])
        grad = None
        if learn:
            g = Model(model.words, model.classes, model.hidden, np.zeros_like(model.flat))
            grad = {"C": g.C, "W": g.W}
        logp, dh_all = model.loss(flat, target, grad)
        scores += np.bincount(np.concatenate([owner[t, :live[t]] for t in rows]), weights=logp, minlength=len(docs))
        if not learn:
            continue
        cuts = np.cumsum([0, *[len(s) for s in states]])
        carry = np.zeros((0, k), np.float32)
        das, xs = [], []
        for i in range(len(states) - 1, -1, -1):
            prev, z, r, n, un = kept[i]
            t = at + i
            dh = dh_all[cuts[i]:cuts[i + 1]].copy()
            dh[:len(carry)] += carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (prev - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            das.append(np.concatenate([dz, dr, dn], axis=1))
            xs.append(before[t, :live[t]])
            g.U += prev.T @ du
            carry = (dh * z + du @ model.U.T) * ~fresh[t, :live[t], None]
        da = np.concatenate(das)
        g.b += da.sum(axis=0)
        np.add.at(g.E, np.concatenate(xs), da)
        scale = 1 / len(target)
        step = np.clip(g.flat * scale, -clip, clip)
        memory += step * step
        model.flat -= (rate * step / (np.sqrt(memory) + 1e-6)).astype(np.float32)
    return scores
