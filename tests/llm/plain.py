"""Plain versions of the operators for small inputs, written from their definitions."""

import hashlib
import re
from collections import Counter

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def repeated_words(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    return len({i + j for i, g in enumerate(grams) if g in often for j in range(3)})


def measures(text):
    text = text or ""
    lines = [x for x in text.split("\n") if words(x)]
    return (len(words(text)), sum(map(len, words(text))), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), repeated_words(text))


def shingle_set(text, width=5):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def classes(texts, threshold=0.8):
    """Smallest id of the component of each id, by all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in ids}


def cut_repeats(texts, length):
    """Kept bytes and removed runs of each text, by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = [m.span() for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        out.append((bytes(c for c, g in zip(d, gone) if not g), [(a, b - a) for a, b in runs]))
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
