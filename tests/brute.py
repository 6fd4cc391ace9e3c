"""Plain models of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np

from storyloom.functions.text import ENTITIES, INVISIBLE


def normalize(value: str) -> str:
    value = unicodedata.normalize("NFC", value)
    value = "".join(c for c in value if c not in INVISIBLE)
    for entity, char in ENTITIES:
        value = value.replace(entity, char)
    return re.sub(r"\s+", " ", value).strip()


def clean(rows: list[dict], min_chars: int = 50) -> list[int]:
    """Positions that survive, one row after the other."""
    ids, shingles, kept = set(), set(), []
    for row in sorted(rows, key=lambda r: r["pos"]):
        body = normalize(row["body"])
        if len(body) < min_chars or row["article_id"] in ids:
            continue
        ids.add(row["article_id"])
        shingle = re.sub(r"\W+", "", body[:300].lower())
        if shingle not in shingles:
            shingles.add(shingle)
            kept.append(row["pos"])
    return kept


def nearest(queries: dict, corpus: dict, k: int, skip_self: bool = False) -> dict:
    out = {}
    for q, v in queries.items():
        ranked = sorted((float(np.linalg.norm(np.subtract(v, w))), c) for c, w in corpus.items()
                        if not (skip_self and c == q))
        out[q] = ranked[:k]
    return out


def vote(ranked: list[tuple[float, str]], events: dict, threshold: float, majority: float):
    close = [(events[c], d) for d, c in ranked if d <= threshold]
    if not close:
        return None
    counts: dict[str, int] = {}
    for event, _ in close:
        counts[event] = counts.get(event, 0) + 1
    top = max(counts, key=lambda e: counts[e])
    if counts[top] / len(close) < majority:
        return None
    return top, min(d for e, d in close if e == top)


def hdbscan(points: dict[str, list[float]], min_size: int, min_samples: int) -> tuple[dict, dict]:
    """Labels (smallest member) and probabilities from the single-linkage tree."""
    names = sorted(points)
    n = len(names)
    x = np.array([points[name] for name in names], float)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(dist + np.diag([np.inf] * n), axis=1)[:, min_samples - 1] if min_samples > 1 else np.zeros(n)
    edges = sorted((max(dist[i, j], core[i], core[j]), names[i], names[j]) for i in range(n) for j in range(i + 1, n))
    tree = {name: None for name in names}
    top = {name: name for name in names}
    size = {name: 1 for name in names}
    serial = 0
    for w, a, b in edges:
        ra, rb = top[a], top[b]
        if ra == rb:
            continue
        node = f"#{serial}"
        serial += 1
        tree[node] = (w, ra, rb)
        size[node] = size[ra] + size[rb]
        for name in names:
            if top[name] in (ra, rb):
                top[name] = node

    def leaves(node):
        return [node] if tree[node] is None else leaves(tree[node][1]) + leaves(tree[node][2])

    clusters: dict[str, dict] = {}

    def walk(node, cluster, birth):
        entry = clusters.setdefault(cluster, {"birth": birth, "out": [], "kids": [], "all": leaves(node), "peak": 0.0})
        while tree[node] is not None:
            w, a, b = tree[node]
            lam = math.inf if w == 0 else 1 / w
            entry["peak"] = lam
            big = [c for c in (a, b) if size[c] >= min_size]
            for c in (a, b):
                if c not in big:
                    entry["out"] += [(leaf, lam) for leaf in leaves(c)]
            if len(big) == 2:
                for c in big:
                    entry["out"] += [(None, lam)] * size[c]
                    entry["kids"].append(c)
                    walk(c, c, lam)
                return
            if not big:
                return
            node = big[0]

    root = top[names[0]]
    walk(root, root, 0.0)
    chosen: set = set()

    def select(cluster):
        entry = clusters[cluster]
        below = sum(select(kid) for kid in entry["kids"])
        own = sum(lam - entry["birth"] for _, lam in entry["out"])
        if cluster != root and own >= below:
            chosen.add(cluster)
            return own
        return below

    select(root)
    labels, shares = {name: None for name in names}, {name: 0.0 for name in names}
    falls = {leaf: lam for entry in clusters.values() for leaf, lam in entry["out"] if leaf}

    def assign(cluster):
        entry = clusters[cluster]
        if cluster in chosen:
            for name in entry["all"]:
                labels[name] = min(entry["all"])
                lam, peak = falls[name], entry["peak"]
                shares[name] = 1.0 if peak == 0 or math.isinf(lam) else 0.0 if math.isinf(peak) else min(lam, peak) / peak
            return
        for kid in entry["kids"]:
            assign(kid)

    assign(root)
    return labels, shares


def components(nodes: list[str], linked) -> dict[str, str]:
    keeper = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and keeper[a] != keeper[b]:
                    keeper[a] = keeper[b] = min(keeper[a], keeper[b])
                    changed = True
    return keeper
