"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(_LOWER) if lower else text)


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    w = words(text, lower=True)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


class Groups:
    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a, b) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def similar(a: set, b: set, percent: int = 80) -> bool:
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def jaccard_groups(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text)."""
    sets = [(i, shingles(t)) for i, t in docs]
    groups = Groups()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and i != j and similar(a, b):
                groups.union(i, j)
    return [(i, len(s), None if i is None else groups.find(i)) for i, s in sets]


def kept_lines(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_removed, text) of (doc_id, text) with distinct doc_ids."""
    lines = []
    for i, t in docs:
        if i is not None and t is not None:
            lines += [(i, k, shingles(x)) for k, x in enumerate(t.split("\n"))]
    lines.sort(key=lambda x: x[:2])
    index = defaultdict(list)
    gone = set()
    for at, (i, k, s) in enumerate(lines):
        near = {j for x in s for j in index[x]}
        if any(similar(s, lines[j][2]) for j in near):
            gone.add((i, k))
        for x in s:
            index[x].append(at)
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, 0, 0, None))
            continue
        parts = t.split("\n")
        keep = [x for k, x in enumerate(parts) if (i, k) not in gone]
        out.append((i, len(parts), len(parts) - len(keep), "\n".join(keep)))
    return out


def kept_passages(docs: list[tuple], width: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, text) of (doc_id, text)."""
    least: dict = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[k : k + width])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1) if i is not None else ():
            if least[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        keep = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(keep), " ".join(keep)))
    return out


def rule_measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)


def base_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, stop), kinds 0 assign, 1 access, 2 hex."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [
        (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16
    ]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def base_sha256(text: str | None) -> str:
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base_secrets(text))
    return hashlib.sha256(joined.encode()).hexdigest()


def largest_entropy(run: str, window: int = 20) -> float:
    best = 0.0
    for i in range(len(run) - window + 1):
        many = Counter(run[i : i + window]).values()
        best = max(best, -sum(c / window * math.log2(c / window) for c in many))
    return best


def vector_links(rows: list[tuple], threshold: float = 0.98) -> list[tuple]:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label)."""
    import numpy as np

    units = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and None not in v
        x = np.asarray(v, dtype=float) if ok else None
        ok = ok and np.isfinite(x).all() and x.any()
        units.append(x / np.abs(x).max() if ok else None)
    units = [None if x is None else x / np.linalg.norm(x) for x in units]
    groups, links = Groups(), [0] * len(rows)
    for x in range(len(rows)):
        for y in range(x):
            a, b = units[x], units[y]
            if a is None or b is None or rows[x][2] != rows[y][2] or len(a) != len(b):
                continue
            if float(a @ b) >= threshold:
                links[x] += 1
                links[y] += 1
                groups.union(rows[x][0], rows[y][0])
    out = []
    for (i, _, _), n in zip(rows, links, strict=True):
        root = None if i is None else groups.find(i)
        out.append((i, n, root, None if i is None else i == root))
    return out
