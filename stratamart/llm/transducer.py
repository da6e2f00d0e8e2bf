"""Count transducers: weighted acyclic automata that map a sequence of labels to a count.

In memory a transducer is unfolded into one state per prefix, level by level: arrays of the prefix
it extends, the label that extends it and its weight, in the order of the prefixes. On the wire it
is minimal: states from which the same continuations with the same weights lead on are one state.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from stratamart.llm.text import mix

U64 = np.uint64


@dataclass(frozen=True)
class Level:
    """States of one length of prefix, ordered by parent, then label."""

    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.label)

    def take(self, rows: np.ndarray, parent: np.ndarray) -> Level:
        return Level(parent, self.label[rows], self.weight[rows])


Levels = list[Level]


def size(levels: Levels) -> int:
    return sum(map(len, levels))


def counted(words: np.ndarray, longest: np.ndarray, depth: int) -> Levels:
    """How often each sequence of up to ``longest[i]`` words from place i on occurs.

    Sequences are put in order, a length at a time, and a state opens where one differs from the
    one before it. ``longest`` must not reach beyond the words.
    """
    labels, dense = np.unique(words, return_inverse=True)
    dense = dense.astype(np.int64)
    at = np.flatnonzero(longest > 0)
    state, out = np.zeros(len(at), dtype=np.int64), []
    for k in range(depth):
        here = longest[at] > k
        at, state = at[here], state[here]
        keys, state, weight = np.unique(
            state * len(labels) + dense[at + k], return_inverse=True, return_counts=True
        )
        wide = max(1, len(labels))
        out.append(Level(keys // wide, labels[keys % wide], weight.astype(np.int64)))
    return out


def sequences(paths: np.ndarray, lengths: np.ndarray, weights: np.ndarray, depth: int) -> Levels:
    """The transducer of given sequences; equal ones keep the largest weight, mere prefixes have 0."""
    state, rows, out = np.zeros(len(paths), dtype=np.int64), np.arange(len(paths)), []
    for k in range(depth):
        here = lengths[rows] > k
        rows, state = rows[here], state[here]
        level, state = _level(
            state, paths[rows, k], np.where(lengths[rows] == k + 1, weights[rows], 0), np.maximum
        )
        out.append(level)
    return out


def _level(parent: np.ndarray, label: np.ndarray, weight: np.ndarray, combine: np.ufunc) -> tuple:
    """States for pairs of parent and label, and the state of each pair."""
    order = np.lexsort((label, parent))
    p, x = parent[order], label[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (p[1:] != p[:-1]) | (x[1:] != x[:-1])
    first = np.flatnonzero(new)
    state = np.empty(len(order), dtype=np.int64)
    state[order] = np.cumsum(new) - 1
    total = combine.reduceat(weight[order], first) if len(first) else weight[:0]
    return Level(p[first], x[first], total), state


def union(parts: list[Levels], combine: np.ufunc = np.add) -> Levels:
    """All sequences of the parts; weights of equal ones are added, or combined otherwise."""
    if len(parts) == 1:
        return parts[0]
    depth = max(map(len, parts))
    maps = [np.zeros(1, dtype=np.int64) for _ in parts]
    out = []
    for k in range(depth):
        levels = [p[k] for p in parts]
        parent = np.concatenate([m[v.parent] for m, v in zip(maps, levels, strict=True)])
        level, state = _level(
            parent,
            np.concatenate([v.label for v in levels]),
            np.concatenate([v.weight for v in levels]),
            combine,
        )
        ends = np.cumsum([len(v) for v in levels])
        maps = np.split(state, ends[:-1])
        out.append(level)
    return out


def pruned(levels: Levels, least: int) -> Levels:
    """Without sequences of smaller weight, and without first labels that lead to none."""
    keep = [v.weight >= least for v in levels]
    for k in range(len(levels) - 1, 0, -1):
        keep[k - 1][levels[k].parent[keep[k]]] = True
    return chosen(levels, [np.flatnonzero(x) for x in keep])


def chosen(levels: Levels, rows: list[np.ndarray]) -> Levels:
    """Only the states of these rows, which are in order and hold the parents of all."""
    out, before = [], np.zeros(1, dtype=np.int64)
    for level, some in zip(levels, rows, strict=True):
        parent = level.parent[some]
        out.append(level.take(some, np.searchsorted(before, parent)))
        before = some
    return out


def ranges_of(first: np.ndarray, second: np.ndarray | None, n: int) -> np.ndarray:
    """The prefix range, of n, of sequences with these first labels (second: none for single ones)."""
    spread = mix(first) if second is None else mix(mix(first) + second)
    return ((spread >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def cut(levels: Levels, n: int) -> Iterator[tuple[int, Levels]]:
    """The transducer by prefix range.

    A single label lies in the range of that label, longer sequences in the range of their first
    two, so that a frequent first label is spread. There its own weight is 0.
    """
    ranges = [ranges_of(levels[0].label, None, n)]
    if len(levels) > 1:
        ranges.append(ranges_of(levels[0].label[levels[1].parent], levels[1].label, n))
    for level in levels[2:]:
        ranges.append(ranges[-1][level.parent])
    orders = [np.argsort(r, kind="stable") for r in ranges]
    ordered = [r[o] for r, o in zip(ranges, orders, strict=True)]
    for r in np.unique(np.concatenate(ranges)):
        rows = [
            o[np.searchsorted(s, r) : np.searchsorted(s, r, side="right")]
            for o, s in zip(orders, ordered, strict=True)
        ]
        own = rows[0]
        if len(levels) > 1:
            rows[0] = np.union1d(own, levels[1].parent[rows[1]])
        part = chosen(levels, rows)
        single = np.isin(rows[0], own, assume_unique=True)
        part[0] = Level(part[0].parent, part[0].label, np.where(single, part[0].weight, 0))
        yield int(r), part


def found(levels: Levels, paths: np.ndarray, length: int) -> np.ndarray:
    """States of sequences (rows of labels) in the level of their length; -1 where there is none."""
    state = np.zeros(len(paths), dtype=np.int64)
    for k in range(length):
        state = _next(levels[k], state, paths[:, k])
    return state


def _next(level: Level, parent: np.ndarray, label: np.ndarray) -> np.ndarray:
    if not len(level):
        return np.full(len(parent), -1, dtype=np.int64)
    labels, dense = np.unique(level.label, return_inverse=True)
    keys = level.parent * len(labels) + dense
    place = np.minimum(np.searchsorted(labels, label), len(labels) - 1)
    wanted = parent * len(labels) + place
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((parent >= 0) & (labels[place] == label) & (keys[at] == wanted), at, -1)


def composed(asked: Levels, counts: Levels) -> tuple[Levels, list[np.ndarray]]:
    """``asked`` with the weights that ``counts`` has for its sequences, and the states met there."""
    out, met, state = [], [], np.zeros(1, dtype=np.int64)
    for level, other in zip(asked, counts, strict=True):
        state = _next(other, state[level.parent], level.label)
        weight = np.zeros(len(state), dtype=np.int64)
        weight[state >= 0] = other.weight[state[state >= 0]]
        out.append(Level(level.parent, level.label, weight))
        met.append(state)
    return out, met


def paths_of(levels: Levels, length: int) -> np.ndarray:
    """Rows of labels of all sequences of a length."""
    state = np.arange(len(levels[length - 1]))
    out = np.empty((len(state), length), dtype=U64)
    for k in range(length - 1, -1, -1):
        out[:, k] = levels[k].label[state]
        state = levels[k].parent[state]
    return out


def packed(levels: Levels) -> bytes:
    """The minimal automaton as bytes.

    From the longest sequences back, states with equal arcs (label, weight, target) become one; only
    the arcs of one of them are written.
    """
    arrays: list[np.ndarray] = []
    target = np.zeros(len(levels[-1]), dtype=np.int64)
    for k in range(len(levels) - 1, 0, -1):
        level, n = levels[k], len(levels[k - 1])
        arc = mix(level.label + mix(level.weight.view(U64) + mix(target.view(U64))))
        sums = np.zeros((3, n), dtype=U64)
        with_arcs, first = np.unique(level.parent, return_index=True)
        if len(first):
            sums[0, with_arcs] = np.add.reduceat(arc, first)
            sums[1, with_arcs] = np.add.reduceat(mix(arc ^ U64(0x5851F42D4C957F2D)), first)
            sums[2, with_arcs] = np.diff(np.append(first, len(level)))
        order = np.lexsort(sums)
        new = np.ones(n, dtype=bool)
        new[1:] = (sums[:, order[1:]] != sums[:, order[:-1]]).any(axis=0)
        state = np.empty(n, dtype=np.int64)
        state[order] = np.cumsum(new) - 1
        one = np.zeros(n, dtype=bool)
        one[order[new]] = True
        arcs = np.flatnonzero(one[level.parent])
        arcs = arcs[np.argsort(state[level.parent[arcs]], kind="stable")]
        arrays += [
            np.bincount(state[level.parent[arcs]], minlength=int(new.sum())),
            level.label[arcs].view(np.int64), level.weight[arcs], target[arcs],
        ]
        target = state
    arrays += [levels[0].label.view(np.int64), levels[0].weight, target]
    head = np.array([len(levels), *map(len, arrays)], dtype=np.int64)
    return zlib.compress(np.concatenate([head, *arrays]).astype("<i8").tobytes(), 1)


def unpacked(data: bytes) -> Levels:
    """A transducer from its bytes."""
    values = np.frombuffer(zlib.decompress(data), dtype="<i8")
    depth = int(values[0])
    n = 4 * (depth - 1) + 3
    ends = np.cumsum(values[1 : n + 1]) + n + 1
    arrays = [values[e - s : e] for e, s in zip(ends, values[1 : n + 1], strict=True)]
    label, weight, target = arrays[-3:]
    out = [Level(np.zeros(len(label), dtype=np.int64), label.view(U64), weight)]
    for k in range(depth - 2, -1, -1):
        sizes, labels, weights, targets = arrays[4 * k : 4 * k + 4]
        first = np.cumsum(sizes) - sizes
        times = sizes[target]
        parent = np.repeat(np.arange(len(target)), times)
        arc = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + first[target][parent]
        out.append(Level(parent, labels[arc].view(U64), weights[arc]))
        target = targets[arc]
    return out
