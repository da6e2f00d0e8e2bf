"""Near copies among embedding vectors: an inverted multi-index with verification.

Vectors are scaled to length one and cut into halves. Each half has its own codebook, fitted on a
bounded sample; a pair of code words is a cell of the product grid, and every vector is listed in
one cell of its label's grid. A query reads every cell whose least possible distance from it is
within a bound, in no particular order: this is not the multi-sequence traversal, which would take
cells by distance and stop at a target recall. For recall 1 the bound is the distance of two vectors
at the threshold, so no link can be missed. Of these cells the vectors whose leading coordinates
allow a link (by the inequality of Cauchy and Schwarz) are verified in double precision.

The lists of a label are dealt by hash over as few blocks as fit a task's memory, each with the whole
grid. A vector is sent to its own block and, as a query, to half of the others, since a pair of
vectors needs to meet only once. So what is sent does not depend on the number of cells visited.
Vectors travel as they are in the table, and only once for each task that holds copies of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm.graph import connected_components
from stratamart.llm.staging import drop_read_shuffles, release, stage
from stratamart.llm.text import give_back, mix

#: Bytes of the vectors of a block of lists, which is what a task holds.
LIST_BYTES = 120 << 20
#: Queries that are looked up at once.
QUERIES = 1 << 14
#: Vectors that a cell should have, and code words of a half at most; vectors compared at once.
CELL = 64
MOST_CODES = 96
WIDEST = 2048
PAIRS = 1 << 20
#: Leading coordinates that are compared first, and how far their sums in single precision may err.
LEADING = 15
SLACK = 1e-5
#: Candidate pairs of a cell beyond which they are verified by a matrix product, pairs that wait for
#: verification, and links that wait to be reduced to a forest.
DENSE = 4096
WAITING = 1 << 17
EDGES = 1 << 21
#: Vectors that the codebooks are fitted on.
SAMPLE = 20_000

U64 = np.uint64


@dataclass(frozen=True)
class Codebooks:
    """Code words of the two halves of vectors of one length, the squared radius to visit, and the
    directions in which the vectors vary most (orthonormal columns)."""

    first: np.ndarray
    second: np.ndarray
    radius2: float
    leading: np.ndarray

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return units[:, :cut], units[:, cut:]


def bounds_to_cells(points: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's own code, and its squared least distance to any point of each code's cell.

    A point of another cell lies beyond the plane halfway between the two code words.
    """
    square = (points**2).sum(1)[:, None] - 2 * points @ codes.T + (codes**2).sum(1)[None]
    own = square.argmin(axis=1)
    apart = np.sqrt(np.maximum(((codes[:, None] - codes[None]) ** 2).sum(2), 1e-300))
    behind = (square - square[np.arange(len(points)), own][:, None]) / (2 * apart[own])
    behind[np.arange(len(points)), own] = 0
    return own, np.maximum(behind, 0) ** 2


def _codes(points: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Lloyd's k-means from rows drawn with a fixed seed."""
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(points))
    codes = points[order[:n]].copy()
    for _ in range(10):
        own = bounds_to_cells(points, codes)[0]
        total = np.zeros_like(codes)
        np.add.at(total, own, points)
        size = np.bincount(own, minlength=len(codes))
        codes[size > 0] = total[size > 0] / size[size > 0, None]
    return codes


def fit_codebooks(units: np.ndarray, n: int, threshold: float, target_recall: float) -> Codebooks:
    """Codebooks of ``n`` code words per half, and how far to visit.

    Below recall 1 the radius is the quantile of what sampled vectors need to reach a vector at
    the threshold in a random direction.
    """
    cut = (units.shape[1] + 1) // 2
    first, second = _codes(units[:, :cut], n, 1), _codes(units[:, cut:], n, 2)
    radius2 = 2 - 2 * threshold
    if target_recall < 1 and len(units) and units.shape[1] > 1:
        draw = np.random.Generator(np.random.PCG64(3)).normal(size=units.shape)
        draw -= (draw * units).sum(1)[:, None] * units
        draw /= np.linalg.norm(draw, axis=1)[:, None]
        there = threshold * units + math.sqrt(1 - threshold**2) * draw
        need = np.zeros(len(units))
        for codes, a, b in (
            (first, units[:, :cut], there[:, :cut]),
            (second, units[:, cut:], there[:, cut:]),
        ):
            reached = bounds_to_cells(b, codes)[0]
            need += bounds_to_cells(a, codes)[1][np.arange(len(units)), reached]
        radius2 = min(radius2, float(np.quantile(need, target_recall)))
    return Codebooks(first, second, radius2 + 1e-9, np.linalg.eigh(units.T @ units)[1][:, ::-1][:, :LEADING])


def one_code(length: int, threshold: float) -> Codebooks:
    """A grid of a single cell, for lengths of which the sample has no vector."""
    cut = (length + 1) // 2
    parts = np.zeros((1, cut)), np.zeros((1, length - cut))
    return Codebooks(*parts, 2 - 2 * threshold, np.eye(length)[:, :LEADING])


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of doubles divided by their largest absolute value."""
    rows = rows.astype(np.float64)
    return rows / np.abs(rows).max(axis=1)[:, None]


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


_RANDOM = np.random.Generator(np.random.PCG64(20_261))


def _digests(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each valid row, the same for rows that are equal once scaled."""
    width = rows.shape[1]
    while len(_FACTORS[0]) < width:
        for i, known in enumerate(_FACTORS):
            more = _RANDOM.integers(0, 1 << 63, 1024, dtype=U64) * U64(2) + U64(1)
            _FACTORS[i] = np.concatenate([known, more])
    bits = mix(_scaled(rows).view(U64))
    return tuple(mix((bits * f[:width]).sum(axis=1)).view(np.int64) for f in _FACTORS)


_FACTORS = [np.empty(0, U64), np.empty(0, U64)]


def _valid(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the valid vectors of a batch, by length."""
    vectors = part.column("embedding")
    here = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    vectors = vectors.drop_null()
    offsets = vectors.offsets.to_numpy()
    values = vectors.flatten().to_numpy(zero_copy_only=False)  # a null is not a number
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    for dim in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == dim)
        matrix = values[starts[rows][:, None] + np.arange(dim)]
        ok = np.isfinite(matrix).all(axis=1) & matrix.any(axis=1)
        if ok.any():
            yield here[rows[ok]], matrix[ok]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors by their digests."""
    for part in batches:
        for rows, matrix in _valid(part):
            at = pa.array(rows)
            columns = [part.column("vec_id").take(at), part.column("label").take(at)]
            columns += [pa.array(np.full(len(rows), matrix.shape[1], np.int32))]
            columns += [pa.array(h) for h in _digests(matrix)]
            yield pa.record_batch(columns, ["vec_id", "label", "dim", "h1", "h2"])


def _drawn(below: int):
    """Valid vectors with small digests, as bytes of doubles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for _, matrix in _valid(part):
                h1, h2 = _digests(matrix)
                some = np.flatnonzero(h1 <= below)
                values = [x.tobytes() for x in matrix[some].astype(np.float64)]
                dims = np.full(len(some), matrix.shape[1], np.int32)
                columns = [pa.array(dims), pa.array(h1[some]), pa.array(h2[some])]
                columns.append(pa.array(values, pa.binary()))
                yield pa.record_batch(columns, ["dim", "h1", "h2", "values"])

    return rows


_SENT = "label int, dim int, h1 bigint, h2 bigint, id bigint, weight bigint, values binary, "
_SENT += "block int, blocks int, others int"
_SENT_NAMES = [x.split(" ")[0] for x in _SENT.split(", ")]
_SENT_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary(), *[pa.int32()] * 3]


def _sent(blocks: dict[tuple[int, int], int]):
    """Each different vector of a task once, with the block that lists it and how many others it
    asks; copies follow as a row without vector."""

    def batch(label, h1, h2, ids, weight, values: list, dim: int) -> pa.RecordBatch:
        n = np.array([blocks.get((x, dim), 1) for x in label], dtype=np.int64)
        own = ((h1.view(U64) >> U64(32)) * n.astype(U64) >> U64(32)).astype(np.int64)
        others = (n - 1) // 2 + ((n % 2 == 0) & (own < n // 2))
        columns = [label, np.full(len(n), dim), h1, h2, ids, weight, values, own, n, others]
        arrays = [
            pa.array(x if t == pa.binary() else np.asarray(x).astype(t.to_pandas_dtype()), t)
            for x, t in zip(columns, _SENT_TYPES, strict=True)
        ]
        return pa.record_batch(arrays, _SENT_NAMES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list[int]] = {}
        for part in batches:
            for at, matrix in _valid(part):
                dim = matrix.shape[1]
                h1, h2 = _digests(matrix)
                ids = part.column("vec_id").take(pa.array(at)).to_numpy()
                label = part.column("label").take(pa.array(at)).to_pylist()
                new = []
                for i, key in enumerate(zip(label, h1.tolist(), h2.tolist(), strict=True)):
                    known = seen.get((*key, dim))
                    if known is None:
                        seen[(*key, dim)] = [0, 0]
                        new.append(i)
                    else:
                        known[1] = min(known[1], int(ids[i])) if known[0] else int(ids[i])
                        known[0] += 1
                values = [x.tobytes() for x in matrix[new]]
                some = [label[i] for i in new]
                yield batch(some, h1[new], h2[new], ids[new], np.ones(len(new)), values, dim)
        for dim in {key[3] for key in seen}:
            more = [(*key[:3], *n) for key, n in seen.items() if key[3] == dim and n[0]]
            if more:
                label, h1, h2, weight, ids = zip(*more, strict=True)
                h1, h2 = np.array(h1, dtype=np.int64), np.array(h2, dtype=np.int64)
                yield batch(label, h1, h2, ids, weight, [None] * len(more), dim)

    return rows


@dataclass
class _Side:
    """Different vectors: id, number of rows, values, and the digest of each."""

    ids: np.ndarray
    weight: np.ndarray
    values: np.ndarray
    h1: np.ndarray
    h2: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    @staticmethod
    def of(parts: list[pa.RecordBatch], dim: int, kind: type) -> _Side:
        """Of rows in the order of their digests; the parts are dropped as they are read."""
        ids, weight, h1, h2 = (
            np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("id", "weight", "h1", "h2")
        )
        has = np.concatenate([p.column("values").is_valid().to_numpy(zero_copy_only=False) for p in parts])
        values = np.empty((int(has.sum()), dim), dtype=kind)
        at = 0
        parts.reverse()
        while parts:
            some = _matrix(parts.pop().column("values"), dim, kind)
            values[at : at + len(some)] = some
            at += len(some)
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = np.flatnonzero(new)
        if len(first) < len(ids):
            place = np.where(has, np.cumsum(has) - 1, len(ids))
            values = values[np.minimum.reduceat(place, first)]
            ids, weight = np.minimum.reduceat(ids, first), np.add.reduceat(weight, first)
            h1, h2 = h1[first], h2[first]
        return _Side(ids, weight, values, h1, h2)

    def take(self, rows: np.ndarray) -> _Side:
        return _Side(self.ids[rows], self.weight[rows], self.values[rows], self.h1[rows], self.h2[rows])


def _matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    """The vectors of a column of bytes, without nulls."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)
    lo, hi = ends[column.offset], ends[column.offset + len(column)]
    if lo == hi:
        return np.empty((0, dim), kind)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[lo:hi].view(kind).reshape(-1, dim)


def _forest(a: np.ndarray, b: np.ndarray, links: list[tuple], n: int) -> np.ndarray:
    """The smallest node that each of n nodes reaches over blocks of links (rows, columns, mask)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        for rows, cols, mask in links:
            x, y = a[rows], b[cols]
            low = np.where(mask, root[x][:, None], n).min(axis=0)
            root[y] = np.minimum(root[y], low)
            low = np.where(mask, root[y][None], n).min(axis=1)
            root[x] = np.minimum(root[x], low)
        root = np.minimum(root, root[root])
        if (root == before).all():
            return root


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links, and the smallest node that each of them reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _few(close: np.ndarray) -> np.ndarray:
    """The places of the few true values of a matrix, sought eight at a time."""
    flat = close.reshape(-1)
    flat = np.append(flat, np.zeros(-len(flat) % 8, dtype=bool)) if len(flat) % 8 else flat
    words = np.flatnonzero(flat.view(U64))
    word, bit = np.nonzero(flat.reshape(-1, 8)[words])
    return 8 * words[word] + bit


class _Block:
    """A block of lists that queries are looked up in."""

    def __init__(self, listed: _Side, book: Codebooks, threshold: float) -> None:
        self.book, self.threshold = book, threshold
        n = len(listed)
        cells = np.empty(n, dtype=np.int64)
        leading = np.empty((n, book.leading.shape[1] + 1), dtype=np.float32)
        for lo in range(0, n, QUERIES):
            units = _unit_rows(listed.values[lo : lo + QUERIES])
            a, b = book.halves(units)
            own = bounds_to_cells(a, book.first)[0] * len(book.second)
            cells[lo : lo + QUERIES] = own + bounds_to_cells(b, book.second)[0]
            leading[lo : lo + QUERIES] = self.led(units)
        self.order = np.argsort(cells, kind="stable")
        self.own, self.leading = cells[self.order], leading[self.order]
        firsts = np.unique(self.own, return_index=True)[1]
        wide = np.diff(np.append(firsts, n))
        pieces = -(-wide // WIDEST)
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.starts = np.repeat(firsts, pieces) + WIDEST * piece
        self.ends = np.append(self.starts[1:], n)
        self.cells = self.own[self.starts]
        self.listed = listed
        self.links = np.zeros(n, dtype=np.int64)  # by place in the order of cells
        self.together = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_edges = 0

    def led(self, units: np.ndarray) -> np.ndarray:
        """Leading coordinates, and the length of what they leave."""
        front = units @ self.book.leading
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", front, front), 0))
        if front.shape[1] == units.shape[1]:
            rest[:] = 0
        return np.column_stack([front, rest]).astype(np.float32)

    def own_links(self) -> None:
        """Links between the listed vectors: each asks its own and later cells."""
        for lo in range(0, len(self.own), QUERIES):
            places = np.arange(lo, min(lo + QUERIES, len(self.own)))
            found = self.ask(self.listed.take(self.order[places]), places)
            self.links[places] += found  # to what ``ask`` has counted here meanwhile

    def ask(self, queries: _Side, places: np.ndarray | None = None) -> np.ndarray:
        """Links of each query to listed vectors, counted here for those as well.

        ``places`` are those of listed queries, which link to what comes after them.
        """
        units = _unit_rows(queries.values)
        a, b = self.book.halves(units)
        first = np.ascontiguousarray(bounds_to_cells(a, self.book.first)[1].T, dtype=np.float32)
        second = np.ascontiguousarray(bounds_to_cells(b, self.book.second)[1].T, dtype=np.float32)
        radius2 = np.float32(self.book.radius2 + SLACK)
        leading = self.led(units)
        total = np.zeros(len(queries), dtype=np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n_waiting, wide = 0, len(self.book.second)
        least = np.float32(self.threshold - SLACK)
        begin = 0 if places is None else int(np.searchsorted(self.cells, self.own[places[0]]))
        row, around = -1, np.empty(0, dtype=np.int64)
        for cell, lo, hi in zip(self.cells[begin:], self.starts[begin:], self.ends[begin:], strict=True):
            if cell // wide != row:
                row = cell // wide
                around = np.flatnonzero(first[row] <= radius2)
                there = first[row][around]
            rows = around[np.flatnonzero(there + second[cell % wide][around] <= radius2)]
            if places is not None:  # no cell before its own
                rows = rows[: np.searchsorted(rows, np.searchsorted(self.own[places], cell, side="right"))]
            if not len(rows):
                continue
            step = max(1, PAIRS // int(hi - lo))
            for some in (rows[i : i + step] for i in range(0, len(rows), step)):
                close = leading[some] @ self.leading[lo:hi].T >= least
                n_close = np.count_nonzero(close)
                if n_close > DENSE:
                    q, at = some[close.any(axis=1)], lo + np.flatnonzero(close.any(axis=0))
                    self.dense(queries, units, q, at, total, places)
                elif n_close:
                    hit = _few(close)
                    waiting.append((some[hit // (hi - lo)], lo + hit % (hi - lo)))
                    n_waiting += n_close
                if n_waiting > WAITING:
                    self.verified(queries, units, waiting, total, places)
                    n_waiting = 0
        self.verified(queries, units, waiting, total, places)
        return total

    def verified(self, queries, units, waiting: list, total: np.ndarray, places) -> None:
        """Count the links among candidate pairs."""
        if not waiting:
            return
        q, at = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting.clear()
        if places is not None:
            later = places[q] < at
            q, at = q[later], at[later]
        there = self.order[at]
        different = queries.ids[q] != self.listed.ids[there]
        q, at, there = q[different], at[different], there[different]
        for lo in range(0, len(q), 1 << 14):
            here, cols, rows = q[lo : lo + (1 << 14)], at[lo : lo + (1 << 14)], there[lo : lo + (1 << 14)]
            cosine = np.einsum("ij,ij->i", units[here], _unit_rows(self.listed.values[rows]))
            ok = cosine >= self.threshold
            here, cols, rows = here[ok], cols[ok], rows[ok]
            np.add.at(total, here, self.listed.weight[rows])
            np.add.at(self.links, cols, queries.weight[here])
            self.link(queries.ids[here], self.listed.ids[rows])

    def dense(self, queries, units, q: np.ndarray, at: np.ndarray, total: np.ndarray, places) -> None:
        """As ``verified`` for all pairs of some queries and some places."""
        there = self.order[at]
        mask = units[q] @ _unit_rows(self.listed.values[there]).T >= self.threshold
        mask &= queries.ids[q][:, None] != self.listed.ids[there][None]
        if places is not None:
            mask &= places[q][:, None] < at[None]
        number = mask.astype(np.float64)
        total[q] += (number @ self.listed.weight[there].astype(np.float64)).astype(np.int64)
        self.links[at] += (queries.weight[q].astype(np.float64) @ number).astype(np.int64)
        some, met = mask.any(axis=1), mask.any(axis=0)
        q, at, there, mask = q[some], at[met], there[met], mask[some][:, met]
        if not len(q):
            return
        if (self.together[at] == self.together[at[0]]).all():
            # Linked already: a link of each query is enough.
            self.link(queries.ids[q], self.listed.ids[there[mask.argmax(axis=1)]])
            return
        ids = np.concatenate([queries.ids[q], self.listed.ids[there]])
        nodes, place = np.unique(ids, return_inverse=True)
        a, b = place[: len(q)], place[len(q) :]
        root = _forest(a, b, [(np.arange(len(q)), np.arange(len(at)), mask)], len(nodes))
        self.link(nodes, nodes[root])
        self.reduce()

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges.append((a, b))
        self.n_edges += len(a)
        if self.n_edges > EDGES:
            self.reduce()

    def reduce(self) -> None:
        """The links as a forest."""
        if not self.n_edges:
            self.edges.clear()
            return
        nodes, roots = _roots(*(np.concatenate(x) for x in zip(*self.edges, strict=True)))
        linked = nodes != roots
        self.edges = [(nodes[linked], roots[linked])]
        self.n_edges = int(linked.sum())
        ids = self.listed.ids[self.order]
        at = np.minimum(np.searchsorted(nodes, ids), len(nodes) - 1)
        here = nodes[at] == ids
        # By the least listed vector of a tree: vectors that are linked have the same.
        self.together = np.arange(len(ids))
        least = np.full(len(nodes), len(ids))
        tree = np.searchsorted(nodes, roots[at[here]])
        np.minimum.at(least, tree, np.flatnonzero(here))
        self.together[here] = least[tree]


_FOUND = "id bigint, links bigint, root bigint, edge boolean"


def _counted(ids: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(links)
    columns = [ids[some], links[some], np.full(len(some), -1), np.zeros(len(some), bool)]
    return pa.record_batch([pa.array(x) for x in columns], ["id", "links", "root", "edge"])


def _verify(books: object, threshold: float, kind: type):
    """Queries of blocks against their lists: links counted, and links that span them.

    Of each block the list comes first, then the queries, each in the order of the digests.
    """

    def block(key: tuple, runs: Iterator[tuple[bool, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        dim = key[1]
        book = books.value.get(dim) or one_code(dim, threshold)
        waiting: list[pa.RecordBatch] = []
        here: _Block | None = None

        def listed() -> None:
            nonlocal here
            here = _Block(_Side.of(waiting, dim, kind), book, threshold)
            here.own_links()

        def asked(last: bool) -> Iterator[pa.RecordBatch]:
            queries = _Side.of(waiting, dim, kind)
            if not last:  # more copies of its last vector may follow
                keep = queries.take(np.array([len(queries) - 1]))
                columns = [keep.ids, keep.weight, keep.h1, keep.h2]
                arrays = [*map(pa.array, columns), pa.array([keep.values[0].tobytes()], pa.binary())]
                waiting.append(pa.record_batch(arrays, ["id", "weight", "h1", "h2", "values"]))
                queries = queries.take(np.arange(len(queries) - 1))
            if len(queries):
                yield _counted(queries.ids, here.ask(queries))

        for asks, some in runs:
            if asks and here is None:
                if not waiting:
                    break  # nothing is listed
                listed()
            waiting.append(some)
            if asks and sum(len(x) for x in waiting) >= QUERIES:
                yield from asked(False)
        if here is None and waiting:
            listed()
        elif waiting:
            yield from asked(True)
        if here is not None:
            yield _counted(here.listed.ids[here.order], here.links)
            here.reduce()
            for ids, roots in here.edges:
                columns = [ids, np.zeros(len(ids), np.int64), roots, np.ones(len(ids), bool)]
                yield pa.record_batch([pa.array(x) for x in columns], ["id", "links", "root", "edge"])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "weight", "h1", "h2", "values"]

        def runs() -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
            for part in batches:
                if not part.num_rows:
                    continue
                keys = np.stack([part.column(c).to_numpy() for c in ("label", "dim", "target")])
                asks = part.column("asks").to_numpy(zero_copy_only=False)
                change = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (asks[1:] != asks[:-1])
                cuts = [0, *(np.flatnonzero(change) + 1).tolist(), part.num_rows]
                rows = part.select(names)
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    yield tuple(keys[:, lo].tolist()), bool(asks[lo]), rows.slice(lo, hi - lo)

        stream = runs()
        ahead = next(stream, None)
        while ahead:
            key = ahead[0]

            def own(key: tuple = key) -> Iterator[tuple[bool, pa.RecordBatch]]:
                nonlocal ahead
                while ahead and ahead[0] == key:
                    yield ahead[1:]
                    ahead = next(stream, None)

            mine = own()
            yield from block(key, mine)
            for _ in mine:
                pass
        give_back()

    return tasks


def near_copies(
    vectors: DataFrame,
    threshold: float = 0.98,
    target_recall: float = 1.0,
    codes: int | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Two rows link if their labels are equal and not null and their cosine is ``threshold`` or more.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable by links, the row's own included, and ``kept`` says whether that is its own.

    - A vector that is null, empty, zero or holds a null or a non-finite number links with nothing.
      Vectors of different lengths do not link.
    - Equal vectors are verified once and counted as often as they occur. Rows that share a vec_id
      are one node of the components and count as one row each in ``n_links``.
    - A null vec_id links with nothing; its component_id and kept are null.
    - Columns other than the three are ignored. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    single = isinstance(vectors.schema["embedding"].dataType, T.ArrayType) and isinstance(
        vectors.schema["embedding"].dataType.elementType, T.FloatType
    )
    kind = np.float32 if single else np.float64
    vectors = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"),
        F.col("label").cast("int").alias("label"),
    )
    usable = vectors.where("vec_id is not null and label is not null and embedding is not null")
    same = ["label", "dim", "h1", "h2"]
    named = usable.mapInArrow(_named, "vec_id bigint, label int, dim int, h1 bigint, h2 bigint")
    named = stage(named, "named")
    heads = named.groupBy(*same).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    heads = stage(heads.where("weight > 1"), "heads")
    copied = F.when(F.col("weight").isNull(), F.col("vec_id")).otherwise(F.col("id")).alias("id")
    copies = named.join(heads, same, "left")
    copies = copies.select("vec_id", copied, F.coalesce("weight", F.lit(1)).alias("weight"))

    sizes = named.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    room = F.greatest(F.lit(1), F.floor(F.lit(LIST_BYTES // kind().itemsize) / F.col("dim")))
    sizes = stage(sizes.withColumn("blocks", F.ceil(F.col("n") / room).cast("int")), "sizes")
    total, largest = sizes.agg(F.sum("n"), F.max(F.ceil(F.col("n") / F.col("blocks")))).first()
    split = {(r["label"], r["dim"]): r["blocks"] for r in sizes.where("blocks > 1").collect()}
    different = (total or 0) - (heads.agg(F.sum(F.col("weight") - 1)).first()[0] or 0)
    codes = codes or max(4, min(MOST_CODES, math.isqrt(int(largest or 0) // CELL)))
    # Digests are spread evenly: below this one lie somewhat more than SAMPLE.
    below = int(min(2**63 - 1, -(2**63) + 2**64 * 1.2 * SAMPLE / max(different, 1)))
    drawn = usable.mapInArrow(_drawn(below), "dim int, h1 bigint, h2 bigint, values binary")
    drawn = drawn.dropDuplicates(["dim", "h1", "h2"]).orderBy("h1", "h2").limit(SAMPLE)
    by_dim: dict[int, list[bytes]] = {}
    for row in drawn.select("dim", "values").collect():
        by_dim.setdefault(row["dim"], []).append(bytes(row["values"]))
    books = {
        dim: fit_codebooks(
            _unit_rows(np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), dim)),
            min(codes, len(rows)),
            threshold,
            target_recall,
        )
        for dim, rows in by_dim.items()
    }

    step = F.explode(F.sequence(F.lit(0), F.col("others"))).alias("step")
    sent = usable.mapInArrow(_sent(split), _SENT).select("*", step)
    target = F.pmod(F.col("block") + F.col("step"), F.col("blocks")).alias("target")
    asks = (F.col("step") > 0).alias("asks")
    sent = sent.select("label", "dim", target, asks, "h1", "h2", "id", "weight", "values")
    order = ["label", "dim", "target"]
    sent = sent.repartition(*order).sortWithinPartitions(*order, "asks", "h1", "h2")
    shared = spark.sparkContext.broadcast(books)
    found = stage(sent.mapInArrow(_verify(shared, threshold, kind), _FOUND), "found")
    shared.unpersist()
    drop_read_shuffles(spark)
    counts = found.where("not edge").groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("edge").select(F.col("id").alias("a"), F.col("root").alias("b"))

    copies = stage(copies, "copies")
    release(named, heads, sizes)
    own = copies.where("vec_id <> id").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
    parts = connected_components(edges.union(own))
    linked = copies.join(counts, "id", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    valid = linked.join(parts, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("component", "vec_id")
    valid = valid.select("vec_id", "n_links", component.alias("component_id"))
    counted = valid.select("*", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return counted.union(_unlinked(vectors, parts))


def _unlinked(vectors: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows that link with nothing, if another row of their vec_id does not."""
    size = F.size("embedding")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    unusable = (
        F.col("vec_id").isNull()
        | F.col("label").isNull()
        | F.col("embedding").isNull()
        | (size == 0)
        | F.coalesce(bad, F.lit(True))
        | F.coalesce(zero, F.lit(True))
    )
    rows = vectors.where(unusable).select("vec_id")
    rows = rows.join(parts, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
