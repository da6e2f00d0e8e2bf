"""Nearest neighbours of vectors: a graph built by NN-descent, searched greedily.

Building. Every vector keeps its ``neighbours`` nearest known others. A round brings together, for
each node, the vectors of its neighbours and of the nodes it is a neighbour of: neighbours of one
node are likely to be near each other, so their distances are taken and offered to both. Pairs that
have met are not compared again (edges are ``fresh`` once). Rounds are Spark joins: lists of edges
with the vectors they need, dealt out by blocks of nodes that lie close together, so that a vector is
sent once per block and not once per list. They end when few edges change.

The first edges come from a few random partitions of space: hyperplanes halfway between sampled
vectors give every vector a signature, and vectors of one signature are compared among themselves.

Searching. A query keeps the ``width`` nearest nodes seen, opens the nearest unopened ones, and sees
their neighbours, until all it keeps are opened. All queries move together, one Spark join a step.

Equal vectors are one node. Distances while building and searching are single precision; what is
returned is computed anew in double precision from the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.staging import release, stage

#: Nodes compared with each other at once, and nodes whose lists meet in one task.
BLOCK = 512
#: Vectors that hyperplanes and entry points are drawn from.
SAMPLE = 2_000
#: Queries moved together in one group.
QUERY_BLOCK = 128


@dataclass(frozen=True)
class Building:
    """Parameters of the graph.

    ``neighbours`` edges are kept per node, and as many edges that point to it take part in a round.
    Rounds end when fewer than ``settled`` of all edges are new, after ``rounds`` at most.
    """

    neighbours: int = 32
    partitions: int = 3
    settled: float = 0.03
    rounds: int = 12


@dataclass(frozen=True)
class Searching:
    """Parameters of a search: nodes kept per query, nodes opened per step, entry points."""

    width: int = 256
    opened: int = 64
    entries: int = 256


@dataclass(frozen=True)
class Graph:
    """``nodes`` (node, dim, vec, exact), ``copies`` (vec_id, node) and ``edges`` (node, near)."""

    nodes: DataFrame
    copies: DataFrame
    edges: DataFrame
    sample: list


def usable() -> F.Column:
    """Vectors that take part: not null, empty or zero, and finite in every component."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    other = F.exists("embedding", lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.coalesce(~odd & other, F.lit(False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, with the largest exponent taken out of a single-precision copy."""
    for part in batches:
        column = part.column("embedding")
        ends = np.cumsum(pc_lengths(column))
        values = column.flatten().to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
        exact = [x.tobytes() for x in np.split(values, ends[:-1])] if len(ends) else []
        small = (values / part.column("scale").to_numpy()[0] if len(values) else values).astype("<f4")
        vec = [x.tobytes() for x in np.split(small, ends[:-1])] if len(ends) else []
        lengths = np.diff(np.concatenate([[0], ends])).astype(np.int32)
        yield pa.record_batch(
            [part.column("vec_id"), pa.array(lengths), pa.array(vec, pa.binary()), pa.array(exact, pa.binary())],
            ["vec_id", "dim", "vec", "exact"],
        )


def pc_lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<f4").reshape(len(rows), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b (batched in leading axes)."""
    dot = a @ np.swapaxes(b, -1, -2)
    square = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * dot
    return np.maximum(square, 0)


def _planes(sample: list, bits: int, seed: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of vector: normals and offsets of planes halfway between two sampled vectors."""
    out = {}
    by_dim: dict[int, list[bytes]] = {}
    for row in sample:
        by_dim.setdefault(row["dim"], []).append(bytes(row["vec"]))
    for dim, rows in by_dim.items():
        if len(rows) < 2 or not bits:
            continue
        points = np.frombuffer(b"".join(rows), dtype="<f4").reshape(len(rows), dim)
        draw = np.random.Generator(np.random.PCG64([seed, dim]))
        pairs = np.stack([draw.choice(len(rows), 2, replace=False) for _ in range(bits)])
        a, b = points[pairs[:, 0]], points[pairs[:, 1]]
        out[dim] = (a - b, ((a * a).sum(1) - (b * b).sum(1)) / 2)
    return out


def _signed(nodes: DataFrame, sample: list, bits: int, seed: int) -> DataFrame:
    """With ``block``: nodes on the same side of all planes, in parts of about BLOCK nodes."""
    shared = nodes.sparkSession.sparkContext.broadcast(_planes(sample, bits, seed))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            dims = part.column("dim").to_numpy(zero_copy_only=False)
            out = np.zeros(len(dims), dtype=np.int64)
            for dim in np.unique(dims):
                if int(dim) in shared.value:
                    rows = np.flatnonzero(dims == dim)
                    normals, offsets = shared.value[int(dim)]
                    side = _matrix(part.column("vec").take(pa.array(rows))) @ normals.T > offsets
                    out[rows] = side @ (1 << np.arange(bits, dtype=np.int64))
            yield pa.record_batch([*part.columns, pa.array(out)], [*part.schema.names, "side"])

    schema = "node bigint, dim int, vec binary, side bigint"
    sided = nodes.select("node", "dim", "vec").mapInArrow(sign, schema)
    sizes = sided.groupBy("dim", "side").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    block = F.xxhash64("dim", "side", part)
    return sided.join(sizes, ["dim", "side"]).select("node", "dim", "vec", block.alias("block"))


def _nearest_in_block(neighbours: int):
    def nearest(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        vectors = _matrix(group.column("vec"))
        froms, tos, far = [], [], []
        keep = min(neighbours, len(nodes) - 1)
        for at in range(0, len(nodes) if keep else 0, BLOCK):
            square = _squares(vectors[at : at + BLOCK], vectors)
            own = np.arange(len(square))
            square[own, at + own] = np.inf
            best = np.argpartition(square, keep - 1, axis=1)[:, :keep]
            froms.append(np.repeat(nodes[at : at + BLOCK], keep))
            tos.append(nodes[best].ravel())
            far.append(np.take_along_axis(square, best, 1).ravel())
        return _edges(froms, tos, far)

    return nearest


def _edges(froms: list, tos: list, far: list) -> pa.Table:
    def whole(parts: list, kind: str) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty(0, kind)

    return pa.table(
        {
            "node": pa.array(whole(froms, "i8"), pa.int64()),
            "near": pa.array(whole(tos, "i8"), pa.int64()),
            "far": pa.array(whole(far, "f4").astype("f4"), pa.float32()),
        }
    )


_EDGE = "node bigint, near bigint, far float"


def _closest(edges: DataFrame, by: str, other: str, n: int) -> DataFrame:
    """The n shortest edges per ``by``; Spark cuts to n per task before the shuffle."""
    order = Window.partitionBy(by).orderBy("far", other)
    return edges.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def _met(k: int, blocks_of_lists: pa.Table, vectors: pa.Table) -> pa.Table:
    """Distances among the members of each node's list, if they may enter a member's list.

    No more than the k shortest per member leave the block, since none of the others can stay.
    """
    froms, tos, far = [], [], []
    if blocks_of_lists.num_rows and vectors.num_rows:
        nodes = vectors.column("node").to_numpy()
        order = np.argsort(nodes)
        nodes, bound = nodes[order], vectors.column("bound").to_numpy()[order]
        points = _matrix(vectors.column("vec"))[order]
        lists = blocks_of_lists.column("members").combine_chunks()
        sizes = pc_lengths(lists)
        flat = lists.flatten()
        place = np.searchsorted(nodes, flat.field("near").to_numpy())
        fresh = flat.field("fresh").to_numpy(zero_copy_only=False)
        widest = int(sizes.max())
        row = np.repeat(np.arange(len(sizes)), sizes)
        col = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        index = np.zeros((len(sizes), widest), dtype=np.int64)
        there = np.zeros(index.shape, dtype=bool)
        new = np.zeros(index.shape, dtype=bool)
        index[row, col], there[row, col], new[row, col] = place, True, fresh
        for at in range(0, len(index), 256):
            i, t, f = (x[at : at + 256] for x in (index, there, new))
            square = _squares(points[i], points[i])
            wanted = t[:, :, None] & t[:, None, :] & (f[:, :, None] | f[:, None, :])
            wanted &= (i[:, :, None] != i[:, None, :]) & (square < bound[i][:, :, None])
            m, a, b = np.nonzero(wanted)
            froms.append(i[m, a])
            tos.append(i[m, b])
            far.append(square[m, a, b])
        pair = np.concatenate(froms) * len(nodes) + np.concatenate(tos)
        _, first = np.unique(pair, return_index=True)
        froms, tos, far = (np.concatenate(x)[first] for x in (froms, tos, far))
        order = np.lexsort((tos, far, froms))
        froms, tos, far = froms[order], tos[order], far[order]
        place = np.arange(len(froms)) - np.searchsorted(froms, froms)
        short = place < k
        froms, tos, far = [nodes[froms[short]]], [nodes[tos[short]]], [far[short]]
    return _edges(froms, tos, far)


def build(vectors: DataFrame, how: Building | None = None) -> Graph:
    """The neighbour graph of the vectors of (vec_id, embedding); see ``nearest``."""
    how = how or Building()
    k = how.neighbours
    vectors = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where(usable())
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x)))
    scale = vectors.agg(F.max(largest)).first()[0] or 1.0
    packed = vectors.withColumn("scale", F.lit(float(scale))).mapInArrow(
        _packed, "vec_id bigint, dim int, vec binary, exact binary"
    )
    same = [F.xxhash64("exact").alias("h1"), F.xxhash64(F.lit(1), "exact").alias("h2")]
    packed = stage(packed.select("*", *same).drop_duplicates(["vec_id", "dim", "h1", "h2"]), "vectors")
    heads = packed.groupBy("dim", "h1", "h2").agg(
        F.min("vec_id").alias("head"), F.first("vec").alias("vec"), F.first("exact").alias("exact")
    )
    # A vec_id may come with several vectors, so a node's name is drawn from the vector itself.
    name = F.xxhash64("dim", "h1", "h2", "head").alias("node")
    nodes = stage(heads.select(name, "dim", "vec", "exact", "h1", "h2"), "nodes")
    copies = packed.join(nodes.select("dim", "h1", "h2", "node"), ["dim", "h1", "h2"])
    copies = stage(copies.select("vec_id", "node"), "copies")
    n = nodes.count()
    sample = nodes.orderBy(F.xxhash64(F.lit(7), "node")).limit(SAMPLE).select("node", "dim", "vec").collect()

    first = None
    placed = None
    bits = int(n / (BLOCK / 2)).bit_length()
    for seed in range(how.partitions + 1):
        # Without planes, the last one deals nodes out at random, so that none starts alone.
        sided = stage(_signed(nodes, sample, bits if seed < how.partitions else 0, seed), "sided")
        found = sided.groupBy("block").applyInArrow(_nearest_in_block(k), _EDGE)
        first = found if first is None else first.union(found)
        placed = placed or sided
    graph = _merged(first.withColumn("fresh", F.lit(True)), k)
    for _ in range(how.rounds):
        if graph.where("fresh").count() <= how.settled * k * n:
            break
        offered = _offered(graph, placed, k)
        known = graph.withColumn("fresh", F.lit(False)).select("node", "near", "far", "fresh")
        old, graph = graph, _merged(known.union(offered.withColumn("fresh", F.lit(True))), k)
        release(old)
    both = graph.select("node", "near", "far").union(
        _closest(graph, "near", "node", k).select(
            F.col("near").alias("node"), F.col("node").alias("near"), "far"
        )
    )
    edges = stage(both.groupBy("node").agg(F.collect_set("near").alias("near")), "edges")
    return Graph(nodes.select("node", "dim", "vec", "exact"), copies, edges, sample)


def _merged(edges: DataFrame, k: int) -> DataFrame:
    """The k shortest edges of each node; an edge known before stays known."""
    once = edges.groupBy("node", "near").agg(F.min("far").alias("far"), F.min("fresh").alias("fresh"))
    return stage(_closest(once, "node", "near", k).drop("place"), "graph")


def _offered(graph: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """One round: edges between neighbours of neighbours that may be shorter than known ones."""
    back = _closest(graph, "near", "node", k)
    members = graph.select("node", "near", "fresh").union(
        back.select(F.col("near").alias("node"), F.col("node").alias("near"), "fresh")
    )
    members = members.groupBy("node", "near").agg(F.max("fresh").alias("fresh"))
    lists = members.groupBy("node").agg(  # 2 k members at most
        F.collect_list(F.struct("near", "fresh")).alias("members"), F.max("fresh").alias("any")
    )
    lists = lists.where("any").join(placed.select("node", "block"), "node")
    lists = stage(lists.select("node", "block", "members"), "lists")
    full = graph.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("longest"))
    bound = F.when(F.col("n") >= k, F.col("longest")).otherwise(F.lit(float("inf"))).cast("float")
    bounds = full.select("node", bound.alias("bound"))
    needed = lists.select("block", F.explode("members.near").alias("node")).distinct()
    needed = needed.toDF("wanted_in", "node")
    vectors = placed.select("node", "vec").join(bounds, "node").join(needed, "node")
    both = lists.groupBy("block").cogroup(vectors.groupBy("wanted_in"))
    return both.applyInArrow(lambda a, b: _met(k, a, b), _EDGE)


_STATE = "node bigint, vec binary, ids array<bigint>, far array<float>, opened array<boolean>, seen array<bigint>"
_STATE_TYPES = [
    pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()),
    pa.list_(pa.int64()),
]
_STATE_NAMES = [part.split(" ")[0] for part in _STATE.split(", ")]


def _states(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_STATE_NAMES)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, _STATE_TYPES, strict=True)]
    return pa.record_batch(arrays, _STATE_NAMES)


def _kept(ids: np.ndarray, far: np.ndarray, opened: np.ndarray, width: int) -> tuple:
    order = np.lexsort((ids, far))[:width]
    return ids[order], far[order], opened[order]


def _started(queries: DataFrame, sample: list, how: Searching) -> DataFrame:
    """Each query with its own node and the nearest entry points."""
    shared = queries.sparkSession.sparkContext.broadcast(
        [(r["node"], r["dim"], bytes(r["vec"])) for r in sample[: how.entries]]
    )

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in {dim for _, dim, _ in shared.value}:
            own = [(node, vec) for node, d, vec in shared.value if d == dim]
            points = np.frombuffer(b"".join(v for _, v in own), dtype="<f4").reshape(len(own), dim)
            by_dim[dim] = np.array([node for node, _ in own]), points
        for part in batches:
            rows = []
            for node, dim, vec in zip(*(part.column(c).to_pylist() for c in ("node", "dim", "vec")), strict=True):
                ids, far = np.array([node]), np.zeros(1, "f4")
                if dim in by_dim:
                    entries, points = by_dim[dim]
                    other = entries != node
                    square = _squares(np.frombuffer(vec, "<f4")[None], points)[0]
                    ids = np.concatenate([ids, entries[other]])
                    far = np.concatenate([far, square[other]])
                kept = _kept(ids, far, np.zeros(len(ids), bool), how.width)
                rows.append((node, vec, *kept, ids))
            yield _states(rows)

    return queries.select("node", "dim", "vec").mapInArrow(start, _STATE)


def _moved(width: int, opened: int):
    """The queries of a group after opening their nearest unopened nodes."""

    def move(states: pa.Table, seen_now: pa.Table) -> pa.Table:
        found = seen_now.column("query").to_numpy() if seen_now.num_rows else np.empty(0, "i8")
        order = np.argsort(found, kind="stable")
        found = found[order]
        near = seen_now.column("near").to_numpy()[order] if len(found) else found
        vecs = seen_now.column("vec").to_pylist()
        rows = []
        for node, vec, *lists in zip(*(states.column(c).to_pylist() for c in _STATE_NAMES), strict=True):
            ids, far, done, seen = (np.array(x, t) for x, t in zip(lists, ("i8", "f4", "?", "i8"), strict=True))
            done[np.flatnonzero(~done)[:opened]] = True
            lo, hi = np.searchsorted(found, [node, node + 1])
            if hi > lo:
                new, first = np.unique(near[lo:hi], return_index=True)
                other = ~np.isin(new, seen, assume_unique=True)
                new, at = new[other], order[lo:hi][first[other]]
                if len(new):
                    there = np.frombuffer(b"".join([vecs[i] for i in at]), "<f4").reshape(len(at), -1)
                    square = _squares(np.frombuffer(vec, "<f4")[None], there)[0]
                    ids, far, done = _kept(
                        np.concatenate([ids, new]), np.concatenate([far, square]),
                        np.concatenate([done, np.zeros(len(new), bool)]), width,
                    )
                    seen = np.concatenate([seen, new])
            rows.append((node, vec, ids, far, done, seen))
        return pa.Table.from_batches([_states(rows)])

    return move


def search(graph: Graph, queries: DataFrame, how: Searching | None = None) -> DataFrame:
    """(query, near): for each node of ``queries`` (node, dim, vec), the nodes that its search kept.

    Steps go on until no query has an unopened node among those it keeps; a query that has ended
    takes no further part.
    """
    how = how or Searching()
    moving = stage(_started(queries, graph.sample, how), "states")
    ended = []
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    while True:
        unopened = F.exists("opened", lambda x: ~x)
        ended.append(moving.where(~unopened).select("node", "ids"))
        moving = moving.where(unopened)
        if moving.isEmpty():
            break
        pairs = F.filter(F.arrays_zip("ids", "opened"), lambda x: ~x["opened"])
        front = moving.select(F.col("node").alias("query"), F.slice(pairs, 1, how.opened).alias("open"))
        front = front.select("query", F.explode("open.ids").alias("node"))
        near = front.join(graph.edges, "node").select("query", F.explode("near").alias("near"))
        reached = near.distinct().join(graph.nodes.select(F.col("node").alias("near"), "vec"), "near")
        reached = reached.withColumn("g", F.pmod(F.xxhash64("query"), F.lit(groups)))
        dealt = moving.withColumn("of", F.pmod(F.xxhash64("node"), F.lit(groups)))
        moved = dealt.groupBy("of").cogroup(reached.groupBy("g"))
        moving = stage(moved.applyInArrow(_moved(how.width, how.opened), _STATE), "states")
    out = ended[0]
    for part in ended[1:]:
        out = out.union(part)
    return out.select(F.col("node").alias("query"), F.explode("ids").alias("near"))


def _doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances in double precision."""
    for part in batches:
        a, b = (part.column(c).to_pylist() for c in ("here", "there"))
        score = np.empty(len(a))
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            x, y = np.frombuffer(x, "<f8"), np.frombuffer(y, "<f8")
            gap = x - y
            largest = np.abs(gap).max()
            square = float(gap @ gap)
            if not 1e-200 < square < 1e300 and largest:  # beyond the range of squares
                square, gap = 0.0, gap / largest
                score[i] = largest * np.sqrt(gap @ gap)
            else:
                score[i] = np.sqrt(square)
        yield pa.record_batch([part.column("query"), part.column("near"), pa.array(score)], ["query", "near", "score"])


def nearest(
    vectors: DataFrame,
    wanted: F.Column,
    k: int = 10,
    building: Building | None = None,
    searching: Searching | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where ``wanted``.

    ``vectors`` has (vec_id, embedding). Nearness is the Euclidean distance, in double precision;
    ties go to the smaller vec_id. The search is approximate; recall is measured in the tests.

    - Vectors that are null, empty, zero or hold a null or a non-finite number, and rows without
      vec_id, take no part. Vectors of different lengths are never compared.
    - Equal vectors are one node of the graph; of each only the k + 1 smallest vec_ids can be among
      the k nearest of anything, so a group of copies of any size costs no more than that.
    - Rows that share a vec_id count as one candidate, at the least distance of any of them, and as
      one query, with the nearest rows to any of them; none of its own rows is in its result.
    - A table with k or fewer other vectors gives all of them. An empty table gives no rows. Other
      columns are ignored.
    """
    graph = build(vectors, building)
    asked = graph.copies.where(wanted).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    nodes = graph.nodes
    queries = asked.select(F.col("query").alias("node")).distinct().join(nodes, "node")
    found = stage(search(graph, queries, searching), "found")
    here = nodes.select(F.col("node").alias("query"), F.col("exact").alias("here"))
    there = nodes.select(F.col("node").alias("near"), F.col("exact").alias("there"))
    scored = found.join(there, "near").join(here, "query").select("query", "near", "here", "there")
    scored = scored.mapInArrow(_doubles, "query bigint, near bigint, score double")
    copies = graph.copies.withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    ).where(F.col("place") <= k + 1)
    candidates = scored.join(copies.select(F.col("node").alias("near"), "vec_id"), "near")
    candidates = candidates.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
    # Of a node's candidates the k + 1 best suffice: the query itself is one of them at most.
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    candidates = candidates.withColumn("place", F.row_number().over(best))
    candidates = candidates.where(F.col("place") <= k + 1).select("query", "vec_id", "score")
    pairs = asked.join(candidates, "query").where("vec_id <> query_id")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
