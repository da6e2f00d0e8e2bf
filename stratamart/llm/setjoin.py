"""What exact set-similarity joins over word shingles share.

The sets are those of whole texts or of their lines. A token is a shingle: its hash below the
logarithm of its estimated frequency, so that sorting tokens as numbers orders every set from rare
to frequent by one order for the whole corpus. Any such order makes the filters below exact; the
estimate, from a sketch of fixed size over all shingles, only decides how much they leave over.

Two sets of sizes m and n that reach the similarity share at least ``overlap(n)`` tokens of n. So
they share at least k tokens among the first ``n - overlap(n) + k`` of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm import counts
from stratamart.llm.staging import release, stage
from stratamart.llm.text import (
    U64,
    give_back,
    lines_of,
    mix,
    shingles_of,
    slices,
    text_bytes,
    words_of,
)

#: Counters of the frequency sketch.
RARITY_WIDTH = 1 << 22


@dataclass(frozen=True)
class SetSpec:
    """Which sets: of whole texts or of lines, how many words a shingle has, the similarity."""

    by_line: bool = False
    shingle_words: int = 5
    percent: int = 80

    @property
    def ids(self) -> list[str]:
        return ["doc_id", "rh", "line_no"] if self.by_line else ["doc_id"]

    @property
    def parity(self) -> list[str]:
        """The columns of the parity signature: 64 bits each."""
        return [f"s{i}" for i in range(4 if self.by_line else 8)]


@dataclass(frozen=True)
class SetBatch:
    """Sets of some rows: tokens of set i are ``tokens[bounds[i]:bounds[i+1]]``, ascending."""

    ids: list[np.ndarray]
    tokens: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def set_input(docs: DataFrame, spec: SetSpec) -> DataFrame:
    """The columns read; rows of one doc_id with different texts stay apart where lines count."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    docs = docs.where("doc_id is not null")
    return docs.withColumn("rh", F.xxhash64("text")) if spec.by_line else docs


def overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that a set of n must share at least: the smallest integer >= percent% of n."""
    return (n * percent + 99) // 100


def similar(shared: np.ndarray, m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (m + n - shared)


def long_column(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts of all lines of a slice, their rows and their numbers."""
    starts, first = lines_of(data, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return starts, rows, np.arange(len(starts)) - first[rows]


def _shingles(part: pa.RecordBatch, spec: SetSpec) -> tuple[np.ndarray, ...]:
    """Shingle hashes and bounds of all sets of a slice, with their rows and line numbers.

    Rows that have a line number are lines already.
    """
    data, offsets = text_bytes(part.column("text"))
    words = words_of(data, offsets, lower=True)
    if spec.by_line and "line_no" not in part.schema.names:
        starts, rows, number = _numbered_lines(data, offsets)
        bounds = np.append(np.searchsorted(words.starts, starts), len(words.starts))
    else:
        bounds, rows = words.bounds, np.arange(part.num_rows)
        number = long_column(part, "line_no") if spec.by_line else np.zeros_like(rows)
    return (*shingles_of(words.hashes, bounds, spec.shingle_words), rows, number)


def _lines_among(
    batches: Iterator[pa.RecordBatch], present: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The lines whose ids a bit table has, as rows of their own; those of other lines are not hashed."""
    for part in slices(batches):
        data, offsets = text_bytes(part.column("text"))
        starts, rows, number = _numbered_lines(data, offsets)
        ids = [long_column(part, "doc_id")[rows], long_column(part, "rh")[rows], number]
        found = np.flatnonzero(counts.in_both(present, _node_hash(ids)))
        # A line goes on to the next one's start; the line feed belongs to no word.
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        buffers = [None, bounds, pa.py_buffer(data)]
        lines = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
        columns = [*(c[found] for c in ids), lines.take(pa.array(found))]
        yield pa.record_batch([pa.array(c) for c in columns], ["doc_id", "rh", "line_no", "text"])


def frequency_levels(docs: DataFrame, spec: SetSpec) -> np.ndarray:
    """Per counter the logarithm of how many shingles of the corpus fall on it."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in slices(batches):
            yield _shingles(part, spec)[0]

    total = counts.merged_counts(docs, hashes, RARITY_WIDTH, "uint32")
    return np.ceil(np.log2(total.astype(np.float64) + 1)).astype(np.uint8)


def sets_of(
    batches: Iterator[pa.RecordBatch], spec: SetSpec, levels: np.ndarray
) -> Iterator[SetBatch]:
    for part in slices(batches):
        hashes, bounds, rows, number = _shingles(part, spec)
        level = levels[hashes & U64(len(levels) - 1)].astype(np.uint64)
        keys = (level << U64(56)) | (hashes >> U64(8))
        keys = _sorted_runs(keys, bounds)
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        if not first.all():
            bounds = np.append(0, np.cumsum(first))[bounds]
            keys = keys[first]
        ids = [long_column(part, "doc_id")[rows]]
        if spec.by_line:
            ids += [long_column(part, "rh")[rows], number.astype(np.int64)]
        yield SetBatch(ids, keys, bounds)


def _sorted_runs(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Every run ascending. Runs of one length are the rows of a matrix, sorted at once."""
    lengths = np.diff(bounds)
    runs = np.argsort(lengths, kind="stable")
    ordered = lengths[runs]
    ends = np.cumsum(ordered)
    place = np.arange(len(values))
    place += np.repeat(bounds[runs] - (ends - ordered), ordered)
    by_length = values[place]
    cuts = np.flatnonzero(np.diff(ordered, append=-1))
    at = 0
    for length, end in zip(ordered[cuts].tolist(), ends[cuts].tolist(), strict=True):
        if length > 1:
            by_length[at:end].reshape(-1, length).sort(axis=1)
        at = end
    out = np.empty_like(values)
    out[place] = by_length
    return out


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of 64-bit values as one binary value each."""
    offsets = pa.py_buffer((bounds * 8).astype(np.int64).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    wide = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, data])
    return wide.cast(pa.binary())


def binary_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of ``binary_column``."""
    data, offsets = text_bytes(column)
    return np.frombuffer(data.tobytes(), dtype=np.uint64), offsets // 8


def heads_of_runs(values: np.ndarray, bounds: np.ndarray, most: np.ndarray) -> tuple:
    """The first ``most[i]`` values of each run, and their bounds."""
    sizes = np.diff(bounds)
    place = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
    keep = place < np.repeat(most, sizes)
    return values[keep], np.concatenate([[0], np.cumsum(np.minimum(sizes, most))])


def _digest(batch: SetBatch, salt: int) -> np.ndarray:
    total = np.zeros(len(batch.tokens) + 1, dtype=np.uint64)
    np.cumsum(mix(batch.tokens ^ U64(salt)), out=total[1:])
    return (total[batch.bounds[1:]] - total[batch.bounds[:-1]]).view(np.int64)


def _parity(batch: SetBatch, words: int) -> list[np.ndarray]:
    """Per set, for each of 64 * words bits, whether it has an odd number of tokens there."""
    bits = 64 * words
    owner = np.repeat(np.arange(len(batch.sizes)), batch.sizes)
    cell = owner * bits + (mix(batch.tokens) & U64(bits - 1)).astype(np.int64)
    odd = np.bincount(cell, minlength=len(batch.sizes) * bits) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1)
    return list(np.ascontiguousarray(packed).view(np.int64).T)


def _wide_parity(batch: SetBatch) -> pa.Array:
    """Parity signatures of as many bits as a set has tokens, rounded up to a power of two."""
    bits = np.exp2(np.ceil(np.log2(np.maximum(batch.sizes, 64)))).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(bits)), batch.sizes)
    cell = bounds[owner] + (mix(batch.tokens) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(cell, minlength=int(bounds[-1])) & 1
    return binary_column(np.packbits(odd.astype(np.uint8)).view(np.uint64), bounds // 64)


def signatures(
    docs: DataFrame,
    spec: SetSpec,
    levels: np.ndarray,
    pair_prefix_up_to: int = 0,
    wide: bool = False,
) -> DataFrame:
    """One row per set: ids, size ``n``, a 128-bit digest of the set, the tokens of its prefix.

    The prefix is the one that shares a token with every similar set, or two tokens for sets of
    at most ``pair_prefix_up_to`` tokens. ``cost`` estimates the lists that scanning it would read.
    The parity signature bounds how many tokens of two sets differ. ``wide`` adds one whose size
    follows that of the set, for ``plausible``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(levels)
    names = [*spec.ids, "n", "d1", "d2", "cost", "prefix", *spec.parity]
    kinds = ["bigint"] * len(spec.ids) + ["int", "bigint", "bigint", "double", "binary"]
    kinds += ["bigint"] * len(spec.parity)
    if wide:
        names.append("wide")
        kinds.append("binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in sets_of(batches, spec, shared.value):
            n = sets.sizes
            single = n - overlap(n, spec.percent) + 1
            most = np.where(n <= pair_prefix_up_to, single + 1, single)
            prefix, bounds = heads_of_runs(sets.tokens, sets.bounds, np.minimum(most, n))
            scan = np.concatenate([[0.0], np.cumsum(np.exp2((prefix >> U64(56)).astype(float)))])
            columns = [
                *sets.ids,
                n.astype(np.int32),
                _digest(sets, 0x5BF03635),
                _digest(sets, 0x1F83D9AB),
                scan[bounds[1:]] - scan[bounds[:-1]],
                binary_column(prefix, bounds),
                *_parity(sets, len(spec.parity)),
            ]
            if wide:
                columns.append(_wide_parity(sets))
            yield pa.record_batch([pa.array(c) for c in columns], names)

    schema = ", ".join(f"{a} {b}" for a, b in zip(names, kinds, strict=True))
    return docs.mapInArrow(rows, schema)


def _set_hash(part: pa.RecordBatch) -> np.ndarray:
    return long_column(part, "d1").view(np.uint64)


def repeated_sets(signed: DataFrame, rows: int) -> np.ndarray:
    """A bit table of fixed size that tells sets which several rows have, and few others."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in batches:
            yield np.concatenate(counts.two_cells(_set_hash(part), width))

    width = counts.width_for(2 * rows)
    return counts.merged_bits(signed.select("d1"), hashes, width, least=2)


def with_repeated_set(signed: DataFrame, shared_sets: np.ndarray) -> DataFrame:
    """The rows whose set several rows have, by the bits of ``repeated_sets``, and few others."""
    shared = signed.sparkSession.sparkContext.broadcast(shared_sets)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.filter(pa.array(counts.in_both(shared.value, _set_hash(part))))

    return signed.mapInArrow(chosen, signed.schema)


@dataclass(frozen=True)
class ListKeys:
    """List keys of a set: single tokens of the prefix, or pairs of them for small sets.

    Sets of at most ``light`` tokens are found by pairs. Two similar sets of which one is larger
    meet in the lists of single tokens, so small sets near the boundary are in both. So are, at 50
    percent or less, the smallest sets, since they may share one token only with a similar one.
    """

    percent: int
    light: int = 0

    def of(self, prefix: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, the row of each, and the place of its (first) token in the order of the set."""
        tokens, bounds = binary_runs(prefix)
        single = np.minimum(n - overlap(n, self.percent) + 1, np.diff(bounds))
        listed = n >= overlap(np.asarray(self.light + 1), self.percent)
        if overlap(np.asarray(2), self.percent) < 2:
            listed |= overlap(n, self.percent) < 2
        most = np.where(listed, single, 0)
        keys, where = heads_of_runs(tokens, bounds, most)
        row = np.repeat(np.arange(len(n)), np.diff(where))
        place = np.arange(len(keys)) - where[row]
        out = [(mix(keys), row, place)]
        small = (n <= self.light) & (n >= 2)
        for width in np.unique(np.diff(bounds)[small]):
            rows = np.flatnonzero(small & (np.diff(bounds) == width))
            block = tokens[bounds[rows][:, None] + np.arange(width)]
            i, j = np.triu_indices(width, 1)
            pair = mix(mix(block[:, i]) * U64(3) + block[:, j])
            out.append((pair.ravel(), np.repeat(rows, len(i)), np.tile(i, len(rows))))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def postings(
    signed: DataFrame,
    spec: SetSpec,
    keys: ListKeys,
    only: DataFrame,
    carry: tuple[str, ...] = (),
    shared_sets: np.ndarray | None = None,
) -> DataFrame:
    """(key, ids, n, place, carried columns) of keys that several rows may have.

    Of the rows whose ids are in ``only``, and of few others: a bit table tells them. With the bits
    ``shared_sets`` of ``repeated_sets`` also of all rows whose set is no other row's. A sketch over all their keys
    tells those that only one row has; they link with nothing and are left out before the shuffle.
    It never overlooks a repeated key.
    """
    wanted = signed.sparkSession.sparkContext.broadcast(_bits_of(only, spec.ids))
    total = int(signed.agg(F.coalesce(F.sum(F.length("prefix")), F.lit(0))).first()[0]) // 8
    shared = signed.sparkSession.sparkContext.broadcast(shared_sets)
    digest = [] if shared_sets is None else ["d1"]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hashes = _node_hash([long_column(part, c) for c in spec.ids])
            found = counts.in_both(wanted.value, hashes)
            if digest:
                found |= ~counts.in_both(shared.value, _set_hash(part))
            yield part.filter(pa.array(found))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in chosen(batches):
            found = keys.of(part.column("prefix"), long_column(part, "n"))[0]
            yield np.concatenate(counts.two_cells(found, width))

    width = counts.width_for(total)
    listed = signed.select(*spec.ids, *digest, "n", "prefix")
    bits = counts.merged_bits(listed, hashes, width, least=2)
    repeated = signed.sparkSession.sparkContext.broadcast(bits)
    names = ["key", *spec.ids, "n", "place", *carry]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chosen(batches):
            n = long_column(part, "n")
            key, row, place = keys.of(part.column("prefix"), n)
            kept = counts.in_both(repeated.value, key)
            key, row, place = key[kept], row[kept], place[kept]
            columns = [key.view(np.int64), *(long_column(part, c)[row] for c in spec.ids)]
            columns += [n[row].astype(np.int32), place.astype(np.int32)]
            columns += [long_column(part, c)[row] for c in carry]
            yield pa.record_batch([pa.array(c) for c in columns], names)
        give_back()

    kinds = ["bigint"] * (1 + len(spec.ids)) + ["int", "int"] + ["bigint"] * len(carry)
    schema = ", ".join(f"{a} {b}" for a, b in zip(names, kinds, strict=True))
    return signed.select(*spec.ids, *digest, "n", "prefix", *carry).mapInArrow(rows, schema)


def as_side(df: DataFrame, side: str, ids: list[str]) -> DataFrame:
    """The id columns renamed for one side of a pair."""
    return df.withColumnsRenamed({c: f"{side}_{c}" for c in ids})


def node(side: str, ids: list[str]) -> Column:
    return F.struct(*[F.col(f"{side}_{c}").alias(c) for c in ids])


def may_be_similar(percent: int) -> Column:
    """Length and positional filters of a pair that shares the list key at the given places."""
    m, n = F.col("a_n"), F.col("b_n")
    before = F.least("a_place", "b_place")
    after = F.least(m - F.col("a_place"), n - F.col("b_place"))
    most = before + after
    return (
        (100 * F.least(m, n) >= percent * F.greatest(m, n))
        & (100 * most >= percent * (m + n - most))
    )


def signatures_allow(percent: int, parity: list[str]) -> Column:
    """Parity filter of a pair: a bit that differs stands for a token that only one of them has.

    A null signature allows everything.
    """
    total = F.col("a_n") + F.col("b_n")
    differ = sum((F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in parity), F.lit(0))
    twice_shared = total - differ
    allowed = 100 * twice_shared >= percent * (2 * total - twice_shared)
    return F.coalesce(allowed, F.lit(True))


def _differ(one: np.ndarray, other: np.ndarray) -> int:
    """Bits in which two wide parity signatures differ, the longer one folded to the shorter."""
    while len(one) != len(other):
        if len(one) < len(other):
            one, other = other, one
        half = len(one) // 2
        one = one[:half] ^ one[half:]
    return int(np.bitwise_count(one ^ other).sum())


def rows_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows with a doc_id of ``wanted`` and few others, found by a bit table without a shuffle."""
    present = rows.sparkSession.sparkContext.broadcast(_bits_of(wanted, ["doc_id"]))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = counts.in_both(present.value, _node_hash([long_column(part, "doc_id")]))
            if found.any():
                yield part.filter(pa.array(found))

    return rows.mapInArrow(chosen, rows.schema)


def plausible(signed: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a_doc_id, b_doc_id) that the wide parity signatures allow; a staged table.

    A signature has an eighth of a byte per token, so most pairs that are not similar are left out
    before whole sets are read. No similar pair is. Where rows of one doc_id have different texts,
    any two of the rows may allow the pair.
    """
    wanted = pairs.select(F.explode(F.array("a_doc_id", "b_doc_id")).alias("doc_id")).distinct()
    wanted = stage(wanted, "asked")
    held = rows_of(signed.select("doc_id", "n", "wide"), wanted)
    held = stage(held.join(wanted, "doc_id", "left_semi"), "wide")
    names = ["doc_id", "n", "wide"]
    both = pairs.join(as_side(held, "a", names), "a_doc_id")
    both = both.join(as_side(held, "b", names), "b_doc_id")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            left, lo = binary_runs(part.column("a_wide"))
            right, ro = binary_runs(part.column("b_wide"))
            total = long_column(part, "a_n") + long_column(part, "b_n")
            differ = np.zeros(part.num_rows, dtype=np.int64)
            for i in range(part.num_rows):
                differ[i] = _differ(left[lo[i] : lo[i + 1]], right[ro[i] : ro[i + 1]])
            good = 100 * (total - differ) >= percent * (total + differ)
            yield part.select(["a_doc_id", "b_doc_id"]).filter(pa.array(good))
        give_back()

    both = both.select("a_doc_id", "b_doc_id", "a_n", "b_n", "a_wide", "b_wide")
    found = both.mapInArrow(check, "a_doc_id bigint, b_doc_id bigint")
    found = stage(found.distinct(), "plausible")
    release(held, wanted)
    return found


def _node_hash(ids: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(ids[0]), dtype=np.uint64)
    for column in ids:
        out = mix(out * U64(3) + column.astype(np.int64).view(np.uint64))
    return out


def _bits_of(rows: DataFrame, ids: list[str]) -> np.ndarray:
    """A bit table of fixed size over the ids of rows: two bits each, for ``counts.in_both``."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in batches:
            cells = counts.two_cells(_node_hash([long_column(part, c) for c in ids]), width)
            yield np.concatenate(cells)

    rows = rows.select(*ids)
    width = counts.width_for(2 * rows.count())
    return counts.merged_bits(rows, hashes, width)


def verified(
    docs: DataFrame, spec: SetSpec, levels: np.ndarray, pairs: DataFrame
) -> DataFrame:
    """The pairs (a_*, b_*) whose sets are similar, as a staged table.

    Sets are computed again from the texts, of rows that stand in a pair; a bit table of fixed
    size keeps nearly all others from being shuffled.
    """
    spark = docs.sparkSession
    ids = spec.ids
    a, b = [f"a_{c}" for c in ids], [f"b_{c}" for c in ids]
    wanted = pairs.select(*a).toDF(*ids).union(pairs.select(*b).toDF(*ids)).distinct()
    wanted = stage(wanted, "wanted")
    present = spark.sparkContext.broadcast(_bits_of(wanted, ids))
    present_docs = present
    if spec.by_line:
        present_docs = spark.sparkContext.broadcast(_bits_of(wanted, ["doc_id"]))
    shared = spark.sparkContext.broadcast(levels)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hashes = _node_hash([long_column(part, "doc_id")])
            yield part.filter(pa.array(counts.in_both(present_docs.value, hashes)))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = chosen(batches)
        if spec.by_line:
            texts = _lines_among(texts, present.value)
        for found in sets_of(texts, spec, shared.value):
            rows = np.flatnonzero(counts.in_both(present.value, _node_hash(found.ids)))
            keep = np.zeros(len(found.sizes), dtype=np.int64)
            keep[rows] = found.sizes[rows]
            tokens, bounds = heads_of_runs(found.tokens, found.bounds, keep)
            at = np.append(bounds[rows], len(tokens))
            columns = [*(c[rows] for c in found.ids), binary_column(tokens, at)]
            yield pa.record_batch([pa.array(c) for c in columns], [*ids, "tokens"])

    schema = ", ".join(f"{c} bigint" for c in ids) + ", tokens binary"
    tokens = stage(docs.mapInArrow(sets, schema).join(wanted, ids, "left_semi"), "sets")
    left = as_side(tokens, "a", ids).withColumnRenamed("tokens", "a_tokens")
    right = as_side(tokens, "b", ids).withColumnRenamed("tokens", "b_tokens")
    both = pairs.select(*a, *b).join(left, a).join(right, b)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            left, lo = binary_runs(part.column("a_tokens"))
            right, ro = binary_runs(part.column("b_tokens"))
            good = np.zeros(part.num_rows, dtype=bool)
            for i in range(part.num_rows):
                x, y = left[lo[i] : lo[i + 1]], right[ro[i] : ro[i + 1]]
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int(np.count_nonzero(merged[1:] == merged[:-1]))
                good[i] = similar(shared, len(x), len(y), spec.percent)
            yield part.select([*a, *b]).filter(pa.array(good))
        give_back()

    found = both.select(*a, *b, "a_tokens", "b_tokens").mapInArrow(
        check, ", ".join(f"{c} bigint" for c in [*a, *b])
    )
    found = stage(found.distinct(), "verified")
    release(tokens, wanted)
    return found


def size_band(n: str = "n") -> Column:
    """Sets of one band differ in size by a quarter at most."""
    return F.floor(F.log(F.col(n)) / F.log(F.lit(1.25))).cast("int")
