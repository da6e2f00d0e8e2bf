"""Fixed-size count sketches over a whole table: built per task, merged in two steps.

A sketch is one row of counters indexed by the low bits of a 64-bit hash. A counter never
underestimates how often its hashes occur. The size is a parameter and does not grow with the data;
beyond its load a sketch says "often" too often, which costs work and never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stratamart.llm.text import give_back

#: Counters of one merged row: small enough for many to meet in one task.
BLOCK = 1 << 16
BIT_BLOCK = 1 << 18
#: Tasks whose blocks meet in the first merge step.
FAN_IN = 64
_PARTS = "block int, part int, cells binary"
_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("cells", pa.binary())])

Hashes = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def add(counters: np.ndarray, hashes: np.ndarray) -> None:
    """Count the hashes, saturating at the largest value of the counters."""
    most = np.iinfo(counters.dtype).max
    cells, times = _repeats(hashes, len(counters))
    total = counters[cells].astype(np.int64) + times
    counters[cells] = np.minimum(total, most).astype(counters.dtype)


def _starts(ascending: np.ndarray) -> np.ndarray:
    """Where each value of ascending ones begins."""
    new = np.ones(len(ascending), dtype=bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return np.flatnonzero(new)


def _repeats(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different cells of a sketch of ``width`` cells, ascending, and how often each occurs."""
    cells = hashes & np.uint64(width - 1)
    cells = np.sort(cells.astype(np.uint32) if width <= 1 << 32 else cells)
    first = _starts(cells)
    return cells[first], np.diff(np.append(first, len(cells)))


def _packed(cells: np.ndarray) -> bytes:
    return pa.compress(cells.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, dtype: str, size: int) -> np.ndarray:
    """``size`` cells."""
    size *= np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(packed, size, codec="zstd"), dtype=dtype)


def _blocks(counters: np.ndarray) -> pa.RecordBatch:
    part = TaskContext.get().partitionId() // FAN_IN
    rows = counters.reshape(-1, min(BLOCK, len(counters)))
    used = np.flatnonzero(rows.any(axis=1))
    cells = [_packed(rows[i]) for i in used]
    return pa.record_batch([used.astype(np.int32), np.full(len(used), part, np.int32), cells], _ARROW)


def _merged(group: pa.Table, counters: np.ndarray) -> pa.Table:
    columns = [group.column("block").slice(0, 1), pa.array([0], pa.int32())]
    columns.append(pa.array([_packed(counters)], pa.binary()))
    return pa.table(columns, schema=_ARROW)


def _merge(dtype: str, size: int, group: pa.Table) -> np.ndarray:
    total = None
    most = np.iinfo(dtype).max
    wider = np.uint16 if dtype == "uint8" else np.int64
    for packed in group.column("cells"):
        cells = _unpacked(packed.as_py(), dtype, size).astype(wider)
        total = cells if total is None else np.minimum(total + cells, most)
    return total.astype(dtype)


def merged_counts(
    df: DataFrame, hashes: Hashes, width: int, dtype: str = "uint8", least: int | None = None
) -> np.ndarray:
    """Counters over all hashes that ``hashes`` draws from the table.

    ``width``, a power of two, bounds what a task, a merge and the driver hold. With ``least`` there
    is one bit per counter instead (for ``has_bit``), which tells whether it has reached that.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(width, dtype=dtype)
        waiting: list[np.ndarray] = []
        for found in hashes(batches):
            waiting.append(found)
            if sum(map(len, waiting)) > 1 << 20:
                add(counters, np.concatenate(waiting))
                waiting.clear()
        if waiting:
            add(counters, np.concatenate(waiting))
            waiting.clear()
        packed = _blocks(counters)
        del counters
        give_back()
        yield packed

    def merge(group: pa.Table) -> pa.Table:
        return _merged(group, _merge(dtype, min(BLOCK, width), group))

    def last(group: pa.Table) -> pa.Table:
        cells = _merge(dtype, min(BLOCK, width), group)
        return _merged(group, cells if least is None else np.packbits(cells >= least, bitorder="little"))

    parts = df.mapInArrow(count, _PARTS)
    once = parts.groupBy("block", "part").applyInArrow(merge, _PARTS)
    twice = once.groupBy("block").applyInArrow(last, _PARTS)
    size, kind = (min(BLOCK, width), dtype) if least is None else (min(BLOCK, width) // 8, "uint8")
    out = np.zeros((max(1, width // BLOCK), size), dtype=kind)
    for row in twice.collect():  # at most width counters
        out[row["block"]] = _unpacked(row["cells"], kind, size)
    return out.reshape(-1)


def _set(bits: np.ndarray, cells: np.ndarray) -> None:
    """Set the bits of ascending cells."""
    if len(cells):
        place = (cells >> cells.dtype.type(3)).astype(np.int64)
        first = _starts(place)
        value = np.left_shift(1, (cells & cells.dtype.type(7)).astype(np.uint8), dtype=np.uint8)
        bits[place[first]] |= np.bitwise_or.reduceat(value, first)


def _see(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    cells, times = _repeats(hashes, 8 * len(once))
    _set(twice, cells[(times > 1) | has_bit(once, cells)])
    _set(once, cells)


def _merge_bits(size: int, group: pa.Table) -> np.ndarray:
    """Both halves of the packed blocks: seen at all, seen twice or more."""
    once = twice = None
    for packed in group.column("cells").to_pylist():
        first, second = _unpacked(packed, "uint8", 2 * size).reshape(2, -1)
        if once is None:
            once, twice = first.copy(), second.copy()
        else:
            twice |= second | (once & first)
            once |= first
    return np.stack([once, twice])


def merged_bits(df: DataFrame, hashes: Hashes, width: int, least: int = 1) -> np.ndarray:
    """One bit per counter, for counters that only tell never, once and more often.

    The bit is set where the hashes reach ``least``, which is 1 or 2. ``width`` as above, in bits.
    """
    block = min(BIT_BLOCK, width) // 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(width // 8, np.uint8), np.zeros(width // 8, np.uint8)
        waiting: list[np.ndarray] = []
        for found in hashes(batches):
            waiting.append(found)
            if sum(map(len, waiting)) > 1 << 20:
                _see(once, twice, np.concatenate(waiting))
                waiting.clear()
        if waiting:
            _see(once, twice, np.concatenate(waiting))
            waiting.clear()
        part = TaskContext.get().partitionId() // FAN_IN
        rows, more = once.reshape(-1, block), twice.reshape(-1, block)
        used = np.flatnonzero(rows.any(axis=1))
        cells = [_packed(np.stack([rows[i], more[i]])) for i in used]
        parts = np.full(len(used), part, np.int32)
        del once, twice, rows, more
        give_back()
        yield pa.record_batch([used.astype(np.int32), parts, cells], _ARROW)

    def merge(group: pa.Table) -> pa.Table:
        return _merged(group, _merge_bits(block, group))

    parts = df.mapInArrow(count, _PARTS)
    once = parts.groupBy("block", "part").applyInArrow(merge, _PARTS)
    twice = once.groupBy("block").applyInArrow(merge, _PARTS)
    out = np.zeros((width // 8 // block, block), dtype=np.uint8)
    for row in twice.collect():  # at most width bits
        both = _unpacked(row["cells"], "uint8", 2 * block).reshape(2, -1)
        out[row["block"]] = both[least - 1]
    return out.reshape(-1)


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    kind = hashes.dtype.type
    cell = hashes & kind(len(bits) * 8 - 1)
    return (bits[cell >> kind(3)] >> (cell & kind(7)).astype(np.uint8)) & 1 == 1


def two_cells(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The counters of a sketch of two rows, ``width`` wide together, by independent bits."""
    half = np.uint64(width // 2 - 1)
    return hashes & half, ((hashes >> np.uint64(32)) & half) | np.uint64(width // 2)


def in_both(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Are the bits of both rows set?"""
    one, two = two_cells(hashes, 8 * len(bits))
    return has_bit(bits, one) & has_bit(bits, two)


def width_for(n: int, least: int = 1 << 16, most: int = 1 << 28) -> int:
    """A power of two of about eight bits per item, within fixed limits."""
    return int(min(most, max(least, 1 << int(8 * max(n, 1) - 1).bit_length())))
