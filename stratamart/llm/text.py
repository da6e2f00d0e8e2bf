"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than the six ASCII white-space bytes 0x20 and 0x09 to 0x0D, which is
the same in UTF-8 as the pattern ``[^\\x20\\x09-\\x0D]+`` over characters. Word hashes come from
prefix sums over the bytes, shingle hashes from sums over word hashes, so no Python object is made
per word. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
#: Bytes of one text hashed at once, cut between words.
PIECE_BYTES = 1 << 19

U64 = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE_BASE = U64(0xD6E8FEB86659FD93)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection of 64-bit values)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1); kept for the next call."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1024), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 2 * PIECE_BYTES:
            _POWERS[int(base)] = known
    return known[:n]


@dataclass(frozen=True)
class Words:
    """Words of a slice of texts: ``hashes[bounds[i]:bounds[i+1]]`` are those of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[first:last] if raw else np.empty(0, np.uint8)
    return data, offsets - first


def give_back() -> None:
    """Return the free memory of this Python worker, which lives on beside later tasks.

    Arrow and the C library keep what was freed; together with other workers' that is more than the
    work needs. Where the C library is another one, its part is left out.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text.

    At the end of a task unused memory goes back, since later tasks use the worker again.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(lo, hi - lo)
    give_back()


def words_of(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, space: np.ndarray = IS_SPACE
) -> Words:
    """Words of texts, hashed; ``lower`` treats A-Z as a-z, ``space`` tells which bytes part words."""
    size = len(data)
    if space is IS_SPACE:
        word = (data != 0x20) & (data - np.uint8(0x09) > 0x0D - 0x09)
    else:
        word = ~space[data]
    inner = offsets[(offsets > 0) & (offsets < size)]
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    edge[inner] = word[inner]
    starts = np.flatnonzero(edge)
    edge = word
    open_end = np.ones(size, dtype=bool)
    open_end[:-1] = ~word[1:]
    open_end[inner - 1] = True
    ends = np.flatnonzero(edge & open_end) + 1
    table = (_BYTE_LOWER if lower else _BYTE).copy()
    table[space] = 0
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, origin + PIECE_BYTES, side="right")))
        length = int(ends[stop - 1] - origin)
        values = np.take(table, data[origin : origin + length])
        values *= powers(_BASE, length)
        first = starts[at:stop] - origin
        # What parts words counts 0, so a sum may go on to the next word.
        np.add.reduceat(values, first, out=hashes[at:stop])
        hashes[at:stop] *= powers(_BASE_INVERSE, length)[first]
        at = stop
    return Words(mix(hashes), starts, ends, np.searchsorted(starts, offsets))


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all lines (pieces between line feeds), and of each text the number of its first."""
    feeds = np.flatnonzero(data == 0x0A) + 1
    texts = offsets[:-1]
    starts = np.concatenate([texts, feeds])
    owner = np.concatenate(
        [np.arange(len(texts)), np.searchsorted(offsets, feeds - 1, side="right") - 1]
    )
    order = np.lexsort((starts, owner))
    return starts[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))


def shingles_of(
    hashes: np.ndarray, bounds: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each run of words, and their bounds.

    A run of fewer words, but at least one, has its whole sequence as its only shingle.
    """
    bounds = np.asarray(bounds, dtype=np.int64)
    lengths = np.diff(bounds)
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(out_bounds[-1]), dtype=np.uint64)
    coefficient = powers(_SHINGLE_BASE, width)
    padded = np.concatenate([hashes, np.zeros(width, dtype=np.uint64)])
    value = np.zeros(len(hashes), dtype=np.uint64)
    for j in range(width):
        value += padded[j : j + len(hashes)] * coefficient[j]
    value += U64(width)
    begin = np.repeat(bounds[:-1] - out_bounds[:-1], counts)
    begin += np.arange(len(out))
    np.take(value, begin, out=out)
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    if len(short):
        length = lengths[short]
        value = length.astype(np.uint64)
        for j in range(width):
            term = padded[bounds[short] + j] * coefficient[j]
            value += np.where(j < length, term, U64(0))
        out[out_bounds[short]] = value
    out[:] = mix(out)
    return out, out_bounds
