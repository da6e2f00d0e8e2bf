"""Packing of tokenised documents into training sequences: sum-of-squares online packing.

Each partition of the table packs its own rows as they come, so nothing is shuffled and a lost task
is simply run again. A level array counts the open sequences by fill. A document goes to the level,
or to a new sequence, for which the sum of squared counts over all levels becomes smallest; this
keeps every fill level in stock, so that later documents find a sequence that they complete.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.text import give_back, slices

#: Bytes of remembered words and their ids per Python worker.
CACHE_BYTES = 100_000_000
_ENTRY_BYTES = 180
#: Bytes of text encoded together: different words are looked up once in them.
ENCODED_BYTES = 1 << 22


def _latin_pattern() -> str:
    """The tokenizer's own splitting pattern, over the characters that ``_NOT_PLAIN`` leaves.

    For Arrow, whose regular expressions take the first alternative that matches, as the tokenizer's.
    """
    letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower())
    numbers = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "N")
    space = r"\t\n\x0b\x0c\r\x20"
    return (
        rf"('s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+)"
    )


#: Characters for which lower-casing and splitting here and in the tokenizer surely agree.
_NOT_PLAIN = r"[^\t\n\x0b\x0c\r\x20-\x7e\x{a1}-\x{12f}\x{131}-\x{24f}]|<\|"
_PIECES = _latin_pattern()
_PROBE = "Abc def's QR-st!! 12,5 don't é Über straße\n ***x1|y2 'll we're"
#: Pieces that are tokenised as one text.
_AT_ONCE = 500


class WordEncoder:
    """Ids of texts by a tokenizer that never joins characters across ASCII white space.

    Such a tokenizer gives the ids of a text as those of its words one after another, so each word
    is tokenised once and remembered; the memory is dropped when it is full. New words of many
    texts are tokenised in one call.

    A tokenizer that lowers letters and then splits words by ``_PIECES`` is recognised by a probe.
    The different words of plain Latin texts are then cut into these pieces here, of which there are
    fewer different ones, and only pieces are remembered. If the tokenizer also marks the last token
    of each piece, new pieces are tokenised as long texts that are cut after those tokens.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        self._size = 0
        self._last = self._last_tokens()
        self._by_piece = True
        whole = self._tokenizer.encode(_PROBE, add_special_tokens=False).ids
        self._by_piece = self.encode([_PROBE.encode()]) == [array("I", whole).tobytes()]
        self.forget()

    def _last_tokens(self) -> np.ndarray | None:
        """Per id whether it ends a piece; None where the tokenizer does not tell."""
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        names = self._tokenizer.get_vocab(with_added_tokens=False)
        last = np.zeros(max(names.values(), default=0) + 1, dtype=bool)
        last[[i for name, i in names.items() if name.endswith(suffix)]] = True
        return last

    def forget(self) -> None:
        """Drop all remembered words."""
        self._known, self._size = {}, 0

    def _learn(self, words: list[str], plain: bool) -> None:
        if plain and self._last is not None:
            rest = []
            runs = [words[i : i + _AT_ONCE] for i in range(0, len(words), _AT_ONCE)]
            joined = [" ".join(run) for run in runs]
            found = self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            for run, encoding in zip(runs, found, strict=True):
                ids = np.asarray(encoding.ids, dtype="<u4")
                ends = np.flatnonzero(self._last[ids]) + 1
                if len(ends) == len(run) and ends[-1] == len(ids):
                    self._keep(run, ids, ends)
                else:
                    rest += run
            words = rest
        if not words:
            return
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [encoding.ids for encoding in found]
        ends = np.cumsum([len(i) for i in ids], dtype=np.int64)
        self._keep(words, np.asarray(list(chain.from_iterable(ids)), dtype="<u4"), ends)

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        packed = ids.tobytes()
        cuts = pairwise([0, *(4 * ends).tolist()])
        self._known.update(zip(words, (packed[a:b] for a, b in cuts), strict=True))
        self._size += sum(map(len, words)) + len(packed) + _ENTRY_BYTES * len(words)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self._size > CACHE_BYTES:
            self.forget()
        decoded = [text.decode("utf-8", "replace") for text in texts]
        column = pa.array(decoded, pa.large_string())
        plain = np.zeros(len(texts), dtype=bool)
        if self._by_piece:
            odd = pc.match_substring_regex(column, _NOT_PLAIN)
            plain = ~odd.to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        for kind in (True, False):
            at = np.flatnonzero(plain == kind)
            if len(at):
                some = column.filter(pa.array(plain == kind))
                some = pc.utf8_lower(some) if kind else some
                for i, ids in zip(at.tolist(), self._encoded(some, kind), strict=True):
                    out[i] = ids
        return out

    def _encoded(self, texts: pa.Array, plain: bool) -> list[bytes]:
        """Ids of texts; their different words are looked up once each."""
        words = pc.ascii_split_whitespace(texts)
        bounds = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        ids, first = self._ids(coded.dictionary, plain)
        ids, ends = _gathered(ids, first, coded.indices.to_numpy())
        cuts = (4 * ends[bounds - bounds[0]]).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in pairwise(cuts)]

    def _ids(self, words: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the bounds of each."""
        if not plain:
            return self._looked_up(words.to_pylist(), plain)
        spaced = pc.replace_substring_regex(words, _PIECES, r"\1 ")
        pieces = pc.ascii_split_whitespace(spaced)
        bounds = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        ids, first = self._looked_up(coded.dictionary.to_pylist(), plain)
        ids, ends = _gathered(ids, first, coded.indices.to_numpy())
        return ids, ends[bounds - bounds[0]]

    def _looked_up(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        known = self._known
        self._learn([word for word in words if word and word not in known], plain)
        found = [known[word] if word else b"" for word in words]
        bounds = np.zeros(len(found) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=bounds[1:])
        return np.frombuffer(b"".join(found), dtype="<u4"), bounds


def _gathered(
    ids: np.ndarray, bounds: np.ndarray, index: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` numbered by ``index`` one after another, and the bounds of each."""
    first = bounds[:-1][index]
    length = np.diff(bounds)[index]
    ends = np.zeros(len(index) + 1, dtype=np.int64)
    np.cumsum(length, out=ends[1:])
    kind = np.int32 if max(ends[-1], len(ids)) < 1 << 31 else np.int64
    place = np.repeat((first - ends[:-1]).astype(kind), length)
    place += np.arange(len(place), dtype=kind)
    return ids[place], ends


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which later tasks of the worker use again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of one document."""

    doc: tuple
    start: int
    length: int
    ids: bytes

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc, self.start, length, self.ids[: 4 * length])
        tail = Piece(self.doc, self.start + length, self.length - length, self.ids[4 * length :])
        return head, tail


@dataclass
class Sequence:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += piece.length


class SumOfSquares:
    """Online packer; ``place`` and ``finish`` return the sequences that are complete."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.levels = np.zeros(capacity, dtype=np.int64)  # open sequences by fill; none at 0
        self.open: dict[int, list[Sequence]] = {}
        self.n_open = 0

    def _level(self, size: int) -> int:
        """The fill to place into: least sum of squares, then the fullest."""
        most = self.capacity - size
        leaving = 1 - 2 * self.levels[: most + 1]
        leaving[0] = 0
        change = leaving
        change[:most] += 2 * self.levels[size:] + 1
        possible = self.levels[: most + 1] > 0
        possible[0] = True
        change = np.where(possible, change, np.iinfo(np.int64).max)
        return most - int(np.argmin(change[::-1]))

    def _take(self, level: int) -> Sequence:
        if level == 0:
            return Sequence()
        self.levels[level] -= 1
        self.n_open -= 1
        found = self.open[level].pop()
        if not self.open[level]:
            del self.open[level]
        return found

    def _keep(self, sequence: Sequence) -> None:
        self.open.setdefault(sequence.fill, []).append(sequence)
        self.levels[sequence.fill] += 1
        self.n_open += 1

    def place(self, piece: Piece) -> Iterator[Sequence]:
        while piece.length >= self.capacity:
            head, piece = piece.cut(self.capacity)
            yield Sequence([head], self.capacity)
        if not piece.length:
            return
        sequence = self._take(self._level(piece.length))
        sequence.put(piece)
        if sequence.fill == self.capacity:
            yield sequence
        else:
            self._keep(sequence)

    def _complete(self) -> Iterator[Sequence]:
        """Fill the fullest open sequences with cuts of the emptiest until one is left."""
        waiting = [s for level in sorted(self.open, reverse=True) for s in self.open[level]]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        while len(waiting) > 1:
            target = waiting.pop(0)
            while target.fill < self.capacity and waiting:
                donor = waiting[-1]
                piece = donor.pieces.pop()
                donor.fill -= piece.length
                gap = self.capacity - target.fill
                if piece.length > gap:
                    piece, rest = piece.cut(gap)
                    donor.put(rest)
                target.put(piece)
                if not donor.pieces:
                    waiting.pop()
            if target.fill == self.capacity:
                yield target
            else:
                waiting.append(target)
                break
        for sequence in waiting:
            self._keep(sequence)

    def finish(self) -> Iterator[Sequence]:
        """Complete what is open; the last remainder becomes sequences of powers of two."""
        yield from self._complete()
        rest = [s for group in self.open.values() for s in group]
        for sequence in rest:
            pieces = sequence.pieces[::-1]
            left = sequence.fill
            while left:
                out = Sequence()
                size = 1 << (left.bit_length() - 1)
                while out.fill < size:
                    piece = pieces.pop()
                    if piece.length > size - out.fill:
                        piece, tail = piece.cut(size - out.fill)
                        pieces.append(tail)
                    out.put(piece)
                left -= size
                yield out


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    keep_words: bool = True,
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    A document's ids are those of its text without special tokens, then ``end_id``. A document of
    ``capacity`` ids or more is cut into full sequences and a remainder; remainders are packed
    whole, and cut only to complete the sequences that are open when the partition ends. Each
    sequence has ``capacity`` ids, or else a power of two, so that none is padded. Every id lies in
    exactly one piece. ``ids`` holds little-endian unsigned 32-bit integers; ``offset`` is the
    place of the piece in its sequence, without gaps from 0.

    ``tokenizer_file`` must be a tokenizer of the `tokenizers` library that does not join characters
    across ASCII white space and gives none for it, and must exist on every worker. Later tasks of a
    Python worker use the words it remembers; without ``keep_words`` each task drops its own, where
    other steps need the memory of the same workers.

    - A null or empty text is a document of the one id ``end_id``.
    - A null doc_id is packed like any other. Repeated rows are packed as often as they occur.
    - Columns other than doc_id and text are ignored. An empty table gives no rows.
    - A text is tokenised as a whole, with some others. The ids of sequences that are still open are
      in memory, which is less than the ids of the partition; no number of open sequences ends them.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(capacity)
        encode = encoder(tokenizer_file).encode
        end = np.asarray([end_id], dtype="<u4").tobytes()
        sequence_id = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def write(sequences: Iterator[Sequence]) -> None:
            nonlocal sequence_id
            for sequence in sequences:
                offset = 0
                for p in sequence.pieces:
                    out.append((p.doc[0], p.start, p.length, p.ids, p.doc[1], sequence_id, offset))
                    offset += p.length
                sequence_id += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES
            )

        for part in slices(batches, most=ENCODED_BYTES):
            ids = part.column("doc_id").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for doc_id, tokens in zip(ids, encode(texts), strict=True):
                tokens += end
                n = len(tokens) // 4
                write(packer.place(Piece((doc_id, n), 0, n, tokens)))
                if len(out) >= 1000:
                    yield batch()
        if not keep_words:
            encoder(tokenizer_file).forget()
        write(packer.finish())
        if out:
            yield batch()
        give_back()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    return docs.mapInArrow(rows, schema + "sequence_id bigint, offset bigint")


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
