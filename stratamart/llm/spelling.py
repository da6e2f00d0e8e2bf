"""Grouping of spelling variants: pairs of words one error apart, by search in a bidirectional FM-index.

Two words one error apart agree in a whole half: with the word cut in two, the error lies in one of
the halves and the other one is met unchanged. So there are two searches per word. One matches the
first half and the delimiter before it exactly and extends to the right over the second half with
one error; the other matches the second half with the delimiter after it and extends to the left
over the first. A state of a search is an interval of suffix ranks in the vocabulary and one in the
mirrored vocabulary, which stand for the same occurrences; a step in either direction keeps both.

The vocabulary is dealt out by halves: a word is listed under all halves by which a word of nearly
its length may look for it, and words with equal halves share an index. A half that too many words
share is split into several indexes, each of which its searches visit.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.staging import release, stage

#: Words of one index at most, and searches that visit it at once.
INDEX_WORDS = 8192
SEARCHES = 1 << 16
#: Words counted in memory before they are handed on.
COUNTED = 300_000
#: A run whose checksum this divides loses a character.
DAMAGED = 199


def _letters() -> bytes:
    """Latin-1 bytes: A-Z lower-cased, other letters as they are, everything else a space."""
    table = bytearray(b" " * 256)
    for code in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]:
        table[code] = code + 32 if code < 0x5B else code
    return bytes(table)


_LETTERS = _letters()


def _runs(text: str) -> list[bytes]:
    """Runs of letters in Latin-1; characters beyond it become question marks, which are none."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _damaged(doc_id: int | None, counted: Counter, least: int, out: dict[bytes, int]) -> None:
    start = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
    for run, n in counted.items():
        if start is not None:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % DAMAGED == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
        if len(run) >= least:
            out[run] = out.get(run, 0) + n


def _counted(least: int):
    """Words and their occurrences, combined in each task."""

    def rows(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.record_batch([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[bytes, int] = {}
        for part in batches:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                text = text.as_py()
                if text:
                    _damaged(doc_id, Counter(_runs(text)), least, out)
                if len(out) > COUNTED:
                    yield rows(out)
                    out = {}
        yield rows(out)

    return count


@dataclass(frozen=True)
class OneWay:
    """Counts of each character before each rank of the suffixes, and where its suffixes start."""

    before: np.ndarray
    first: np.ndarray


def suffix_ranks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all rotations of the text, by doubling the compared length; and each one's rank."""
    n = len(text)
    rank = text.astype(np.int64)
    step = 1
    while True:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        values, rank = np.unique(pair, return_inverse=True)
        if len(values) == n or step >= n:
            break
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, rank


def _one_way(text: np.ndarray, order: np.ndarray, size: int) -> OneWay:
    last = text[order - 1]
    before = np.zeros((len(text) + 1, size), dtype=np.int32)
    before[np.arange(1, len(text) + 1), last] = 1
    np.cumsum(before, axis=0, out=before)
    total = before[-1]
    return OneWay(before, np.cumsum(total) - total)


class Bidirectional:
    """FM-index over different words, each after a delimiter, and over their mirror image.

    Characters are numbered in order, the delimiter is 0.
    """

    def __init__(self, words: list[bytes]) -> None:
        joined = np.frombuffer(b"\0" + b"\0".join(words), dtype=np.uint8)
        present = np.unique(joined)
        self.size = len(present)
        self.code = np.full(256, -1, dtype=np.int64)
        self.code[present] = np.arange(self.size)
        text = self.code[joined]
        self.starts = np.flatnonzero(text == 0)
        self.order, _ = suffix_ranks(text)
        self.left = _one_way(text, self.order, self.size)
        mirror = text[::-1]
        self.right = _one_way(mirror, suffix_ranks(mirror)[0], self.size)
        self.length = len(text)

    def all(self, n: int) -> np.ndarray:
        """n states of the empty pattern: rank, mirrored rank and size of its interval."""
        return np.tile(np.array([0, 0, self.length], dtype=np.int64), (n, 1))

    def extended(self, states: np.ndarray, right: np.ndarray) -> np.ndarray:
        """States [s, character, 3] after a step by each character, to the right where ``right``."""
        out = np.empty((len(states), self.size, 3), dtype=np.int64)
        for way, side, own, other in ((self.left, ~right, 0, 1), (self.right, right, 1, 0)):
            some = np.flatnonzero(side)
            if len(some):
                lo, rest, n = states[some][:, [own, other, 2]].T
                low = way.before[lo].astype(np.int64)
                count = way.before[lo + n] - low
                out[some, :, own] = way.first + low
                out[some, :, other] = rest[:, None] + np.cumsum(count, axis=1) - count
                out[some, :, 2] = count
        return out

    def words_at(self, ranks: np.ndarray) -> np.ndarray:
        """Numbers of the words whose delimiter starts the suffixes of these ranks."""
        return np.searchsorted(self.starts, self.order[ranks])


def one_error(index: Bidirectional, queries: list[bytes], first_half: np.ndarray) -> np.ndarray:
    """Pairs (query, word of the index) at distance one.

    ``first_half`` says which half of a query is matched exactly. Half of a state's pattern is
    fixed at the start; a state is then moved on by one character of the query, in the direction of
    the other half, and once by a character that differs, is left out or is put in.
    """
    lengths = np.array([len(q) for q in queries])
    bounds = np.cumsum(lengths) - lengths
    codes = index.code[np.frombuffer(b"".join(queries), dtype=np.uint8)]
    half = lengths // 2
    states = index.all(len(queries))
    alive = np.arange(len(queries))

    def step(states: np.ndarray, right: np.ndarray, by: np.ndarray) -> np.ndarray:
        moved = index.extended(states, right)[np.arange(len(states)), np.maximum(by, 0)]
        moved[by < 0, 2] = 0
        return moved

    # The exact half, from the cut outwards, then the delimiter at its end.
    exact = np.where(first_half, half, lengths - half)
    at = 0
    done = []
    while len(alive):
        n = exact[alive]
        inner = np.where(first_half[alive], half[alive] - 1 - at, half[alive] + at)
        by = np.where(at < n, codes[bounds[alive] + np.clip(inner, 0, lengths[alive] - 1)], 0)
        moved = step(states, ~first_half[alive], by)
        some = moved[:, 2] > 0
        alive, states, ended = alive[some], moved[some], (at >= n)[some]
        done.append((alive[ended], states[ended]))
        alive, states = alive[~ended], states[~ended]
        at += 1
    query = np.concatenate([a for a, _ in done]) if done else np.empty(0, np.int64)
    state = np.concatenate([s for _, s in done]) if done else np.empty((0, 3), np.int64)
    used = np.zeros(len(query), dtype=np.int64)  # characters of the other half
    erred = np.zeros(len(query), dtype=bool)
    found = []
    while len(query):
        right = first_half[query]
        rest = np.where(right, lengths[query] - half[query], half[query])
        left = used < rest
        place = np.where(right, half[query] + used, half[query] - 1 - used)
        by = np.where(left, codes[bounds[query] + np.clip(place, 0, lengths[query] - 1)], 0)
        every = index.extended(state, right)
        rows = np.arange(len(query))
        straight = every[rows, np.maximum(by, 0)]
        straight[by < 0, 2] = 0
        met = straight[:, 2] > 0
        over = met & ~left & erred
        found.append(np.stack([query[over], index.words_at(straight[over, 0])], axis=1))
        # A query used up without an error is the word itself; what remains is to put one in.
        on = met & left
        parts = [(query[on], straight[on], used[on] + 1, erred[on])]
        open_ = np.flatnonzero(~erred)
        skip = open_[left[open_]]
        parts.append((query[skip], state[skip], used[skip] + 1, np.ones(len(skip), bool)))
        present = every[open_, :, 2] > 0
        present[:, 0] = False
        row, character = np.nonzero(present)
        source = open_[row]
        moved = every[source, character]
        parts.append((query[source], moved, used[source], np.ones(len(source), bool)))
        other = left[source] & (character != by[source])
        source, moved = source[other], moved[other]
        parts.append((query[source], moved, used[source] + 1, np.ones(len(source), bool)))
        query, state, used, erred = (np.concatenate(p) for p in zip(*parts, strict=True))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return np.unique(pairs, axis=0)


def _searched(group: pa.Table) -> pa.Table:
    """Words of an index against the searches that visit it."""
    text = group.column("listed").to_numpy(zero_copy_only=False).astype(bool)
    words = np.array([w.encode("latin-1") for w in group.column("word").to_pylist()], dtype=object)
    n = group.column("n").to_numpy()
    half = group.column("first").to_numpy(zero_copy_only=False).astype(bool)
    listed, at = np.unique(words[text], return_index=True)
    listed_n = n[text][at]
    queries, halves = words[~text], half[~text]
    a, b = [], []
    if len(listed) and len(queries):
        index = Bidirectional(listed.tolist())
        for lo in range(0, len(queries), 4096):
            some = queries[lo : lo + 4096]
            pairs = one_error(index, some.tolist(), halves[lo : lo + 4096])
            a.append(some[pairs[:, 0]])
            b.append(pairs[:, 1])
    froms = np.concatenate(a) if a else np.empty(0, object)
    tos = np.concatenate(b) if b else np.empty(0, np.int64)
    decoded = np.array([w.decode("latin-1") for w in listed], dtype=object)
    return pa.table(
        {
            "word": pa.array([w.decode("latin-1") for w in froms], pa.string()),
            "near": pa.array(decoded[tos] if len(tos) else [], pa.string()),
            "near_n": pa.array(listed_n[tos] if len(tos) else [], pa.int64()),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words of (word, n) at distance one.

    A word is listed under its first halves as words one shorter, as long and one longer cut them,
    and likewise under its last halves; a word looks under its own two halves.
    """
    size = F.length("word")

    def keys(lengths: list, first: bool) -> F.Column:
        """Distinct halves of a word, as if it had these lengths."""
        cut = [(F.floor(n / 2) if first else n - F.floor(n / 2)).cast("int") for n in lengths]
        part = [F.substring("word", F.lit(1), c) if first else F.right("word", c) for c in cut]
        side = F.lit(first)
        return F.transform(
            F.array_distinct(F.array(*part)),
            lambda half: F.struct(side.alias("first"), F.xxhash64(side, half).alias("half")),
        )

    def dealt(lengths: list, listed: bool) -> DataFrame:
        sides = [keys(lengths, first) for first in (True, False)]
        rows = words.select("word", "n", F.explode(F.concat(*sides)).alias("key"))
        return rows.select("word", "n", "key.first", "key.half", F.lit(listed).alias("listed"))

    rows = dealt([size - 1, size, size + 1], True).union(dealt([size], False))
    total = words.count()
    groups = max(1, -(-4 * total // INDEX_WORDS))
    rows = rows.withColumn("group", F.pmod("half", F.lit(groups)))
    rows = stage(rows.drop("half"), "halves")
    sizes = rows.groupBy("group").agg(
        F.ceil(F.count_if("listed") / (2 * INDEX_WORDS)).alias("indexes"),
        F.ceil(F.count_if(~F.col("listed")) / SEARCHES).alias("visits"),
    )
    rows = rows.join(sizes, "group")

    def parts(own: str, other: str) -> list:
        """A row's own part of its group, once for each part of the other side."""
        mine = F.pmod(F.xxhash64("word"), F.greatest(own, F.lit(1)))
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(other, F.lit(1)) - 1))
        return [mine.alias("mine"), every.alias("every")]

    plain = ["group", "word", "n", "first", "listed"]
    texts = rows.where("listed").select(*plain, *parts("indexes", "visits"))
    texts = texts.select(*plain, F.col("mine").alias("index"), F.col("every").alias("visit"))
    asks = rows.where("not listed").select(*plain, *parts("visits", "indexes"))
    asks = asks.select(*plain, F.col("every").alias("index"), F.col("mine").alias("visit"))
    met = texts.union(asks).groupBy("group", "index", "visit")
    pairs = met.applyInArrow(_searched, "word string, near string, near_n bigint")
    return pairs.drop_duplicates(["word", "near"])


def spelling_variants(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, factor: int = 5
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts of (doc_id, text).

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased; a run with
    checksum h of ``<doc_id>:<run>`` loses the character h % length where 199 divides h. Words of
    ``least_length`` characters that occur ``least_count`` times count. Two are near if one
    character is put in, left out or replaced. ``form`` is the near word of largest n (the smallest
    one of several) if that is ``factor`` times the word's own n or more; ``root`` is where
    following forms ends, and the word itself without a form.

    - A null or empty text has no words. A run of a row without doc_id loses no character.
    - Repeated rows count as often as they occur. Other columns are ignored.
    - A very long text is counted whole. A very long run is a word like any other; a search for it
      takes as many steps as it has characters.
    - A table without words gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    counted = docs.mapInArrow(_counted(least_length), "word string, n bigint")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    words = stage(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    accepted = -F.col("best.less") >= factor * F.col("n")
    variants = joined.select(
        "word",
        F.when(accepted, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(accepted, -F.col("best.less")).alias("form_n"),
    )
    variants = stage(variants, "variants")
    roots = roots_of(variants.where("form is not null").select("word", "form"))
    roots = roots.withColumnRenamed("word", "of")
    out = variants.join(roots, F.col("word") == F.col("of"), "left")
    root = F.coalesce("root", "word").alias("root")
    return out.select("word", "form", root, "n", "n_near", "form_n")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms.

    A form has several times its word's occurrences, so chains are short and have no cycles; each
    round doubles how far a word looks.
    """
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("then"))
        joined = roots.join(onward, "root", "left")
        if joined.where("then is not null").isEmpty():
            return roots
        further = joined.select("word", F.coalesce("then", "root").alias("root"))
        old, roots = roots, stage(further, "roots")
        release(old)
