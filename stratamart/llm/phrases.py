"""Phrase collocations: sequences of words that occur together more often than their parts suggest.

Each task counts the n-grams of its texts in a count transducer (``transducer``), built a buffer of
sorted n-grams at a time and joined to what it has. Transducers are cut into ranges of prefixes,
which the tasks of the next stage unite, adding weights, in two steps. Only sequences that occur
often enough are kept then. To look up the parts of a phrase, each range writes the parts of its
candidates as an acceptor, cut into the ranges in which they lie; there the acceptor is composed
with the transducer, and goes back with its counts. The same acceptors carry the counts of the
longer phrases, so each range learns which of its candidates a longer one covers.

Before that, two sketches (merged tables of bounded size that never underestimate), one of words and
pairs, one of the longer sequences that these leave, tell which sequences cannot reach the least
count; these are not counted. They change no result, only how much is sorted and sent. They grow with
the text up to a fixed size; tasks only get a bit of each counter. What a task counts, cuts and hands
on is bounded whether they drop anything or not.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm import counts, transducer
from stratamart.llm.staging import drop_read_shuffles, stage
from stratamart.llm.text import IS_SPACE, give_back, slices, text_bytes, words_of
from stratamart.llm.text import mix as spread

U64 = np.uint64
#: Bytes that end a piece of text, and those that part words.
IS_END = np.zeros(256, dtype=bool)
IS_END[list(b".,;:!?\n\x0b\x0c\r")] = True
IS_GAP = IS_END.copy()
IS_GAP[[0x20, 0x09]] = True
assert not (IS_SPACE & ~IS_GAP).any()

LONGEST = 4
#: Words of a sorted buffer, and states of a task's transducer before it is handed on.
BUFFER = 1 << 19
STATES = 1 << 21
#: Words of a task that wait to be spelt out.
SPELT = 200_000
#: Bytes of text for each prefix range.
RANGE_BYTES = 32_000_000
#: Tasks whose transducers meet in the first step.
FAN_IN = 64
#: Bytes of what a task hands on at once.
HANDED = 1 << 22
#: Counters of each sketch at least and at most, and bytes of text for each in between.
WIDTH = 1 << 24
MOST_WIDTH = 1 << 26
COUNTER_BYTES = 64
UNKNOWN = "und"

_SHARD = "kind int, range bigint, part int, states binary, lang string, n bigint"
_SHARD_NAMES = [x.split(" ")[0] for x in _SHARD.split(", ")]
_SHARD_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int64()]
AUTOMATON, WORD, TOTAL = range(3)
ANSWER, LONGER = range(2)


class Pieces:
    """Words of a slice of texts: labels (of language and word), and how far their piece goes on."""

    def __init__(self, part: pa.RecordBatch) -> None:
        self.data, offsets = text_bytes(part.column("text"))
        self.words = words_of(self.data, offsets, lower=True, space=IS_GAP)
        languages = part.column("lang").to_pylist()
        known = {x: _language_hash(x) for x in set(languages)}
        mark = np.array([known[x] for x in languages], dtype=U64)
        sizes = np.diff(self.words.bounds)
        owner = np.repeat(np.arange(len(languages)), sizes)
        self.labels = spread(self.words.hashes ^ mark[owner])
        self.languages = languages
        self.sizes = sizes
        self.owner = owner
        ends = np.concatenate([[0], np.cumsum(IS_END[self.data])])
        piece = ends[self.words.starts]
        self.joined = np.zeros(len(owner), dtype=bool)  # with the next word
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])

    def grams(self) -> list[np.ndarray]:
        """Hashes of the sequences of one to LONGEST words from each word on, by length."""
        out = [self.labels]
        for k in range(1, LONGEST):
            after = np.concatenate([self.labels[k:], np.zeros(min(k, len(self.labels)), U64)])
            out.append(spread(spread(out[-1]) + after))
        return out

    def frequent(self, short: np.ndarray, long: np.ndarray | None = None) -> list:
        """By length: may the sequence from each word on, and all in it, be frequent by the bits?"""
        grams = self.grams()

        def at_least(bits: np.ndarray, k: int) -> np.ndarray:
            return counts.has_bit(bits, grams[k])

        out = [at_least(short, 0)]
        for k in range(1, LONGEST):
            here = out[-1] & np.append(out[-1][1:], np.zeros(min(1, len(out[-1])), bool))
            if k == 1:
                here &= self.joined & at_least(short, 1)
            elif long is not None:
                here &= at_least(long, k)
            out.append(here)
        return out

    def word(self, i: int) -> str:
        raw = self.data[self.words.starts[i] : self.words.ends[i]].tobytes()
        return raw.lower().decode()


def _language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _short_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for part in slices(batches):
        pieces = Pieces(part)
        yield pieces.labels
        yield pieces.grams()[1][pieces.joined]


def _long_grams(short: object):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in slices(batches):
            pieces = Pieces(part)
            grams = pieces.grams()
            for k, here in list(enumerate(pieces.frequent(short.value)))[2:]:
                yield grams[k][here]

    return hashes


def _shards(short: object, long: object, ranges: int):
    """Transducers by range, words by label and the number of words by language of a task's texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id = TaskContext.get().partitionId() // FAN_IN
        rows: list[tuple] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        levels: transducer.Levels | None = None
        known = np.empty(0, dtype=U64)
        totals: dict[str, int] = {}
        spelling: list[tuple[int, str, str]] = []  # label, language, word

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            arrays = [pa.array(c, t) for c, t in zip(columns, _SHARD_TYPES, strict=True)]
            return pa.record_batch(arrays, _SHARD_NAMES)

        def counted() -> None:
            nonlocal levels
            labels, longest = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            fresh = transducer.counted(labels, longest, LONGEST)
            levels = transducer.union([levels, fresh]) if levels else fresh

        def handed_on() -> Iterator[pa.RecordBatch]:
            nonlocal levels
            whole, levels, size = levels, None, 0
            for r, some in transducer.cut(whole, ranges):
                rows.append((AUTOMATON, r, part_id, transducer.packed(some), None, None))
                size += len(rows[-1][3])
                if size >= HANDED:
                    yield batch()
                    size = 0
            if rows:
                yield batch()

        def spelt_out() -> Iterator[pa.RecordBatch]:
            for r, words in _by_range(spelling, ranges):
                rows.append((WORD, r, None, words, None, None))
            spelling.clear()
            if rows:
                yield batch()

        for part in slices(batches):
            pieces = Pieces(part)
            for lang, n in zip(pieces.languages, pieces.sizes.tolist(), strict=True):
                totals[lang] = totals.get(lang, 0) + n
            frequent = pieces.frequent(short.value, long.value)
            waiting.append((pieces.labels, sum(x.astype(np.int8) for x in frequent)))
            # Words of candidates are words of pairs that may be frequent.
            spelt = frequent[1] | np.append(np.zeros(min(1, len(frequent[1])), bool), frequent[1][:-1])
            new, first = np.unique(pieces.labels[spelt], return_index=True)
            other = ~np.isin(new, known, assume_unique=True)
            known = np.union1d(known, new)
            place = np.flatnonzero(spelt)[first[other]]
            for label, i in zip(new[other].tolist(), place.tolist(), strict=True):
                spelling.append((label, pieces.languages[pieces.owner[i]], pieces.word(i)))
            if sum(len(x) for x, _ in waiting) >= BUFFER:
                counted()
                if transducer.size(levels) >= STATES:
                    yield from handed_on()
            if len(spelling) > SPELT:
                yield from spelt_out()
        if waiting:
            counted()
        if levels:
            yield from handed_on()
        yield from spelt_out()
        give_back()
        rows.extend((TOTAL, None, None, None, lang, n) for lang, n in totals.items())
        if rows:
            yield batch()

    return count


def _by_range(spelling: list[tuple[int, str, str]], n: int) -> Iterator[tuple[int, bytes]]:
    """Words with their labels and languages, packed by the range of the label."""
    if spelling:
        ranges = transducer.ranges_of(np.array([x for x, _, _ in spelling], dtype=U64), None, n)
        order = np.argsort(ranges, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(ranges[order])) + 1):
            words = [spelling[i] for i in some.tolist()]
            yield int(ranges[some[0]]), zlib.compress(json.dumps(words).encode(), 1)


def _wanted(ranges: int):
    """Labels of the words of phrases, with their ranges."""

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = np.unique(part.column("labels").flatten().to_numpy())
            own = transducer.ranges_of(found.view(U64), None, ranges)
            yield pa.record_batch([pa.array(own), pa.array(found)], ["wanted_in", "label"])

    return labels


def _spelt(words: pa.Table, wanted: pa.Table) -> pa.Table:
    """The wanted words of a range."""
    labels = set(wanted.column("label").to_numpy().view(U64).tolist()) if wanted.num_rows else set()
    out: dict[int, tuple[str, str]] = {}
    for data in words.column("states") if labels else ():
        for label, lang, word in json.loads(zlib.decompress(data.as_py())):
            if label in labels:
                out[label] = (lang, word)
    return pa.table(
        {
            "label": pa.array(np.array(list(out), dtype=U64).view(np.int64), pa.int64()),
            "lang": pa.array([x for x, _ in out.values()], pa.string()),
            "word": pa.array([x for _, x in out.values()], pa.string()),
        }
    )


def _united(blobs: Iterator[bytes], combine: np.ufunc = np.add) -> transducer.Levels:
    """One transducer of many, a few at a time, so that each is united a few times only."""
    waiting: list[transducer.Levels] = []
    fresh = 0
    for data in blobs:
        waiting.append(transducer.unpacked(data))
        fresh += transducer.size(waiting[-1])
        if len(waiting) > 1 and fresh > max(STATES, transducer.size(waiting[0]) // 2):
            waiting = [transducer.union(waiting, combine)]
            fresh = 0
    return transducer.union(waiting, combine)


_RANGE = "range bigint, part int, states binary"


def _unite(least: int | None):
    def unite(group: pa.Table) -> pa.Table:
        levels = _united(x.as_py() for x in group.column("states"))
        if least is not None:
            levels = transducer.pruned(levels, least)
        states = pa.array([transducer.packed(levels)], pa.binary())
        del levels
        give_back()
        part = pa.array([0], pa.int32()) if least is not None else group.column("part").slice(0, 1)
        return pa.table([group.column("range").slice(0, 1), part, states], ["range", "part", "states"])

    return unite


def _asked(levels: transducer.Levels, least: int) -> transducer.Levels:
    """Parts of all candidates, with the largest count of a candidate that holds them."""
    paths, lengths, weights = [], [], []
    for m in range(2, LONGEST + 1):
        rows = transducer.paths_of(levels, m)
        f = levels[m - 1].weight
        often = f >= least
        rows, f = rows[often], f[often]
        for n in range(1, m):
            for at in range(m - n + 1):
                if n == 1 and 0 < at < m - 1:
                    continue  # no part of a phrase that is cut in two
                whole = np.zeros((len(rows), LONGEST), dtype=U64)
                whole[:, :n] = rows[:, at : at + n]
                paths.append(whole)
                lengths.append(np.full(len(rows), n))
                weights.append(f if n > 1 else np.zeros(len(rows), np.int64))
    return transducer.sequences(*map(np.concatenate, (paths, lengths, weights)), LONGEST)


def _asks(least: int, ranges: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for asker, data in zip(part.column("range").to_pylist(), part.column("states"), strict=True):
                asked = _asked(transducer.unpacked(data.as_py()), least)
                cuts = list(transducer.cut(asked, ranges))
                yield pa.record_batch(
                    [
                        pa.array([r for r, _ in cuts], pa.int64()),
                        pa.array([asker] * len(cuts), pa.int64()),
                        pa.array([transducer.packed(x) for _, x in cuts], pa.binary()),
                    ],
                    ["target", "asker", "states"],
                )

    return ask


def _answered(own: pa.Table, asks: pa.Table) -> pa.Table:
    """Counts of what each range asked for, and for this one the counts of longer phrases."""
    to, kind, states = [], [], []
    if own.num_rows and asks.num_rows:
        levels = transducer.unpacked(own.column("states")[0].as_py())
        longest = [np.zeros(len(v), dtype=np.int64) for v in levels]
        for asker, data in zip(asks.column("asker").to_pylist(), asks.column("states"), strict=True):
            asked = transducer.unpacked(data.as_py())
            answer, met = transducer.composed(asked, levels)
            for best, state, level in zip(longest, met, asked, strict=True):
                np.maximum.at(best, state[state >= 0], level.weight[state >= 0])
            to.append(asker)
            kind.append(ANSWER)
            states.append(transducer.packed(answer))
        whole = [transducer.Level(v.parent, v.label, w) for v, w in zip(levels, longest, strict=True)]
        to.append(own.column("range")[0].as_py())
        kind.append(LONGER)
        states.append(transducer.packed(whole))
    return pa.table(
        {
            "to": pa.array(to, pa.int64()),
            "kind": pa.array(kind, pa.int32()),
            "states": pa.array(states, pa.binary()),
        }
    )


def _weight(levels: transducer.Levels, paths: np.ndarray) -> np.ndarray:
    n = paths.shape[1]
    return levels[n - 1].weight[transducer.found(levels, paths, n)]


def _cut_scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """floor(2000000 a / (l + r)), exact."""
    if len(a) and int(a.max()) >= 1 << 41:
        whole = [2_000_000 * int(x) // (int(y) + int(z)) for x, y, z in zip(a, left, right, strict=True)]
        return np.array(whole, dtype=np.int64)
    return 2_000_000 * a // (left + right)


def _scored(least: int, covered: tuple[int, int]):
    """Candidates of a range that no longer one covers, with their lowest-scoring cut."""

    def score(own: pa.Table, messages: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], [], []]
        if own.num_rows and messages.num_rows:
            levels = transducer.unpacked(own.column("states")[0].as_py())
            kinds = messages.column("kind").to_numpy()
            blobs = messages.column("states")
            answered = [blobs[int(i)] for i in np.flatnonzero(kinds == ANSWER)]
            answers = _united(x.as_py() for x in answered) if answered else []
            covering = [transducer.unpacked(blobs[int(i)].as_py()) for i in np.flatnonzero(kinds == LONGER)]
            for m in range(2, LONGEST + 1):
                a = levels[m - 1].weight
                if not answered or not len(a):
                    continue  # without a candidate nothing was asked
                # Products may pass 64 bits: f * 100 >= a * 80 as Python integers where they could.
                f = covering[0][m - 1].weight if covering else np.zeros(len(a), np.int64)
                small = max(a.max(initial=0), f.max(initial=0)) < 1 << 50
                x, y = (a, f) if small else (a.astype(object), f.astype(object))
                rows = np.flatnonzero((a >= least) & ~(covered[0] * y >= covered[1] * x).astype(bool))
                paths, a = transducer.paths_of(levels, m)[rows], a[rows]
                best = None
                for k in range(1, m):
                    left, right = _weight(answers, paths[:, :k]), _weight(answers, paths[:, k:])
                    value = _cut_scores(a, left, right)
                    if best is None:
                        best = [value, left, right]
                    else:
                        less = value < best[0]
                        best = [np.where(less, n, o) for n, o in zip((value, left, right), best, strict=True)]
                columns[0].extend(paths.view(np.int64))
                for column, values in zip(columns[1:], (a, best[1], best[2], best[0]), strict=True):
                    column.append(values)
        numbers = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns[1:]]
        arrays = [pa.array(columns[0], pa.list_(pa.int64())), *(pa.array(x, pa.int64()) for x in numbers)]
        return pa.table(arrays, ["labels", "a", "l", "r", "score"])

    return score


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, covered: tuple[int, int] = (100, 80)
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases per language of (text, lang).

    Texts, with A-Z lower-cased, are split at ``.,;:!?`` and line ends into pieces, and these at
    spaces and tabs into words. Candidates are phrases of two to four words of a piece that occur
    ``least`` times (``a``, overlaps included). Cut in two, a phrase scores floor(2000000 a / (l +
    r)) with the occurrences of its parts; its lowest cut counts, the first of several. A phrase
    contained in a longer candidate of f occurrences is dropped if covered[0] f >= covered[1] a.
    ``rank`` orders by score and a, largest first, then by phrase in UTF-8 byte order; ``n`` is the
    number of words of the language.

    - A null text is empty. A null language counts as ``und``. Other columns are ignored.
    - Repeated rows count as often as they occur. A table without candidates gives no rows.
    - A very long text is counted whole, in a slice of its own.
    - A frequent first word is spread over the ranges of its pairs. Words are told apart by 64-bit
      hashes of language and word.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    docs = docs.select(F.col("text").cast("string").alias("text"), lang)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-int(size) // RANGE_BYTES))
    often = min(least, 255)  # counters end there
    context = spark.sparkContext
    width = 1 << (int(size) // COUNTER_BYTES).bit_length()
    width = max(WIDTH, min(MOST_WIDTH, width))
    short = context.broadcast(counts.merged_counts(docs, _short_grams, width, least=often))
    long = context.broadcast(counts.merged_counts(docs, _long_grams(short), width, least=often))
    drop_read_shuffles(spark)
    shards = stage(docs.mapInArrow(_shards(short, long, ranges), _SHARD), "shards")
    short.unpersist()
    long.unpersist()

    parts = shards.where(F.col("kind") == AUTOMATON).select("range", "part", "states")
    once = parts.groupBy("range", "part").applyInArrow(_unite(None), _RANGE)
    united = once.groupBy("range").applyInArrow(_unite(least), _RANGE)
    united = stage(united.select("range", "states"), "ranges")

    asks = united.mapInArrow(_asks(least, ranges), "target bigint, asker bigint, states binary")
    answer = united.groupBy("range").cogroup(asks.groupBy("target"))
    answers = answer.applyInArrow(_answered, "to bigint, kind int, states binary")
    whole = united.select(F.col("range").alias("of"), F.col("range"), "states")
    scored = whole.groupBy("of").cogroup(answers.groupBy("to")).applyInArrow(
        _scored(least, covered), "labels array<bigint>, a bigint, l bigint, r bigint, score bigint"
    )
    scored = stage(scored, "scored")

    wanted = scored.select("labels").mapInArrow(_wanted(ranges), "wanted_in bigint, label bigint")
    words = shards.where(F.col("kind") == WORD).select("range", "states").groupBy("range")
    words = words.cogroup(wanted.distinct().groupBy("wanted_in"))
    words = words.applyInArrow(_spelt, "label bigint, lang string, word string")
    single = scored.select("labels", F.posexplode("labels").alias("place", "label"))
    spelt = single.join(words, "label").groupBy("labels").agg(  # four words at most
        F.first("lang").alias("lang"),
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"),
    )
    phrase = F.array_join("words.word", " ").alias("phrase")
    phrases = scored.join(spelt, "labels").select("lang", phrase, "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = shards.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    names = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return ranked.join(totals, "lang").select(*names)
