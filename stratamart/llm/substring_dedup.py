"""Removal of passages that an earlier document has: exact matching of word windows.

Three passes over the texts, none of which shuffles a text that keeps all its words:

1. Every window of ``window_words`` words has an anchor, its smallest hash of ``ANCHOR_WORDS``
   consecutive words; equal windows have equal anchors, and one anchor stands for many neighbouring
   windows. Partition sketches count the documents of each anchor and are merged. A merged count
   never is below the number of documents that hold any one window of that anchor.
2. Anchors counted twice or more are grouped exactly.
3. Windows whose anchor really stands in two documents are grouped exactly, by 96-bit hashes, with
   the smallest doc_id of each. Windows of a larger doc_id are marked for removal.

Both filters only leave out windows that no second document has, so none is lost. Equal texts are
settled before: all windows of a copy stand in the first of them, which speaks for the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm import counts
from stratamart.llm.marks import keyed, with_marks
from stratamart.llm.setjoin import long_column
from stratamart.llm.staging import release, stage
from stratamart.llm.text import U64, mix, powers, slices, text_bytes, words_of

ANCHOR_WORDS = 16
#: Counters of each of the two rows of the first sketch.
ANCHOR_WIDTH = 1 << 25

_FIRST = 0xA0761D6478BD642F
_SECOND = 0xE7037ED1A0B428DB
_ANCHOR = 0x8EBC6AF09C88C6E3


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of the ``width`` values that start at each position where so many are left."""
    n = len(hashes)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(U64(base), n), out=total[1:])
    back = powers(U64(pow(base, -1, 1 << 64)), n)
    return mix((total[width:] - total[:-width]) * back[: n - width + 1])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of ``width`` neighbours from each position where so many are left."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def windows_of(
    hashes: np.ndarray, bounds: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows inside one text: first word, text, anchor."""
    if len(hashes) < width:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.empty(0, dtype=np.uint64)
    grams = rolling(hashes, min(ANCHOR_WORDS, width), _ANCHOR)
    anchors = sliding_minimum(grams, width - min(ANCHOR_WORDS, width) + 1)
    n = np.maximum(np.diff(bounds) - width + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    first = bounds[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return first, text, anchors[first]


def _anchors(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Per slice: the slice, and each distinct anchor of each of its texts."""
    for part in slices(batches):
        words = words_of(*text_bytes(part.column("text")))
        _, text, anchor = windows_of(words.hashes, words.bounds, width)
        change = np.ones(len(anchor), dtype=bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        anchor, text = anchor[change], text[change]
        order = np.lexsort((anchor, text))
        anchor, text = anchor[order], text[order]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        yield part, anchor[new], text[new]


def _repeated_anchors(docs: DataFrame, width: int) -> np.ndarray:
    """A bit table of the anchors that stand in two documents of different doc_id."""
    spark = docs.sparkSession

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, anchor, _ in _anchors(batches, width):
            yield np.concatenate(counts.two_cells(anchor, 2 * ANCHOR_WIDTH))

    twice = spark.sparkContext.broadcast(counts.merged_bits(docs, seen, 2 * ANCHOR_WIDTH, least=2))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, anchor, text in _anchors(batches, width):
            kept = counts.in_both(twice.value, anchor)
            ids = long_column(part, "doc_id")[text[kept]]
            yield pa.record_batch([anchor[kept].view(np.int64), ids], ["anchor", "doc_id"])

    groups = docs.mapInArrow(rows, "anchor bigint, doc_id bigint").groupBy("anchor")
    groups = groups.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    repeated = stage(groups.where("lo < hi").select("anchor"), "anchors")
    twice.unpersist()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in batches:
            yield long_column(part, "anchor").view(np.uint64)

    width = counts.width_for(repeated.count())
    bits = counts.merged_bits(repeated, found, width)
    release(repeated)
    return bits


def repeated_windows(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rh, first): windows that also start in a document with a smaller doc_id.

    Also the staged table that this reads.

    ``first`` is the number of the window's first word; ``rh`` tells apart rows of one doc_id.
    """
    known = docs.sparkSession.sparkContext.broadcast(_repeated_anchors(docs, width))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(*text_bytes(part.column("text")))
            first, text, anchor = windows_of(words.hashes, words.bounds, width)
            kept = counts.has_bit(known.value, anchor)
            first, text = first[kept], text[kept]
            if not len(first):
                continue
            one = rolling(words.hashes, width, _FIRST)[first]
            two = rolling(mix(words.hashes + U64(1)), width, _SECOND)[first] >> U64(32)
            columns = [
                one.view(np.int64),
                two.astype(np.uint32).view(np.int32),
                long_column(part, "doc_id")[text],
                long_column(part, "rh")[text],
                (first - words.bounds[text]).astype(np.int32),
            ]
            names = ["h1", "h2", "doc_id", "rh", "first"]
            yield pa.record_batch([pa.array(c) for c in columns], names)

    found = docs.mapInArrow(rows, "h1 bigint, h2 int, doc_id bigint, rh bigint, first int")
    found = stage(found, "windows")
    known.unpersist()
    least = found.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")
    )
    least = least.where("lo < hi").select("h1", "h2", "lo")
    later = found.join(least, ["h1", "h2"]).where("doc_id > lo")
    return later.select("doc_id", "rh", "first"), found


#: Stands for every window of a text.
EVERY = -1


def copies_of_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, rh, first) of the rows whose whole text a smaller doc_id has, by 128 bits."""
    same = ["rh", "h", "n"]
    keys = docs.select(
        "doc_id", "rh", F.xxhash64(F.lit(1), "text").alias("h"), F.length("text").alias("n")
    )
    groups = keys.groupBy(*same).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    copies = keys.join(groups.where("lo < hi and n > 0").select(*same, "lo"), same)
    copies = copies.where("doc_id > lo").select("doc_id", "rh").distinct()
    return copies.withColumn("first", F.array(F.lit(EVERY)))


def remove_repeated_passages(docs: DataFrame, window_words: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, text): ``text`` has the kept words, joined by one space.

    A word is a run of characters other than ASCII white space. A word goes if any window of
    ``window_words`` consecutive words of its document covers it whose word sequence also starts in
    a document with a smaller doc_id. Windows are judged on the input, so the order of work does
    not matter, and the document with the smallest doc_id keeps the passage.

    - A null, empty or blank text has no words; its text becomes empty.
    - A document of fewer words than a window keeps them all.
    - A row without doc_id is neither smaller nor larger than another: it keeps all its words.
    - Repeated rows have the same doc_id and hence keep their words, or lose the same ones.
    - Columns other than doc_id and text are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    named = keyed(docs.where("doc_id is not null"))
    copies = stage(copies_of_texts(named), "copies")
    others = with_marks(named, copies, "first").where("first is null").drop("first")
    later, windows = repeated_windows(others, window_words)
    marked = later.groupBy("doc_id", "rh")
    marked = marked.agg(F.collect_set("first").alias("first")).union(copies)
    marked = stage(marked, "marked")
    release(windows, copies)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n_words, n_removed, texts = [], [], []
            all_texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, first in zip(all_texts, part.column("first"), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if first.is_valid:
                    at = np.asarray(first.values)
                    if EVERY in at:
                        at = np.arange(max(len(words) - window_words + 1, 0))
                    change = np.zeros(len(words) + 1, dtype=np.int32)
                    change[at] += 1
                    change[at + window_words] -= 1
                    gone = np.cumsum(change)[:-1] > 0
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words))
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast("string")],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, text string"
    return with_marks(keyed(docs), marked, "first", then=keep, schema=schema)
