"""Numeric features of whole texts and a linear classifier over them.

The features of a text are a fixed number of floats, whatever its length. Fitting works on a bounded
sample of feature rows on the driver; scoring is one product per batch in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.text import U64, slices, text_bytes, words_of

WORD_BUCKETS = 512
SHAPES = 16
TEXT_FEATURES = SHAPES + WORD_BUCKETS
SOURCE_BUCKETS, LANG_BUCKETS = 64, 16
META_FEATURES = SOURCE_BUCKETS + LANG_BUCKETS + 3


def _byte_classes() -> np.ndarray:
    """Which of nine classes each byte is in: one column per class."""
    classes = [
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"abcdefghijklmnopqrstuvwxyz",
        b"0123456789",
        b"#*$%&<>",
        b"|",
        b"!?",
        b".,;:",
        b"\n",
        bytes(range(128, 256)),
    ]
    table = np.zeros((256, len(classes)))
    for column, members in enumerate(classes):
        table[list(members), column] = 1
    return table


_CLASSES = _byte_classes()


def text_features(part: pa.RecordBatch) -> np.ndarray:
    """One row of ``TEXT_FEATURES`` floats per text: its shape, then frequencies of hashed words.

    A null or empty text, or one without words, has zeros only.
    """
    data, offsets = text_bytes(part.column("text"))
    words = words_of(data, offsets)
    n = part.num_rows
    out = np.zeros((n, TEXT_FEATURES), dtype=np.float32)
    count = np.diff(words.bounds)
    owner = np.repeat(np.arange(n), count)
    cell = owner * WORD_BUCKETS + (words.hashes & U64(WORD_BUCKETS - 1)).astype(np.int64)
    total = np.bincount(cell, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    some = np.maximum(count, 1)
    out[:, SHAPES:] = np.sqrt(total / some[:, None])
    again = np.zeros(len(words.hashes), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    length = (words.ends - words.starts).astype(np.float64)
    out[:, 0] = np.log1p(count)
    out[:, 1] = np.bincount(owner, weights=length, minlength=n) / some
    out[:, 2] = np.sqrt(np.bincount(owner, weights=length**2, minlength=n) / some)
    out[:, 3] = np.bincount(owner[again], minlength=n) / some
    for i in np.flatnonzero(count):
        hist = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
        out[i, 4:13] = (hist @ _CLASSES) / (offsets[i + 1] - offsets[i])
        ordered = np.sort(words.hashes[words.bounds[i] : words.bounds[i + 1]])
        new = np.count_nonzero(ordered[1:] != ordered[:-1]) + 1
        out[i, 13] = new / count[i]
        out[i, 14] = np.log1p(new) / np.log1p(count[i])
        out[i, 15] = total[i].max() / count[i]
    out[count == 0] = 0
    return out


def _bucket(value: str | None, buckets: int) -> int:
    """Null has a bucket of its own, the first."""
    return 0 if value is None else 1 + xxhash.xxh3_64_intdigest(value.encode()) % (buckets - 1)


def metadata_features(part: pa.RecordBatch) -> np.ndarray:
    """One row of ``META_FEATURES`` floats per row: its source, its language and its length."""
    n = part.num_rows
    out = np.zeros((n, META_FEATURES), dtype=np.float32)
    for i, (source, lang, size) in enumerate(
        zip(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)
    ):
        out[i, _bucket(source, SOURCE_BUCKETS)] = 1
        out[i, SOURCE_BUCKETS + _bucket(lang, LANG_BUCKETS)] = 1
        log = np.log1p(max(size or 0, 0))
        out[i, -3:] = (size is None, log, log * log / 10)
    return out


@dataclass(frozen=True)
class Softmax:
    """Multinomial logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights + self.bias

    def chances(self, rows: np.ndarray) -> np.ndarray:
        z = self.logits(rows).astype(np.float64)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_softmax(
    rows: np.ndarray, labels: np.ndarray, classes: int, penalty: float = 1e-3, steps: int = 250
) -> Softmax:
    """Full-batch accelerated gradient descent; ``penalty`` weighs the squared weights.

    The bias is not penalised. Without rows every class has the same chance.
    """
    if not len(rows):
        d = rows.shape[1]
        zeros = np.zeros((d, classes), np.float32)
        one = np.ones(d, np.float32)
        return Softmax(one * 0, one, zeros, np.zeros(classes, np.float32))
    mean = rows.mean(axis=0, dtype=np.float64).astype(np.float32)
    x = np.empty((len(rows), rows.shape[1] + 1), np.float32)  # the only copy, one more column of 1
    np.subtract(rows, mean, out=x[:, :-1])
    x[:, -1] = 1
    scale = np.sqrt(np.einsum("ij,ij->j", x, x)[:-1] / len(x))
    scale = np.where(scale > 1e-6, scale, 1.0).astype(np.float32)
    x[:, :-1] /= scale
    target = np.zeros((len(x), classes), np.float32)
    target[np.arange(len(x)), labels] = 1
    probe = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        probe = x.T @ (x @ probe)
        probe /= np.linalg.norm(probe)
    largest = float(np.linalg.norm(x @ probe) ** 2 / len(x))
    rate = 1.0 / (0.55 * largest + penalty)
    keep = np.full((x.shape[1], 1), penalty, np.float32)
    keep[-1] = 0
    w = last = np.zeros((x.shape[1], classes), np.float32)
    for step in range(steps):
        ahead = w + (step / (step + 3.0)) * (w - last)
        z = x @ ahead
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        gradient = x.T @ (z - target) / len(x) + keep * ahead
        last, w = w, (ahead - rate * gradient).astype(np.float32)
    return Softmax(mean.astype(np.float32), scale, w[:-1], w[-1])


@dataclass(frozen=True)
class Sample:
    """Feature rows of a bounded set of documents, on the driver."""

    doc_id: np.ndarray
    text: np.ndarray
    meta: np.ndarray


def sample_features(docs: DataFrame, ids: np.ndarray) -> Sample:
    """Features of the rows with these doc_ids (sorted, distinct), from their whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            doc_id = part.column("doc_id").to_numpy(zero_copy_only=False)
            part = part.filter(pa.array(np.isin(doc_id, shared.value)))
            if part.num_rows:
                columns = [
                    part.column("doc_id"),
                    pa.array([r.tobytes() for r in text_features(part)], pa.binary()),
                    pa.array([r.tobytes() for r in metadata_features(part)], pa.binary()),
                ]
                yield pa.record_batch(columns, ["doc_id", "text", "meta"])

    docs = docs.where("doc_id is not null")
    found = docs.mapInArrow(rows, "doc_id bigint, text binary, meta binary")
    found = found.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")

    def matrix(name: str, width: int) -> np.ndarray:
        data, _ = text_bytes(found.column(name))
        return data.view(np.float32).reshape(found.num_rows, width)

    doc_id = found.column("doc_id").to_numpy().astype(np.int64)
    return Sample(doc_id, matrix("text", TEXT_FEATURES), matrix("meta", META_FEATURES))


def hashed_sample(rows: DataFrame, most: int) -> list[tuple]:
    """At most ``most`` rows of a table whose first column is an id, chosen by a hash of the id."""
    key = rows.columns[0]
    chosen = rows.orderBy(F.xxhash64(key), *rows.columns).limit(most)
    return [tuple(r) for r in chosen.collect()]
