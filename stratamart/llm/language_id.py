"""Language identification by string kernels.

The kernel of two texts is the share of character n-grams, of one to ``LONGEST`` characters, that
both contain: ``|G(x) & G(y)| / sqrt(|G(x)| |G(y)|)``, with presence and not counts, blended over
all lengths. Nyström landmarks, a sample of the labelled texts, map a text to its kernel with each
landmark; one ridge regression per language on these features separates it from the rest. Texts
are scored in batches by products of their presence matrix with the landmarks' matrix.

Letters are lower-cased and runs of anything else are one blank, so digits and symbols play no part.
An n-gram is a hash into ``SPACE`` presence bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 3
SPACE = 1 << 14
#: Characters of one text handled at once; neighbours overlap, so no n-gram is lost.
PIECE_CHARS = 1 << 20
BATCH_TEXTS = 64
UNKNOWN = "und"

_U32 = np.uint32
_MULTIPLIERS = (_U32(0x9E3779B1), _U32(0x85EBCA77), _U32(0xC2B2AE3D))


def _letter_table() -> np.ndarray:
    """Per code point of the basic plane its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(1 << 16, dtype=np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low[0])
    return table


_LETTERS: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    """Lower-case letters of code points; 0 stands for what is no letter."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    out = _LETTERS[0][np.minimum(points, 0xFFFF)]
    for at in np.flatnonzero(points > 0xFFFF):
        char = chr(points[at])
        out[at] = ord(char.lower()[0]) if char.isalpha() else 0
    return out


def presence(text: str, out: np.ndarray) -> bool:
    """Set the bits of the n-grams of ``text``; False if it has no letter."""
    any_letter = False
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    for at in range(0, len(points), PIECE_CHARS):
        found = letters(points[max(0, at - 64) : at + PIECE_CHARS])
        blank = found == 0
        any_letter |= not blank.all()
        keep = ~blank
        keep[1:] |= ~blank[:-1]  # one blank after each word
        chars = np.concatenate([[_U32(0)], found[keep], [_U32(0)]])
        code = np.zeros(len(chars), dtype=np.uint32)
        for n in range(LONGEST):
            tail = chars[n:]
            code = (code[: len(tail)] + tail + _U32(1)) * _MULTIPLIERS[n % 3]
            code ^= code >> _U32(15)
            out[(code * _U32(0x2C1B3C6D)) >> _U32(33 - SPACE.bit_length())] = 1
    return bool(any_letter)


@dataclass(frozen=True)
class LanguageModel:
    """``landmarks``: n-gram space by landmarks, columns normalised; ``weights``: by language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def kernel(self, bits: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1.0))
        return (bits @ self.landmarks) / norm

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return self.kernel(bits) @ self.weights + self.bias


def fit(
    bits: np.ndarray, labels: list[str], n_landmarks: int = 192, ridge: float = 1e-3
) -> LanguageModel:
    """One-versus-rest kernel ridge regression on Nyström features of presence rows.

    Landmarks are dealt evenly over the languages in the given order. The regression of targets
    +1 and -1 minimises the squared error plus ``ridge`` times the squared norm in the kernel's
    space, with languages weighted equally.
    """
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((SPACE, 0)), np.zeros((0, 0)), np.zeros(0))
    bits = bits.astype(np.float32)
    label = np.array([languages.index(x) for x in labels])
    place = np.zeros(len(label), dtype=np.int64)
    for k in range(len(languages)):
        place[label == k] = np.arange((label == k).sum())
    chosen = np.sort(np.lexsort((label, place))[:n_landmarks])
    marks = bits[chosen].T / np.sqrt(np.maximum(bits[chosen].sum(axis=1), 1.0))
    plain = LanguageModel(languages, np.ascontiguousarray(marks, np.float32), *(np.zeros(0),) * 2)
    cross = plain.kernel(bits).astype(np.float64)
    weight = 1.0 / np.bincount(label, minlength=len(languages))[label]
    weight /= weight.sum()
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    bias = weight @ target
    # The kernel between landmarks is the penalty: |f|^2 = a' K a for f = sum a_l k(., l).
    penalty = cross[chosen] + 1e-8 * np.eye(len(chosen))
    left = cross.T @ (weight[:, None] * cross) + ridge * penalty
    right = cross.T @ (weight[:, None] * (target - bias))
    solved = np.linalg.lstsq(left, right, rcond=1e-12)[0]
    return LanguageModel(languages, plain.landmarks, solved.astype(np.float32), bias)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row.

    ``score`` in 0..1 is the softmax of four times the regression values. A text that is null or
    has no letter is ``und`` with score 0, as is every text if the model knows no language. Ties
    go to the first language in alphabetical order. Texts are read whole, piece by piece.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        bits = np.zeros((BATCH_TEXTS, SPACE), dtype=np.float32)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                part = whole.slice(at, BATCH_TEXTS)
                n = part.num_rows
                bits[:n] = 0
                texts = part.column("text").to_pylist()
                known = [presence(t or "", bits[i]) for i, t in enumerate(texts)]
                languages, chances = [UNKNOWN] * n, [0.0] * n
                if model.languages:
                    value = 4.0 * model.scores(bits[:n]).astype(np.float64)
                    value = np.exp(value - value.max(axis=1, keepdims=True))
                    best = value.argmax(axis=1)
                    chance = value.max(axis=1) / value.sum(axis=1)
                    for i in np.flatnonzero(known):
                        languages[i], chances[i] = model.languages[best[i]], float(chance[i])
                columns = [part.column("doc_id"), pa.array(languages), pa.array(chances)]
                yield pa.record_batch(columns, ["doc_id", "lang_pred", "score"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return docs.mapInArrow(rows, "doc_id bigint, lang_pred string, score double")


def held_out() -> Column:
    """Is the row kept from training: crc32 of the doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, per_language: int = 600, most: int = 20_000
) -> tuple[np.ndarray, list[str]]:
    """Presence rows and labels of at most ``per_language`` labelled rows of each language.

    Rows are chosen by a hash of their doc_id and text, the same ones in every run, and ``most``
    bounds all of them together. Hashes are chosen first, without the texts; then the whole texts of
    the chosen rows are turned into presence bits where they are read, and only these bits are sent.
    Texts without a letter are left out, and repeated rows count once.
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    rows = docs.where(usable).select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    keys = rows.select("lang", "h").distinct().withColumn("place", place)
    keys = keys.where(F.col("place") <= per_language).orderBy("place", "lang").limit(most)
    places = {(r["lang"], r["h"]): r["place"] for r in keys.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            names = zip(part.column("lang").to_pylist(), part.column("h").to_pylist(), strict=True)
            found = [shared.value.get(name) for name in names]
            part = part.filter(pa.array([place is not None for place in found], pa.bool_()))
            out = []
            for text in part.column("text").to_pylist():
                bits = np.zeros(SPACE, dtype=np.uint8)
                known = presence(text, bits)
                out.append(np.packbits(bits).tobytes() if known else None)
            kept = pa.array([place for place in found if place is not None], pa.int32())
            columns = [kept, part.column("lang"), pa.array(out, pa.binary())]
            yield pa.record_batch(columns, ["place", "lang", "bits"])

    found = rows.mapInArrow(packed, "place int, lang string, bits binary").distinct()
    found = found.where("bits is not null").collect()
    found.sort(key=lambda r: (r["place"], r["lang"]))
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in found), dtype=np.uint8)
    return np.unpackbits(bits.reshape(len(found), SPACE // 8), axis=1), [r["lang"] for r in found]


def identify_languages(
    docs: DataFrame, per_language: int = 600, n_landmarks: int = 192
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): train on the labelled rows, predict all of them.

    Rows that ``held_out`` names and rows of null lang or text are not learned from. Predictions
    depend on the text alone. A null doc_id is never held out. With no row to learn from every
    text is ``und``. Repeated rows are predicted alike; an empty table gives no rows; columns
    other than doc_id, text and lang are ignored.
    """
    bits, labels = training_sample(docs, per_language)
    model = fit(bits, labels, n_landmarks)
    out = predict(docs, model).withColumn("held_out", held_out())
    return out.select("doc_id", "held_out", "lang_pred", "score")
