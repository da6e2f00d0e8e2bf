"""Quality classifier by co-training of two views of a document.

One classifier sees the text, the other the page metadata (source, language, length). Both start
from the labelled rows. In each round each view labels the rows of an unlabelled pool of which it is
most sure, and the *other* view learns from them too. At the end each view is calibrated on labelled
rows that neither has seen, and a logistic regression on both calibrated values gives the score.

Fitting uses bounded samples, chosen by a hash of the doc_id; scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.features import (
    Softmax,
    fit_softmax,
    hashed_sample,
    metadata_features,
    sample_features,
    text_features,
)
from stratamart.llm.text import slices


@dataclass(frozen=True)
class CoTraining:
    """``labelled`` and ``pool`` bound the samples; ``share`` of the pool is labelled per round."""

    labelled: int = 12_000
    pool: int = 8_000
    rounds: int = 3
    share: float = 0.1
    sure: float = 0.9
    accept: float = 0.5


def _odds(model: Softmax, rows: np.ndarray) -> np.ndarray:
    z = model.logits(rows)
    return np.clip(z[:, 1] - z[:, 0], -30, 30).astype(np.float64)


@dataclass(frozen=True)
class QualityModel:
    text: Softmax
    meta: Softmax
    text_calibration: Softmax
    meta_calibration: Softmax
    combined: Softmax

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chance of good quality by text, by metadata and by both."""
        a = _odds(self.text_calibration, _odds(self.text, text)[:, None])
        b = _odds(self.meta_calibration, _odds(self.meta, meta)[:, None])
        both = self.combined.chances(np.column_stack([a, b]))[:, 1]
        return 1 / (1 + np.exp(-a)), 1 / (1 + np.exp(-b)), both


def _confident(odds: np.ndarray, free: np.ndarray, prior: float, options: CoTraining) -> np.ndarray:
    """Pool rows of which a view is most sure: per class in proportion to its prior."""
    chosen = []
    for sign, part in ((1, prior), (-1, 1 - prior)):
        value = np.where(free, sign * odds, -np.inf)
        most = int(options.share * len(odds) * part)
        order = np.argsort(-value, kind="stable")[:most]
        least = np.log(options.sure / (1 - options.sure))
        chosen.append(order[value[order] >= least])
    return np.concatenate(chosen)


def co_train(
    text: np.ndarray, meta: np.ndarray, quality: np.ndarray, options: CoTraining
) -> QualityModel:
    """Fit from feature rows; ``quality`` is 0 or 1, or -1 for rows of the pool.

    Every fifth labelled row is kept for calibration. With labels of one class or none the views
    are fitted to what there is; without any label every score is 0.5.
    """
    known = np.flatnonzero(quality >= 0)
    pool = np.flatnonzero(quality < 0)
    held = known[::5] if len(known) >= 10 else known
    learned = np.setdiff1d(known, held) if len(known) >= 10 else known
    prior = float(quality[learned].mean()) if len(learned) else 0.5
    views = (text, meta)
    rows = [learned, learned]
    labels = [quality[learned], quality[learned]]
    free = [np.ones(len(pool), dtype=bool), np.ones(len(pool), dtype=bool)]
    models = [fit_softmax(v[r], y, 2) for v, r, y in zip(views, rows, labels, strict=True)]
    for _ in range(options.rounds if len(pool) and len(learned) else 0):
        for teacher, pupil in ((0, 1), (1, 0)):
            odds = _odds(models[teacher], views[teacher][pool])
            chosen = _confident(odds, free[pupil], prior, options)
            free[pupil][chosen] = False
            rows[pupil] = np.concatenate([rows[pupil], pool[chosen]])
            labels[pupil] = np.concatenate([labels[pupil], (odds[chosen] > 0).astype(int)])
        models = [
            fit_softmax(v[r], y, 2, steps=120)
            for v, r, y in zip(views, rows, labels, strict=True)
        ]
    truth = quality[held]
    one = [_odds(m, v[held])[:, None] for m, v in zip(models, views, strict=True)]
    calibrations = [fit_softmax(o, truth, 2) for o in one]
    calibrated = np.column_stack([_odds(c, o) for c, o in zip(calibrations, one, strict=True)])
    combined = fit_softmax(calibrated.astype(np.float32), truth, 2)
    return QualityModel(*models, *calibrations, combined)


def fit_quality(
    docs: DataFrame, labels: DataFrame, options: CoTraining | None = None
) -> QualityModel:
    """Co-train on documents (doc_id, text, source, lang, n_chars) and labels (doc_id, quality).

    A null label or doc_id is no label; a doc_id with labels that differ counts as the smaller.
    """
    options = options or CoTraining()
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    labelled = hashed_sample(ids.join(known, "doc_id"), options.labelled)
    pool = hashed_sample(ids.join(known, "doc_id", "left_anti"), options.pool)
    quality = {int(i): int(q) for i, q in labelled}
    chosen = np.unique(np.array([*quality, *(int(i) for (i,) in pool)], dtype=np.int64))
    sample = sample_features(docs, chosen)
    # In hash order, so that the calibration rows are a random part.
    order = np.argsort(sample.doc_id * np.int64(0x5851F42D4C957F2D), kind="stable")
    marks = np.array([quality.get(int(i), -1) for i in sample.doc_id[order]], dtype=np.int64)
    return co_train(sample.text[order], sample.meta[order], marks, options)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def score_quality(
    docs: DataFrame, labels: DataFrame, options: CoTraining | None = None
) -> DataFrame:
    """The columns of documents with text_score, meta_score, score (0 to 1) and kept.

    ``kept`` is ``score >= options.accept``. Every row is scored from its whole text.

    - A null or empty text is scored by features that are all zero; null metadata is a value of
      its own. A null doc_id is scored, but never learned from. Repeated rows score alike.
    - Columns other than doc_id, text, source, lang and n_chars are dropped.
    - An empty table gives no rows.
    """
    options = options or CoTraining()
    docs = _input(docs)
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, options))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            scores = model.value.scores(text_features(part), metadata_features(part))
            columns = [*part.columns, *(pa.array(s, pa.float64()) for s in scores)]
            columns.append(pa.array(scores[2] >= options.accept))
            yield pa.record_batch(columns, [*part.schema.names, *_ADDED])

    schema = "doc_id bigint, text string, source string, lang string, n_chars bigint, "
    return docs.mapInArrow(
        rows, schema + "text_score double, meta_score double, score double, kept boolean"
    )


_ADDED = ["text_score", "meta_score", "score", "kept"]
