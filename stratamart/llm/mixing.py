"""Mixing to target weights with soft domain membership.

A classifier learned from a labelled table gives every document a chance for each domain. Then a
rate per document, how often it is to be used on average, is fitted by projected-gradient least
squares so that the expected tokens of each domain match targets:

    minimise  1/2 sum_k (T_k - t_k)^2 / D_k   over  r_d >= least
    with      T_k = sum_d r_d n_d P_dk

with n_d the tokens of document d, P_dk its chance for domain k, t_k the targets and D_k the tokens
that domain k has to begin with. From rates of 1, a step moves each rate against its gradient and
back to ``least`` where it fell below. Measured in tokens, the gradient of r_d is sum_k P_dk g_k with
g_k = (T_k - t_k) / D_k, and dividing by D_k makes a step of length 1 safe, so that rare domains move
as fast as large ones. Steps are accelerated, and begin anew where the sum of squares grew.

A step needs from the corpus the K expected totals only. The rate of a document follows from its
chances and the gradients of the steps so far, K numbers each, so nothing is stored per document.
Steps go on until every domain is within a relative tolerance of its target. Targets that no rates
can meet are met as well as possible, and the miss is logged as a warning.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.features import (
    Softmax,
    fit_softmax,
    hashed_sample,
    sample_features,
    text_features,
)
from stratamart.llm.staging import stage
from stratamart.llm.text import slices, text_bytes, words_of

LOG = logging.getLogger(__name__)

@dataclass(frozen=True)
class Mix:
    """``targets``: weight per domain, normalised to one; ``labelled`` bounds the sample.

    ``tokens`` is the wanted number of expected tokens; None keeps the number there is, and
    "most" takes as many as leave every domain at least what it has. Where ``least`` and documents
    that belong to several domains need more than that to meet the weights, "most" takes more.
    ``tolerance`` is the largest miss of a domain, relative to its target. Steps also end after
    ``steps``, or when ``patience`` of them have not made the sum of squares one percent smaller.
    """

    targets: dict[str, float]
    labelled: int = 8_000
    tokens: float | str | None = None
    least: float = 0.0
    tolerance: float = 1e-4
    steps: int = 200
    patience: int = 30


def domains_of(docs: DataFrame, labels: DataFrame, languages_only: bool = False) -> DataFrame:
    """(doc_id, domain) of the labelled documents.

    Toxic ones are ``toxic``, poor ones ``junk``, all others their language; ``languages_only``
    leaves out the former two. Null labels count as not toxic and not poor; a null language is none.
    """
    domain = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").otherwise(
            F.col("lang")
        )
    )
    found = docs.select("doc_id", "lang").join(labels, "doc_id").select(
        "doc_id", domain.alias("domain")
    )
    if languages_only:
        found = found.where("domain not in ('toxic', 'junk')")
    return found.where("domain is not null")


def fit_domains(docs: DataFrame, labelled: DataFrame, mix: Mix) -> Softmax:
    """A classifier of the domains of ``mix.targets``, in their order."""
    names = list(mix.targets)
    known = labelled.where(F.col("domain").isin(names)).where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    rows = dict(hashed_sample(known.select("doc_id", "domain"), mix.labelled))
    sample = sample_features(docs, np.array(sorted(rows), dtype=np.int64))
    truth = np.array([names.index(rows[int(i)]) for i in sample.doc_id], dtype=np.int64)
    return fit_softmax(sample.text, truth, len(names))


def membership(docs: DataFrame, model: Softmax) -> DataFrame:
    """(doc_id, rh, n_tokens, chances) of every row; a token is a word between ASCII spaces.

    A text without words has no tokens, and the chances that the classifier gives to nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(*text_bytes(part.column("text")))
            chances = shared.value.chances(text_features(part))
            columns = [
                part.column("doc_id"),
                part.column("rh"),
                pa.array(np.diff(words.bounds), pa.int64()),
                pa.array(list(chances), pa.list_(pa.float64())),
            ]
            yield pa.record_batch(columns, ["doc_id", "rh", "n_tokens", "chances"])

    docs = docs.withColumn("rh", F.xxhash64("text")).select("doc_id", "rh", "text")
    schema = "doc_id bigint, rh bigint, n_tokens bigint, chances array<double>"
    return docs.mapInArrow(rows, schema)


def _chances(part: pa.RecordBatch, domains: int) -> np.ndarray:
    flat = part.column("chances").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(part.num_rows, domains)


@dataclass(frozen=True)
class Rates:
    """The rates of documents by their chances: gradients of the steps and their momentum."""

    least: float
    gradients: list[np.ndarray]
    momentum: list[float]

    def both(self, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rates after the last step, and the point from which the next step starts."""
        rate = ahead = np.maximum(np.ones(len(chances)), self.least)
        if self.gradients:
            moves = chances @ np.column_stack(self.gradients)
            for i, momentum in enumerate(self.momentum):
                last, rate = rate, np.maximum(ahead - moves[:, i], self.least)
                ahead = rate + momentum * (rate - last)
        return rate, ahead

    def of(self, chances: np.ndarray) -> np.ndarray:
        return self.both(chances)[0]

    def after(self, gradient: np.ndarray, momentum: float) -> Rates:
        return Rates(self.least, [*self.gradients, gradient], [*self.momentum, momentum])


#: Tasks whose sums meet in the first step.
FAN_IN = 64


def expected_totals(members: DataFrame, rates: Rates, domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain at the rates and at the next step's start: one job, two merges."""
    shared = members.sparkSession.sparkContext.broadcast(rates)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, domains))
        for part in batches:
            chances = _chances(part, domains)
            tokens = part.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
            for total, rate in zip(sums, shared.value.both(chances), strict=True):
                total += (rate * tokens) @ chances
        part_id = TaskContext.get().partitionId()
        columns = [pa.array([part_id // FAN_IN]), pa.array([part_id]), pa.array([sums.ravel()])]
        yield pa.record_batch(columns, ["part", "task", "sums"])

    def merge(group: pa.Table) -> pa.Table:
        # In the order of the tasks, so that the sums do not depend on which came first.
        parts = group.sort_by("task")
        sums = np.array([math.fsum(x) for x in zip(*parts.column("sums").to_pylist(), strict=True)])
        return pa.table({"part": [0], "task": parts.column("part").to_pylist()[:1], "sums": [sums]})

    schema = "part bigint, task bigint, sums array<double>"
    once = members.select("n_tokens", "chances").mapInArrow(rows, schema)
    once = once.groupBy("part").applyInArrow(merge, schema)
    found = once.groupBy("part").applyInArrow(merge, schema).collect()  # one row
    shared.unpersist()
    if not found:
        return np.zeros(domains), np.zeros(domains)
    return tuple(np.array(found[0]["sums"]).reshape(2, domains))


def fit_rates(members: DataFrame, mix: Mix) -> tuple[Rates, np.ndarray, np.ndarray]:
    """The rates, the domains' targets in tokens and the expected tokens reached."""
    k = len(mix.targets)
    weights = np.array(list(mix.targets.values()), dtype=float)
    weights = weights / weights.sum()
    rates = Rates(mix.least, [], [])
    at_one, _ = expected_totals(members, Rates(1.0, [], []), k)
    if not at_one.sum():
        return rates, weights * 0, weights * 0
    some = weights > 0
    most = mix.tokens == "most"
    wanted = float(at_one.sum())
    if most:
        wanted = float((at_one[some] / weights[some]).max())
    elif mix.tokens is not None:
        wanted = float(mix.tokens)
    mass = np.where(at_one > 0, at_one, np.inf)  # a domain that no document can have does not move
    scale = np.where(some, weights, weights[some].min())
    best, since, momentum, last = math.inf, 0, 1.0, math.inf
    for _ in range(mix.steps):
        reached, ahead = expected_totals(members, rates, k)

        def aim(totals: np.ndarray) -> np.ndarray:
            """The targets; with "most" as many tokens as fit the shares best, if that is more."""
            fit = (weights * totals / mass).sum() / (weights**2 / mass).sum()
            return weights * (max(wanted, fit) if most else wanted)

        targets = aim(reached)
        miss = float((np.abs(reached - targets) / (scale * targets.sum())).max()) if wanted else 0.0
        squares = float(((reached - targets) ** 2 / mass).sum())
        if squares < 0.99 * best:
            best, since = squares, 0
        since += 1
        if miss <= mix.tolerance or since > mix.patience:
            break
        if squares > last:  # begin anew from the rates, without momentum
            momentum, ahead = 1.0, reached
            rates = Rates(rates.least, rates.gradients, [*rates.momentum[:-1], 0.0])
        last = squares
        following = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        gradient = (ahead - aim(ahead)) / mass
        rates = rates.after(gradient, (momentum - 1) / following)
        momentum = following
    else:
        reached, _ = expected_totals(members, rates, k)
        targets = aim(reached)
    return rates, targets, reached


def log_totals(mix: Mix, targets: np.ndarray, reached: np.ndarray) -> None:
    """One line per domain: a warning where the target is missed by more than the tolerance."""
    for name, target, total in zip(mix.targets, targets, reached, strict=True):
        level = logging.INFO if abs(total - target) <= mix.tolerance * target else logging.WARNING
        LOG.log(level, "domain %s: %.1f expected tokens for a target of %.1f", name, total, target)


def rate_documents(docs: DataFrame, labelled: DataFrame, mix: Mix) -> DataFrame:
    """(doc_id, rh, n_tokens, domain, chance, rate) of every row of ``docs``.

    ``labelled`` has (doc_id, domain); domains without a target are not learned. ``domain`` is the
    likeliest one with its ``chance``; ``rate`` is how often the row is to be used on average. The
    targets and the expected tokens reached are logged per domain (``fit_rates`` returns them).

    - A null or empty text has no tokens; its rate follows from its chances like any other and
      changes no total. Null doc_ids and repeated rows are rated like any other row.
    - Without labelled rows all domains are equally likely; of equally likely ones the first is named.
    - A very long text is one row with the features of the whole.
    - Columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    names = list(mix.targets)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    with_metadata = docs.withColumns(
        {"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")}
    ).withColumn("n_chars", F.lit(None).cast("long"))
    model = fit_domains(with_metadata, labelled, mix)
    members = stage(membership(docs, model), "members")
    rates, targets, reached = fit_rates(members, mix)
    log_totals(mix, targets, reached)
    shared = docs.sparkSession.sparkContext.broadcast(rates)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            chances = _chances(part, len(names))
            best = chances.argmax(axis=1)
            columns = [
                *(part.column(c) for c in ("doc_id", "rh", "n_tokens")),
                pa.array([names[k] for k in best], pa.string()),
                pa.array(chances[np.arange(len(best)), best]),
                pa.array(shared.value.of(chances)),
            ]
            yield pa.record_batch(columns, _RATED)

    schema = "doc_id bigint, rh bigint, n_tokens bigint, domain string, chance double, rate double"
    return members.mapInArrow(rows, schema)


_RATED = ["doc_id", "rh", "n_tokens", "domain", "chance", "rate"]


def times_used(rate: Column, *key: str) -> Column:
    """A whole number of uses whose mean is the rate: the fraction decides by a hash of the key."""
    part = F.pmod(F.xxhash64(*key, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor(rate)
    return (whole + F.when(part < rate - whole, 1).otherwise(0)).cast("int")
