"""Bringing marks of a few documents back to their texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm import counts
from stratamart.llm.setjoin import long_column
from stratamart.llm.text import mix


def keyed(docs: DataFrame) -> DataFrame:
    """With ``rh``, a hash of the text that tells apart different rows of one doc_id."""
    return docs.withColumn("rh", F.xxhash64("text"))


def with_marks(
    docs: DataFrame,
    marks: DataFrame,
    column: str,
    on: tuple[str, ...] = ("doc_id", "rh"),
    then: Callable | None = None,
    schema: str = "",
) -> DataFrame:
    """``docs`` with the column of ``marks``, which has one row per ``on``; null where it has none.

    ``then`` turns batches of that into batches of ``schema``, in the same tasks.

    A bit table of fixed size over the marked doc_ids lets rows that surely have no mark pass
    without a shuffle. A null doc_id has no marks.
    """
    spark = docs.sparkSession

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in batches:
            yield mix(long_column(part, "doc_id").view(np.uint64))

    width = counts.width_for(marks.count())
    present = spark.sparkContext.broadcast(
        counts.merged_bits(marks.select("doc_id"), ids, width)
    )

    def rows(wanted: bool) -> Callable:
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                doc_id = part.column("doc_id")
                filled = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
                hit = counts.has_bit(present.value, mix(filled.astype(np.int64).view(np.uint64)))
                hit &= doc_id.is_valid().to_numpy(zero_copy_only=False)
                yield part.filter(pa.array(hit == wanted))

        return choose

    kind = marks.schema[column].dataType
    names = [*docs.columns, column]
    maybe = docs.mapInArrow(rows(True), docs.schema).join(marks, list(on), "left").select(*names)
    if then is None:
        surely_not = docs.mapInArrow(rows(False), docs.schema)
        return surely_not.withColumn(column, F.lit(None).cast(kind)).union(maybe)
    plain = rows(False)

    def unmarked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(plain(batches))

    nothing = docs.withColumn(column, F.lit(None).cast(kind))
    return nothing.mapInArrow(unmarked, schema).union(maybe.mapInArrow(then, schema))
