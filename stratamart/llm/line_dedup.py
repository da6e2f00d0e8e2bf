"""Removal of lines that nearly repeat an earlier line of the corpus: exact set-similarity join.

A line is a piece of a text between line feeds, its set the distinct word shingles. Tokens are
ordered by rarity, prefixes give the candidate pairs, and the length, positional and parity filters
cut them down before Jaccard is verified on the whole sets.

Lines with equal sets are one class; all but its first line go without a comparison. The first
lines of the classes are joined in two rounds: against the earliest line of every list, and then,
only for lines that no such line removed, against all earlier lines of their lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.marks import keyed, with_marks
from stratamart.llm.setjoin import (
    ListKeys,
    SetSpec,
    as_side,
    frequency_levels,
    may_be_similar,
    node,
    postings,
    repeated_sets,
    set_input,
    signatures,
    signatures_allow,
    size_band,
    verified,
    with_repeated_set,
)
from stratamart.llm.staging import drop_read_shuffles, release, stage


def repeated_lines(docs: DataFrame, spec: SetSpec) -> DataFrame:
    """(doc_id, rh, line_no) of the lines that an earlier line matches, staged; numbers from 0."""
    ids = spec.ids
    texts = set_input(docs, spec)
    levels = frequency_levels(texts, spec)
    signed = stage(signatures(texts, spec, levels).where("n > 0"), "lines")
    a, b = [f"a_{c}" for c in ids], [f"b_{c}" for c in ids]

    # A line whose set no other line has is a head; only the others are brought together.
    shared_sets = repeated_sets(signed, signed.count())
    equal = stage(with_repeated_set(signed.select("d1", "d2", *ids), shared_sets), "equal")
    classes = equal.groupBy("d1", "d2").agg(F.min(F.struct(*ids)).alias("head"))
    classes = stage(classes, "classes")
    copies = equal.join(classes, ["d1", "d2"]).where(F.struct(*ids) != F.col("head"))
    copies = stage(copies.select(*ids), "copies")

    # Lists hold heads, and the few copies that the bit table lets through. Those remove nothing
    # that their heads do not remove, and are themselves settled.
    heads = classes.select("head.*")
    lists = postings(
        signed, spec, ListKeys(spec.percent), heads, tuple(spec.parity), shared_sets=shared_sets
    )
    lists = stage(lists.withColumn("band", size_band()), "lists")
    release(signed, equal, classes)  # nothing below reads them
    drop_read_shuffles(docs.sparkSession)
    fields = [*ids, "n", "place"]
    first = lists.groupBy("key", "band").agg(
        F.min(F.struct(*fields)).alias("f"), F.count(F.lit(1)).alias("rows")
    )
    first = first.where("rows > 1").select(
        "key", "band", *[F.col(f"f.{c}").alias(f"b_{c}") for c in fields]
    )
    star = as_side(lists, "a", fields).join(first, ["key", "band"])
    star = star.where(node("a", ids) > node("b", ids)).where(may_be_similar(spec.percent))
    settled = copies.toDF(*a)
    star = star.select(*a, *b).distinct().join(settled, a, "left_anti")
    star = stage(star, "star")
    similar = verified(texts, spec, levels, star)
    drop_read_shuffles(docs.sparkSession)
    gone = similar.select(*a).toDF(*ids).distinct()

    fields += spec.parity
    rows = lists.select("key", *fields)
    left = as_side(rows.join(gone.union(copies), ids, "left_anti"), "a", fields)
    rest = left.join(as_side(rows, "b", fields), "key")
    rest = rest.where(node("a", ids) > node("b", ids)).where(may_be_similar(spec.percent))
    rest = rest.where(signatures_allow(spec.percent, spec.parity))
    rest = rest.select(*a, *b).distinct().join(star, [*a, *b], "left_anti")
    rest = stage(rest, "rest")
    drop_read_shuffles(docs.sparkSession)
    more = verified(texts, spec, levels, rest)
    found = copies.union(gone).union(more.select(*a).toDF(*ids)).distinct()
    found = stage(found, "repeated")
    release(copies, lists, star, similar, rest, more)
    return found


def remove_repeated_lines(
    docs: DataFrame, percent: int = 80, shingle_words: int = 5, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_lines, n_removed, text): every row of ``docs`` without its repeated lines.

    A line goes if an earlier line of the corpus, by (doc_id, line number), reaches Jaccard
    ``percent`` / 100 with it over distinct ``shingle_words``-word shingles of ASCII-lower-cased
    words; a line of fewer words has its whole sequence as its only shingle. Lines are judged on
    the input: a line that goes still removes later ones.

    - A line without words is never removed. A text whose lines all go becomes empty.
    - A null text stays null and has 0 lines; an empty text has one line, which stays.
    - A row without doc_id has no place in the order; it keeps all lines and removes none.
    - Repeated rows have the same lines, none of them earlier than its equal: they are treated
      alike. Rows of one doc_id with different texts are ordered by a hash of the text.
    - The columns of ``carry`` follow; all others are ignored. An empty table gives no rows.

    Shingles are compared by 56-bit hashes and equal lines by 128-bit digests of those.
    """
    spec = SetSpec(by_line=True, percent=percent, shingle_words=shingle_words)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), *carry
    )
    marks = repeated_lines(docs, spec).groupBy("doc_id", "rh")
    marks = stage(marks.agg(F.collect_set("line_no").alias("gone")), "marks")
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = part.column("text").cast(pa.binary()).to_pylist()
            n_lines, n_removed, kept = [], [], []
            for text, gone in zip(texts, part.column("gone").to_pylist(), strict=True):
                lines = [] if text is None else text.split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    out = set(gone)
                    lines = [line for i, line in enumerate(lines) if i not in out]
                    text = b"\n".join(lines)
                n_removed.append(n_lines[-1] - len(lines))
                kept.append(text)
            columns = [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())]
            columns = [part.column("doc_id"), *columns, pa.array(kept, pa.binary()).cast("string")]
            columns += [part.column(c) for c in carry]
            yield pa.record_batch(columns, ["doc_id", "n_lines", "n_removed", "text", *carry])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    schema = ["doc_id bigint", "n_lines bigint", "n_removed bigint", "text string", *kinds]
    return with_marks(keyed(docs), marks, "gone", then=keep, schema=", ".join(schema))
