"""Similarity join of whole texts by Jaccard over word shingles: a size-aware heavy-light join.

Small (light) sets are found by enumerating the two-token subsets of their prefix; two light sets
that reach the similarity have one in common, and such keys are far rarer than single tokens. Large
(heavy) sets scan the inverted lists of the single tokens of their prefix, in which light sets just
below the boundary are listed too. The boundary is the size at which the estimated cost of
enumerating passes that of scanning.

Sets that are equal are one class, represented by its smallest doc_id. Linking works in two rounds:

1. In every list, each set is verified against the one of its size band that has most equal copies,
   then the smallest doc_id. This links large groups of near copies, which mostly stem from a text
   that is itself copied often, by as many pairs as the lists have rows.
2. Every remaining pair of a list whose sets are not connected yet, and that passes the length,
   positional and parity filters, is verified. Pairs inside a component need no check: it would not change.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.graph import connected_components
from stratamart.llm.setjoin import (
    ListKeys,
    SetSpec,
    as_side,
    frequency_levels,
    may_be_similar,
    overlap,
    plausible,
    postings,
    set_input,
    signatures,
    signatures_allow,
    size_band,
    verified,
)
from stratamart.llm.staging import release, stage

#: Largest set that may count as light.
MOST_LIGHT = 64


def choose_boundary(sizes: list[tuple[int, int, float]], percent: int) -> int:
    """The size up to which subsets are enumerated, from (size, sets, estimated scanning cost).

    Enumerating costs one key per subset. Light sets that heavy ones can reach are listed by
    single tokens as well, and cost both.
    """
    table = {n: (sets, scan) for n, sets, scan in sizes if 0 < n <= MOST_LIGHT}

    def subsets(n: int) -> int:
        prefix = n - int(overlap(np.asarray(n), percent)) + 2
        return prefix * (prefix - 1) // 2

    def cost(boundary: int) -> float:
        listed = int(overlap(np.asarray(boundary + 1), percent))
        enumerated = sum(sets * subsets(n) for n, (sets, _) in table.items() if n <= boundary)
        return enumerated + sum(scan for n, (_, scan) in table.items() if n >= listed)

    return min(range(MOST_LIGHT + 1), key=cost)


def near_copies(docs: DataFrame, percent: int = 80, shingle_words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Two rows link when ``100 * |A & B| >= percent * |A | B|`` over their sets of distinct shingles
    of ASCII-lower-cased words; a text of fewer words has its whole sequence as its only shingle.
    component_id is the smallest doc_id reachable by links, the row's own included.

    - A null or empty text, or one of white space only, has no shingles and links with nothing.
    - A row without doc_id links with nothing; its component_id is null.
    - Rows that share a doc_id are one node: linked with what any of them links with.
    - Columns other than doc_id and text are ignored. An empty table gives no rows.
    - Long texts are hashed in pieces; the set of one text is held in memory.

    Shingles are compared by 56-bit hashes and equal sets by 128-bit digests of those.
    """
    spec = SetSpec(percent=percent, shingle_words=shingle_words)
    texts = set_input(docs, spec)
    levels = frequency_levels(texts, spec)
    signed = stage(signatures(texts, spec, levels, MOST_LIGHT, wide=True), "signatures")
    some = signed.where("n > 0")
    sizes = some.where(F.col("n") <= MOST_LIGHT).groupBy("n")
    sizes = sizes.agg(F.count(F.lit(1)), F.sum("cost")).collect()  # at most MOST_LIGHT rows
    keys = ListKeys(percent, choose_boundary([tuple(r) for r in sizes], percent))

    classes = some.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies")
    )
    heads = classes.groupBy(F.col("head").alias("doc_id")).agg(F.max("copies").alias("copies"))
    heads = stage(heads, "heads")
    lists = stage(postings(some, spec, keys, only=heads).join(heads, "doc_id"), "lists")

    lists = lists.withColumn("band", size_band())
    first = lists.groupBy("key", "band").agg(
        F.min(F.struct(-F.col("copies"), "doc_id", "n", "place")).alias("f"),
        F.count(F.lit(1)).alias("rows"),
    )
    first = first.where("rows > 1").select(
        "key", "band", "f.doc_id", F.col("f.n").alias("b_n"), F.col("f.place").alias("b_place")
    )
    first = first.withColumnRenamed("doc_id", "b_doc_id")
    side_a = as_side(lists.drop("copies"), "a", ["doc_id", "n", "place"])
    star = side_a.join(first, ["key", "band"]).where("a_doc_id <> b_doc_id")
    star = stage(
        star.where(may_be_similar(percent)).select("a_doc_id", "b_doc_id").distinct(), "star"
    )
    likely = plausible(some, star, percent)
    linked = verified(texts, spec, levels, likely)
    release(likely)

    parts = connected_components(linked, "a_doc_id", "b_doc_id")
    parts = stage(parts.withColumnRenamed("node", "doc_id"), "parts")
    placed = lists.join(parts, "doc_id", "left")
    placed = placed.withColumn("part", F.coalesce("component", "doc_id")).drop("component")
    open_keys = placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    placed = placed.join(open_keys.where("lo < hi").select("key"), "key", "left_semi")
    placed = placed.select("key", "doc_id", "n", "place", "part")
    # Rows of one doc_id with different texts have no common signature.
    alike = [F.when(F.min(c) == F.max(c), F.min(c)).alias(c) for c in spec.parity]
    parity = some.groupBy("doc_id").agg(*alike)
    placed = stage(placed.join(parity, "doc_id"), "open")
    names = ["doc_id", "n", "place", "part", *spec.parity]
    rest = as_side(placed, "a", names).join(as_side(placed, "b", names), "key")
    rest = rest.where("a_part < b_part").where(may_be_similar(percent))
    rest = rest.where(signatures_allow(percent, spec.parity))
    rest = rest.select("a_doc_id", "b_doc_id").distinct()
    tested = star.select(F.greatest("a_doc_id", "b_doc_id"), F.least("a_doc_id", "b_doc_id"))
    tested = tested.toDF("hi", "lo")
    seen = (F.greatest("a_doc_id", "b_doc_id") == F.col("hi")) & (
        F.least("a_doc_id", "b_doc_id") == F.col("lo")
    )
    rest = stage(rest.join(tested, seen, "left_anti"), "rest")
    likely = plausible(some, rest, percent)
    more = verified(texts, spec, levels, likely)
    release(likely)

    copies = some.join(classes, ["d1", "d2"]).where("doc_id <> head")
    links = linked.union(more).union(copies.select("doc_id", "head"))
    component = connected_components(links, "a_doc_id", "b_doc_id")
    release(heads, lists, star, parts, placed, rest, linked, more)
    counted = signed.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    named = counted.join(component, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    nameless = docs.where("doc_id is null").select(F.lit(0).alias("doc_id"), "text")
    nameless = signatures(set_input(nameless, spec), spec, levels)
    null = F.lit(None).cast("long")
    return named.union(nameless.select(null, F.col("n").cast("long"), null))
