"""Collocations, spelling variants and nearest neighbours against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F
from stratamart.llm import counts, phrases, spelling, transducer
from stratamart.llm.nn_descent import Building, Searching, build, nearest, search
from stratamart.llm.phrases import collocations
from stratamart.llm.queries import queries
from stratamart.llm.spelling import Bidirectional, near_words, one_error, roots_of, spelling_variants

from tests.llm.test_edges import DOCS, rows, sort
from tests.llm.test_queries import SF_DIR

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations


def brute_collocations(texts, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in texts:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longest = Counter()
        for p in candidates:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner = p[i : i + m]
                    longest[inner] = max(longest[inner], f[p])
        found = []
        for p in candidates:
            if 100 * longest[p] >= 80 * f[p]:
                continue
            cuts = [(2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((" ".join(p), f[p], f[p[:k]], f[p[k:]], score))
        found.sort(key=lambda r: (-r[4], -r[1], r[0].encode()))
        for rank, (phrase, a, left, right, score) in enumerate(found[:top], 1):
            out.append((lang, rank, phrase, a, left, right, totals[lang], score))
    return out


def frame_of(spark, texts):
    return spark.createDataFrame(texts, "text string, lang string").repartition(3)


def test_op11_on_a_whole_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute_collocations([(r["text"], r["lang"]) for r in table.collect()], 30)
    got = queries()["op11_phrase_collocations"](spark, SF_DIR).collect()
    assert sort(got) == sort(expected) and len(got) > 20


@pytest.mark.parametrize("least", [2, 3])
def test_collocations_with_many_ranges(spark, monkeypatch, least):
    """Small ranges, buffers and transducers, so that all merging takes place."""
    monkeypatch.setattr(phrases, "RANGE_BYTES", 50)
    draw = np.random.Generator(np.random.PCG64(5))
    words = ["a", "B", "b", "ab", "é", "A", "c d", "\U0001f600"]
    texts = []
    for i in range(60):
        picks = draw.integers(0, len(words), 40)
        gaps = draw.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"], 40, p=[0.6, 0.1, 0.1, *[0.04] * 5])
        texts.append(("".join(words[p] + g for p, g in zip(picks, gaps, strict=True)), [None, "x", "y", "und"][i % 4]))
    texts += [(None, "x"), ("", None), (" .,; ", "z"), texts[0], texts[0]]
    got = collocations(frame_of(spark, texts), least=least).collect()
    assert sort(got) == sort(brute_collocations(texts, least)) and len(got) > 30
    top = collocations(frame_of(spark, texts), least=least, top=3).collect()
    assert sort(top) == sort(brute_collocations(texts, least, top=3))


def test_longer_phrases_cover_shorter_ones(spark):
    texts = [("one two three four. one two", "x")] * 8 + [("three four", "x")] * 3 + [("two three", "x")] * 1
    got = collocations(frame_of(spark, texts), least=4).collect()
    assert sort(got) == sort(brute_collocations(texts, 4))
    assert {r["phrase"] for r in got} == {"one two", "three four", "one two three four"}


def test_collocations_edges(spark):
    docs = spark.createDataFrame(rows(), DOCS).select("*", F.lit(1).alias("n"), F.lit(2).alias("rank"))
    expected = brute_collocations([(r[1], r[2]) for r in rows()], 3)
    assert sort(collocations(docs, least=3).collect()) == sort(expected)
    assert collocations(docs.limit(0)).collect() == []


def test_scores_beyond_64_bits():
    a = np.array([1 << 45, 3, 1 << 41])
    assert phrases._cut_scores(a, a * 2, a).tolist() == [666_666] * 3
    assert phrases._cut_scores(np.array([7]), np.array([9]), np.array([11])).tolist() == [700_000]


def random_sequences(seed, n=4000, values=40):
    draw = np.random.Generator(np.random.PCG64(seed))
    words = draw.integers(0, values, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    longest = np.minimum(draw.integers(0, 5, n), n - np.arange(n)).astype(np.int8)
    counts = Counter()
    for i in range(n):
        for m in range(1, int(longest[i]) + 1):
            counts[tuple(words[i : i + m].tolist())] += 1
    return words, longest, counts


def as_counter(levels):
    out = Counter()
    for m in range(1, len(levels) + 1):
        for path, weight in zip(transducer.paths_of(levels, m), levels[m - 1].weight, strict=True):
            if weight:
                out[tuple(path.tolist())] += int(weight)
    return out


def test_transducers_count_pack_unite_and_cut():
    words, longest, expected = random_sequences(1)
    levels = transducer.counted(words, longest, 4)
    assert as_counter(levels) == expected
    assert as_counter(transducer.unpacked(transducer.packed(levels))) == expected
    other_words, other_longest, more = random_sequences(2, values=30)
    other = transducer.counted(other_words, other_longest, 4)
    assert as_counter(transducer.union([levels, other])) == expected + more
    parts = dict(transducer.cut(levels, 7))
    assert len(parts) > 3
    whole = Counter()
    for part in parts.values():
        whole += as_counter(transducer.unpacked(transducer.packed(part)))
    assert whole == expected
    kept = transducer.pruned(levels, 5)
    assert as_counter(kept) == Counter({p: n for p, n in expected.items() if n >= 5})
    answer, met = transducer.composed(other, levels)
    assert as_counter(answer) == Counter({p: expected[p] for p in more if expected[p]})
    assert [len(m) for m in met] == [len(v) for v in other]


def test_counts_are_handed_on_bit_by_bit(monkeypatch):
    """A task whose sketches drop nothing hands on small batches; they were one."""
    monkeypatch.setattr(phrases, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(phrases, "HANDED", 50_000, raising=False)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 2000)) for _ in range(20)]
    part = pa.record_batch([pa.array(texts), pa.array(["en"] * 20)], ["text", "lang"])
    every = SimpleNamespace(value=np.full(1 << 13, 255, np.uint8))
    batches = list(phrases._shards(every, every, 50)(iter([part])))
    own = [x.filter(pa.compute.equal(x["kind"], phrases.AUTOMATON)) for x in batches]
    largest = max(len(y) for x in own for y in x["states"].to_pylist())
    sizes = [sum(map(len, x["states"].to_pylist())) for x in own]
    assert len(sizes) > 10 and max(sizes) <= 50_000 + largest < sum(sizes) / 5
    whole = phrases._united(y for x in own for y in x["states"].to_pylist())
    assert [int(v.weight.sum()) for v in whole] == [40_000, 39_980, 39_960, 39_940]


def test_bits_of_counters(spark):
    frame = spark.range(3000).repartition(3)

    def hashes(batches):
        for part in batches:
            yield part.column("id").to_numpy().astype(np.uint64) ** 2 % 97

    cells = counts.merged_counts(frame, hashes, 128)
    for least in (1, 31, 62):
        bits = counts.merged_counts(frame, hashes, 128, least=least)
        assert bits.nbytes == 16
        assert (counts.has_bit(bits, np.arange(128, dtype=np.uint64)) == (cells >= least)).all()
    assert len(np.unique(cells)) > 2


def test_minimal_transducers_share_their_ends():
    """Thousands of first words with the same continuations need the arcs of one."""
    n = 3000
    words = np.column_stack([np.arange(10, n + 10), np.full(n, 1), np.full(n, 2)]).astype(np.uint64)
    levels = transducer.sequences(words, np.full(n, 3), np.full(n, 7), 3)
    raw = 24 * transducer.size(levels)
    assert len(transducer.packed(levels)) < raw / 10
    assert as_counter(transducer.unpacked(transducer.packed(levels))) == as_counter(levels)


def test_empty_transducer():
    levels = transducer.counted(np.empty(0, np.uint64), np.empty(0, np.int8), 4)
    assert transducer.size(transducer.unpacked(transducer.packed(levels))) == 0


# Spelling variants


def variants_of(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out.update(word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out.update(word[:i] + c + word[i + 1 :] for c in letters)
    return out - {word}


def brute_variants(texts, least_length=6, least_count=5, factor=5):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    letters = sorted({c for w in n for c in w})
    near = {w: [v for v in variants_of(w, letters) if v in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def test_op12_on_a_whole_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    expected = brute_variants([tuple(r) for r in table.collect()])
    got = queries()["op12_spelling_variants"](spark, SF_DIR).collect()
    assert sort(got) == sort(expected) and any(r["form"] for r in got)


def test_variants_edges(spark):
    base = rows() + [(20, "colour Colour COLOUR colour colour " * 30 + "color colôr cölour " * 6, "en", "a", 1)]
    base += [(21, "colour×x Ācolourx coloür " * 9, "en", "a", 1), (22, "ab" * 150 + " " + "ab" * 149 + "a", "x", "y", 1)]
    docs = spark.createDataFrame(base, DOCS).select("*", F.lit(1).alias("n"), F.lit("w").alias("word"))
    expected = brute_variants([(r[0], r[1]) for r in base], 5, 1, 2)
    assert sort(spelling_variants(docs, 5, 1, 2).collect()) == sort(expected)
    assert spelling_variants(docs.limit(0)).collect() == []


def test_very_long_words(spark):
    long = "ab" * 20_000
    words = {"colour": 9, long: 2, long[:-1]: 3, long[:777] + "x" + long[777:]: 4, long[1:] + "c": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {(r["word"], r["near"]) for r in near_words(frame).collect()}
    other = {(long[:-1], long), (long[:777] + "x" + long[777:], long)}
    assert got == other | {(b, a) for a, b in other}


def test_hot_halves_are_split(spark, monkeypatch):
    """A third of the words share their first half, and indexes and visits are tiny."""
    monkeypatch.setattr(spelling, "INDEX_WORDS", 16)
    monkeypatch.setattr(spelling, "SEARCHES", 8)
    draw = np.random.Generator(np.random.PCG64(3))
    words = {"".join(draw.choice(list("abc"), draw.integers(6, 9))) for _ in range(400)}
    words |= {"hothot" + "".join(draw.choice(list("abc"), draw.integers(4, 7))) for _ in range(300)}
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = {(r["word"], r["near"]) for r in near_words(frame).collect()}
    assert got == {(w, v) for w in words for v in variants_of(w, "abchot") if v in words}


@pytest.mark.parametrize("seed", range(5))
def test_search_in_the_index(seed):
    draw = np.random.Generator(np.random.PCG64(seed))
    letters = [b"ab", b"abc\xe9", b"a"][seed % 3]
    words = sorted({bytes(draw.choice(list(letters), draw.integers(1, 12)).tolist()) for _ in range(200)})
    queries_ = words + [b"", b"zz", b"aaaaaaaaaaaaaaaaa"]
    index = Bidirectional(words)
    pairs = set()
    for first in (True, False):
        found = one_error(index, queries_, np.full(len(queries_), first))
        pairs |= {(queries_[q], words[w]) for q, w in found.tolist()}
    text = [w.decode("latin-1") for w in words]
    expected = set()
    for q in queries_:
        near = variants_of(q.decode("latin-1"), letters.decode("latin-1"))
        expected |= {(q, w.encode("latin-1")) for w in text if w in near}
    assert pairs == expected


def test_long_chains_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(13)]
    got = roots_of(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in got} == {f"w{i}": "w13" for i in range(13)}


# Nearest neighbours


def brute_nearest(vectors, k=10):
    """By vec_id: (rank, vec_id, distance), of rows that take part."""
    usable = [(i, v) for i, v in vectors if i is not None and v and None not in v]
    usable = [(i, v) for i, v in usable if all(map(math.isfinite, v)) and any(v)]
    out = {}
    for q in sorted({i for i, _ in usable if i % 100 == 0}):
        far = {}
        for own in (v for i, v in usable if i == q):
            for i, v in usable:
                if i != q and len(v) == len(own):
                    far[i] = min(far.get(i, math.inf), math.dist(own, v))
        best = sorted(far.items(), key=lambda x: (x[1], x[0]))[:k]
        out[q] = [(rank, i, d) for rank, (i, d) in enumerate(best, 1)]
    return out


def results(found):
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return out


def wanted():
    return F.col("vec_id") % 100 == 0


@pytest.mark.parametrize("folder", [SF_DIR, SF_DIR.replace("sf0.001", "sf0.1")])
def test_op13_recall(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    expected = brute_nearest([tuple(r) for r in table])
    got = results(queries()["op13_nn_descent_search"](spark, folder).collect())
    assert got.keys() == expected.keys()
    hits, total = 0, 0
    for q, best in expected.items():
        hits += len({i for _, i, _ in best} & {i for _, i, _ in got[q]})
        total += len(best)
        exact = {i: d for _, i, d in brute_nearest([tuple(r) for r in table if r["vec_id"] == q or r["vec_id"] in {x[1] for x in got[q]}])[q]}
        assert [(i, pytest.approx(d, rel=1e-12)) for _, i, d in got[q]] == [(i, exact[i]) for _, i, _ in got[q]]
        assert [x[0] for x in got[q]] == list(range(1, len(best) + 1))
    assert hits / total >= 0.9


def test_neighbours_edges_are_exact_on_small_tables(spark):
    draw = np.random.Generator(np.random.PCG64(9))
    vectors = [(i, draw.normal(size=3).tolist()) for i in range(0, 700, 7)]
    vectors += [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [math.nan, 1.0, 1.0])]
    vectors += [(6, [math.inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (800, [1.0, 2.0]), (801, [1.0, 3.0]), (900, [5.0])]
    vectors += [(1000 + i, [0.25, -0.0, 0.5]) for i in range(40)]  # copies; 1000 is one of them
    vectors += [(-100, [0.25, 0.0, 0.5]), (8, [1e200, -1e200, 1e200]), (100_000, [1e-200, 0.0, 1e-200])]
    vectors += vectors[:3] + [(700, [0.25, 0.1, 0.5]), (700, [3.0, 3.0, 3.0])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    frame = frame.select("*", F.lit(1).alias("label"), F.lit(2).alias("node"), F.lit(3).alias("dim"))
    got = results(nearest(frame, wanted()).collect())
    expected = {q: best for q, best in brute_nearest(vectors).items() if best}
    assert got.keys() == expected.keys()
    for q, best in expected.items():
        assert [(r, i) for r, i, _ in got[q]] == [(r, i) for r, i, _ in best]
        assert [d for *_, d in got[q]] == pytest.approx([d for *_, d in best], rel=1e-12)
    assert [i for _, i, _ in got[1000]][:3] == [-100, 1001, 1002]
    assert nearest(frame.limit(0), wanted()).collect() == []


def test_graph_rounds_improve_the_graph(spark):
    draw = np.random.Generator(np.random.PCG64(4))
    points = draw.normal(size=(3000, 8))
    frame = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>"
    )
    square = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(square, np.inf)
    true = np.argsort(square, axis=1)[:, :10]

    def recall(rounds):
        graph = build(frame, Building(neighbours=16, partitions=1, rounds=rounds))
        ids = {r["node"]: r["vec_id"] for r in graph.copies.collect()}
        near = {ids[r["node"]]: {ids[x] for x in r["near"]} for r in graph.edges.collect()}
        return np.mean([len(near.get(i, set()) & set(true[i].tolist())) / 10 for i in range(3000)]), graph

    before, _ = recall(0)
    after, graph = recall(12)
    assert before < 0.7 and after > 0.95
    some = graph.copies.where("vec_id % 500 = 3").select("node").join(graph.nodes, "node")
    found = search(graph, some, Searching(width=32, opened=8, entries=64)).groupBy("query").count()
    assert {r["count"] for r in found.collect()} == {32}
