"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""

from __future__ import annotations

import hashlib
import shutil
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from stratamart.llm import embedding_dedup, jaccard_join, line_dedup, setjoin, text
from stratamart.llm.graph import connected_components
from stratamart.llm.host_rules import judge_by_host, shrunk_rates
from stratamart.llm.jaccard_join import choose_boundary, near_copies
from stratamart.llm.language_id import identify_languages
from stratamart.llm.line_dedup import remove_repeated_lines
from stratamart.llm.mixing import Mix, fit_rates, log_totals, rate_documents
from stratamart.llm.packing import SumOfSquares, Piece, WordEncoder, pack
from stratamart.llm.quality_cotrain import score_quality
from stratamart.llm.queries import TOKENIZER_FILE
from stratamart.llm.secret_scan import find_secrets, secret_digests
from stratamart.llm.staging import stage
from stratamart.llm.substring_dedup import remove_repeated_passages

from tests.llm import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"x{i % 977}" for i in range(120_000))


def rows():
    """Nulls in every column, empty and blank texts, copies, repeated rows and a very long text."""
    texts = [
        (0, PASSAGE + "\nthe end of the first\n", "en", "a", 10),
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n\x0b ", "de", "b", 5),
        (4, PASSAGE, "en", "a", 9),
        (5, "before " + PASSAGE + " after", "en", "a", 9),
        (5, "before " + PASSAGE + " after", "en", "a", 9),
        (None, PASSAGE, "fr", "b", 9),
        (6, "the end of the first", "fr", None, 20),
        (7, LONG, "fr", "b", len(LONG)),
        (8, "12 34 | 56", "de", "b", 7),
        (9, "\n".join(["one same line here now"] * 3), "de", "b", 7),
        (10, "été   naïve x \U0001f600 İ", "fr", "b", 3),
    ]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    """With further columns whose names the operators use inside."""
    built = spark.createDataFrame(rows(), DOCS).repartition(3, "text")
    extra = ["rh", "key", "n", "a", "b", "gone", "first", "host", "score", "kept", "u", "v"]
    return built.select("*", *[F.lit(1).alias(c) for c in extra])


@pytest.fixture(scope="module")
def labels(spark):
    data = [(0, 1, 0), (4, 1, 0), (3, 0, 0), (8, 0, None), (None, 1, 0), (7, None, 1)]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def sort(found):
    return sorted(map(tuple, found), key=lambda r: [(x is None, str(type(x)), x) for x in r])


def plain():
    return [(r[0], r[1]) for r in rows()]


def test_jaccard_join(docs, nothing):
    assert sort(near_copies(docs).collect()) == sort(brute.jaccard_groups(plain()))
    assert near_copies(nothing).collect() == []


def test_boundary_follows_cost():
    assert choose_boundary([], 80) == 0
    assert choose_boundary([(10, 100, 1e9)], 80) >= 10
    assert choose_boundary([(10, 10**6, 1.0)], 80) < 10


def test_near_copies_below_and_at_the_threshold(spark):
    """Sizes from tiny to large, shared parts just at and just below 80 %."""
    texts, at = [], 0
    for size in (4, 5, 9, 10, 18, 40, 90, 300):
        words = [f"s{size}w{i}" for i in range(size + 4)]
        texts.append((at, " ".join(words)))
        for cut in range(0, 6):
            texts.append((at + 1 + cut, " ".join([*words[cut:], *(f"z{size}{i}" for i in range(cut))])))
        at += 10
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sort(near_copies(frame).collect()) == sort(brute.jaccard_groups(texts))


@pytest.mark.parametrize("boundary", [0, 2, 4])
def test_near_copies_that_share_one_token(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda sizes, percent: boundary)
    texts = ["x", "x y", "p q", "p q r s", "r s t", "m n o", "m u v w"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_copies(frame, percent=50, shingle_words=1).collect()
    groups = {r["doc_id"]: r["component_id"] for r in found}
    # r s t and p q r s share two of five tokens.
    assert groups == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6}


def test_only_plausible_pairs_are_compared_by_whole_sets(spark, monkeypatch):
    """Long texts that share a rare passage: too many tokens for signatures of fixed size."""
    word = lambda i, j: f"w{i}x{j}"
    texts = []
    for i in range(12):
        own = [word(i, j) for j in range(900 + 20 * i)]
        texts += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own[:-5], "end"]))]
    shared = " ".join(f"rare{j}" for j in range(6))
    texts = [(i, f"{text} {shared}") for i, text in texts]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    compared = []

    def spied(docs, spec, levels, pairs):
        compared.extend((r["a_doc_id"], r["b_doc_id"]) for r in pairs.collect())
        return setjoin.verified(docs, spec, levels, pairs)

    monkeypatch.setattr(jaccard_join, "verified", spied)
    assert sort(near_copies(frame).collect()) == sort(brute.jaccard_groups(texts))
    assert compared
    assert all(a // 2 == b // 2 for a, b in compared)


def test_lists_take_one_python_worker_a_task(spark, docs, monkeypatch):
    """Two in a row keep twice the workers, whose memory stays beside later steps."""
    plans = []

    def looking(df, purpose, write=jaccard_join.stage):
        if purpose == "lists":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, purpose)

    monkeypatch.setattr(jaccard_join, "stage", looking)
    near_copies(docs)
    assert [plan.count("MapInArrow") for plan in plans] == [1]


def test_free_memory_goes_back():
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    if text._TRIM is None:
        pytest.skip("another C library")
    blocks = [np.ones(8000) for _ in range(2000)]  # 128 MB in blocks that the C library keeps
    last = np.ones(8000)
    before = resident()
    del blocks
    text.give_back()
    assert before - resident() > 100_000_000
    assert len(last) == 8000


def test_wide_signatures_never_exceed_the_difference():
    random = np.random.default_rng(5)
    for m, n in ((3, 4), (63, 65), (120, 140), (1000, 1100), (4000, 4200)):
        tokens = np.unique(random.integers(0, 1 << 63, m + n, dtype=np.uint64))
        one, other = tokens[:m], tokens[m // 2 : m // 2 + n]
        bounds = np.cumsum([0, len(one), len(other)])
        batch = setjoin.SetBatch([], np.concatenate([one, other]), bounds)
        runs, at = setjoin.binary_runs(setjoin._wide_parity(batch))
        differ = setjoin._differ(runs[at[0] : at[1]], runs[at[1] : at[2]])
        true = len(np.setxor1d(one, other))
        assert true / 4 < differ <= true


def test_line_dedup(docs, nothing):
    distinct = list(dict.fromkeys(plain()))
    expected = {r[0]: r for r in brute.kept_lines([d for d in distinct if d[0] is not None])}
    found = remove_repeated_lines(docs, carry=("lang",)).collect()
    assert len(found) == len(rows())
    for r in found:
        if r["doc_id"] is None:
            assert (r["n_removed"], r["text"]) == (0, PASSAGE)
        else:
            assert (r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) == expected[r["doc_id"]]
    assert remove_repeated_lines(nothing).collect() == []


def test_near_lines(spark):
    line = [f"l{i}" for i in range(40)]
    texts = [(i, "\n".join([" ".join([f"c{i}", *line[i:]]), f"own line {i} of mine alone"])) for i in range(8)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sort(remove_repeated_lines(frame).collect()) == sort(brute.kept_lines(texts))


def test_copies_of_a_line_make_no_lists(spark, monkeypatch):
    """A key that only one head and its copies have compares nothing, so it is not listed."""
    listed = []

    def counting(df, purpose, write=line_dedup.stage):
        written = write(df, purpose)
        if purpose == "lists":
            listed.append(written.count())
        return written

    monkeypatch.setattr(line_dedup, "stage", counting)
    line = " ".join(f"c{i}" for i in range(40))
    near = " ".join(f"n{i}" for i in range(100))
    copies = spark.createDataFrame([(i, line, None, None, 0) for i in range(20)], DOCS)
    found = remove_repeated_lines(copies).agg(F.sum("n_removed")).first()[0]
    assert (found, listed) == (19, [0])
    rows = [(50, near, None, None, 0), (51, near + " more", None, None, 0)]
    both = copies.union(spark.createDataFrame(rows, DOCS))
    gone = remove_repeated_lines(both).where("n_removed > 0").select("doc_id").collect()
    assert sorted(r[0] for r in gone) == [*range(1, 20), 51]
    assert listed[1] > 0


def test_only_asked_lines_are_hashed():
    """Sets of lines are made again from the lines of the pairs, not from whole documents."""
    spec = setjoin.SetSpec(by_line=True)
    texts = ["a b c d e f\n\n  A b c d e g \nlast", None, "", "x\n", "one two one two one two one two\n" * 4]
    columns = [pa.array([3, 4, 5, 6, 7]), pa.array([30, 40, 50, 60, 70]), pa.array(texts)]
    batch = pa.record_batch(columns, ["doc_id", "rh", "text"])
    asked = [(3, 30, 2), (4, 40, 0), (6, 60, 1), (7, 70, 1), (7, 70, 3), (7, 71, 0)]
    present = np.zeros(1 << 17, dtype=np.uint8)
    hashes = setjoin._node_hash([np.array(c) for c in zip(*asked)])
    for cells in setjoin.counts.two_cells(hashes, 8 * len(present)):
        setjoin.counts._set(present, np.sort(cells))
    lines = list(setjoin._lines_among(iter([batch]), present))
    found = {(r["doc_id"], r["rh"], r["line_no"]): r["text"] for b in lines for r in b.to_pylist()}
    assert {k: v.strip(b"\n") for k, v in found.items()} == {
        k: (texts[k[0] - 3] or "").split("\n")[k[2]].encode() for k in asked[:-1]
    }
    levels = np.zeros(1 << 16, dtype=np.uint8)

    def sets(batches):
        made = {}
        for s in setjoin.sets_of(batches, spec, levels):
            for i, key in enumerate(zip(*(c.tolist() for c in s.ids))):
                made[key] = s.tokens[s.bounds[i] : s.bounds[i + 1]].tolist()
        return made

    whole, some = sets(iter([batch])), sets(iter(lines))
    assert some == {k: whole[k] for k in asked[:-1]}
    assert all(v == sorted(set(v)) for v in whole.values()) and len(some[7, 70, 3]) == 2


def test_passages(docs, nothing):
    assert sort(remove_repeated_passages(docs).collect()) == sort(brute.kept_passages(plain()))
    assert remove_repeated_passages(nothing).collect() == []


def test_packing(docs, nothing):
    found = pack(docs, TOKENIZER_FILE).collect()
    ids = {}
    for r in found:
        ids.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    total = 0
    for parts in ids.values():
        at = 0
        for offset, length, packed in sorted(parts):
            assert offset == at and len(packed) == 4 * length
            at += length
        assert at <= 2048 and at & (at - 1) == 0
        total += at
    encode = WordEncoder(TOKENIZER_FILE).encode
    assert total == sum(len(encode([(t or "").encode()])[0]) // 4 + 1 for _, t in plain())
    assert sum(r["doc_id"] == 5 and r["start"] == 0 for r in found) == 2
    assert pack(nothing, TOKENIZER_FILE).collect() == []


def test_words_are_tokenised_as_in_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    odd = [
        "İstanbul Größe ǅ ß ẞ ª ² ½x5 \u0085b T̈ K \x1cA\x1db",
        "<|endoftext|> <|ENDOFTEXT|>X x<|startoftext|>y 日本語 ΟΔΟΣ ﬁ",
        "don'T WE'RE 'S' it''s ­soft\tx\n\ny 12,5",
    ]
    encoder = WordEncoder(TOKENIZER_FILE)
    for text in odd:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text.encode()]) == [np.array(ids, dtype="<u4").tobytes()]


def test_new_pieces_are_tokenised_as_long_texts(monkeypatch):
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self):
            self.texts = 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    words = [f"é{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}'s,{i}" for i in range(3000)]
    text = " ".join(words)
    expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    encoder = WordEncoder(TOKENIZER_FILE)
    encoder._tokenizer = Counting()
    assert encoder.encode([text.encode()]) == [expected]
    assert 0 < encoder._tokenizer.texts < 20
    # Where the marks of the last tokens do not fit the pieces, each piece is a text.
    encoder.forget()
    encoder._last = ~encoder._last
    assert encoder.encode([text.encode()]) == [expected]


def test_the_pipeline_leaves_no_words_in_its_workers(spark, docs, tmp_path, monkeypatch):
    """Python workers live on; what packing remembers would stay beside the steps that follow."""
    own = str(shutil.copy(TOKENIZER_FILE, tmp_path))  # known to no worker of earlier tests

    def remembered(batches):
        from stratamart.llm.packing import _ENCODERS

        words = sum(batch.num_rows for batch in batches) and 0
        if own in _ENCODERS:
            words = len(_ENCODERS[own]._known)
        yield pa.record_batch([pa.array([words], pa.int32())], ["words"])

    def most():
        frame = spark.range(0, 64, 1, 16).mapInArrow(remembered, "words int")
        return frame.agg(F.max("words")).first()[0]

    monkeypatch.setattr(corpus_pipeline.public_tokenizers, "path", lambda name: own)
    parts = docs.repartition(16)
    found = sort(corpus_pipeline.packing(spark, parts, "").select("doc_id", "length", "ids").collect())
    assert most() == 0
    kept = pack(parts, own).select("doc_id", "length", "ids").collect()
    assert most() > 0
    assert sort(kept) == found


def test_sum_of_squares_prefers_the_level_that_evens_out():
    packer = SumOfSquares(10)
    for i in range(3):
        assert list(packer.place(Piece((i, 0), 0, 7, b"\0" * 28))) == []
    (full,) = packer.place(Piece((9, 0), 0, 3, b"\0" * 12))
    assert full.fill == 10 and packer.levels[7] == 2
    assert sum(s.fill for s in packer.finish()) == 14


def test_secrets(spark, docs, nothing):
    key = "AKIA" + "ABCDEFGH12345678"
    blob = "q7Zp2Lx9Vb4Ks8Wd1Tn6Yc3Rf5Hg0Jm"
    texts = [
        (1, f"token: secret: abcdefghijkl {key} Password='hunter2hunter2'"),
        (2, f"\U0001f600 x {'0123456789abcdef' * 2} y {blob} z"),
        (3, "api_key=short 123e4567-e89b-12d3-a456-426614174000 2024-01-01-2024-01-02-03"),
        (4, None),
        (5, ""),
        (5, ""),
        (None, "token=abcdefgh"),
    ]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in secret_digests(find_secrets(frame)).collect()}
    for i, text in texts:
        assert found[i]["base_sha256"] == brute.base_sha256(text)
    at = texts[1][1].index(blob)
    assert f"entropy:{at}:{at + len(blob)}" in found[2]["spans"]
    assert "entropy" not in found[3]["spans"] and found[4]["spans"] == ""
    assert brute.largest_entropy(blob) >= 3.8
    assert secret_digests(find_secrets(docs)).count() == len(rows())
    assert find_secrets(nothing).collect() == []


def test_secrets_of_letters_late_digits_and_beside_base_spans(spark):
    letters = "qZpLxVbKsWdTnYcRfHgJmQaXuEoIvNkB"
    mixed = "q7Zp2Lx9Vb4Ks8Wd1Tn6Yc3Rf5Hg0Jm"
    late = "qZpLxVbKsWdTnYcRfHgJm" * 11 + "7"
    assigned = "token=abcdefgh"
    texts = [
        (1, f"the key {letters} here", [letters]),
        (2, f"{late}", [late]),
        (3, f"{mixed}_{assigned}", [mixed]),
        (4, f"x {mixed}={assigned} {letters}-{assigned}", [mixed, letters]),
        (5, f"{mixed}AKIA{'Q' * 12}/{letters}", [mixed, "/" + letters]),
        (6, f"\U0001f600 {assigned}.{mixed} {mixed[:12]}_{assigned}", []),
        (7, "Donaudampfschifffahrtsgesellschaft Geschwindigkeitsbegrenzung state-of-the-art-technology", []),
    ]
    frame = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in find_secrets(frame).collect()}
    for i, text, keys in texts:
        extra = found[i]["extra"]
        assert [s["match"] for s in extra] == keys
        for s in extra:
            assert text[s["start"] : s["stop"]] == s["match"]
            assert all(s["stop"] <= b["start"] or b["stop"] <= s["start"] for b in found[i]["base"])


def test_host_rules(docs, nothing):
    found = judge_by_host(docs).collect()
    assert len(found) == len(rows())
    expected = {i: brute.rule_measures(t) for i, t in plain()}
    for r in found:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == expected[r["doc_id"]]
        assert r["host"] is not None or not r["host_failed"]
    assert judge_by_host(nothing).collect() == []


def test_rates_shrink_towards_the_common_rate(spark):
    hosts = spark.createDataFrame(
        [("a", 1, 1), ("b", 1000, 900), ("c", 1000, 10), ("d", 10, 1)], "host string, n bigint, r bigint"
    )
    rates = {r["host"]: r["rate_r"] for r in shrunk_rates(hosts, ["r"]).collect()}
    assert rates["a"] < 1 and rates["a"] > 0.5
    assert abs(rates["b"] - 0.9) < 0.01 and rates["c"] < 0.02


def test_hosts_of_one_document_get_the_common_rate(spark):
    """They tell nothing about how hosts differ, so nothing but noise is left."""
    hosts = spark.createDataFrame([(f"h{i}", 1, int(i < 3)) for i in range(10)], "host string, n bigint, r bigint")
    assert {round(r["rate_r"], 12) for r in shrunk_rates(hosts, ["r"]).collect()} == {0.3}


def test_rates_by_beta_binomial_moments(spark):
    counts = [(40, 22), (60, 15), (50, 20), (200, 50), (10, 4)]
    hosts = spark.createDataFrame([(f"h{i}", n, x) for i, (n, x) in enumerate(counts)], "host string, n bigint, r bigint")
    total, p = sum(n for n, _ in counts), sum(x for _, x in counts) / sum(n for n, _ in counts)
    spread = sum(n * (x / n - p) ** 2 for n, x in counts)
    room = total - sum(n * n for n, _ in counts) / total - (len(counts) - 1)
    alike = (spread / (p * (1 - p)) - (len(counts) - 1)) / room
    assert 0 < alike < 0.5
    weight = (1 - alike) / alike
    rates = {r["host"]: r["rate_r"] for r in shrunk_rates(hosts, ["r"]).collect()}
    for i, (n, x) in enumerate(counts):
        assert rates[f"h{i}"] == pytest.approx((x + p * weight) / (n + weight))


def test_documents_of_a_failing_host_go(spark):
    """Good documents of a host that mostly fails go, those of other hosts stay."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    docs = [(i, bad if i % 10 else good, "spam") for i in range(100)]
    docs += [(100 + i, good, f"fine{i % 5}") for i in range(200)] + [(300, bad, "fine0"), (301, good, "fine0")]
    found = judge_by_host(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    failed = {r["host"] for r in found if r["host_failed"]}
    assert failed == {"spam"}
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert kept == {i for i, t, h in docs if t == good and h != "spam"}


def test_languages(docs, nothing):
    found = identify_languages(docs).collect()
    assert len(found) == len(rows())
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3, 8)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in found)
    assert by_id[None]["held_out"] is False
    assert identify_languages(nothing).collect() == []


def test_no_labelled_language(docs):
    found = identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in found} == {"und"}


def test_quality(docs, labels, nothing):
    found = score_quality(docs, labels).collect()
    assert len(found) == len(rows())
    assert all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= 0.5) for r in found)
    assert score_quality(nothing, labels).collect() == []
    without = score_quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in without} == {0.5}


def test_mixing(spark, docs, nothing):
    known = spark.createDataFrame([(0, "en"), (7, "fr"), (None, "en")], "doc_id bigint, domain string")
    mix = Mix({"en": 0.5, "fr": 0.5})
    found = rate_documents(docs, known, mix).collect()
    assert len(found) == len(rows())
    assert all(r["rate"] >= 0 for r in found)
    assert sum(r["n_tokens"] for r in found) == sum(len(brute.words(t)) for _, t in plain())
    assert rate_documents(nothing, known, mix).collect() == []
    alike = rate_documents(docs, known.limit(0), mix).collect()
    assert {round(r["chance"], 9) for r in alike} == {0.5}


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = [rng.normal(size=8) for _ in range(12)]
    data = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    data += [(20 + i, [float(x) for x in 3 * v + 0.05 * rng.normal(size=8)], i % 2) for i, v in enumerate(base)]
    data += [(40, data[0][1], 0), (41, data[0][1], 0), (41, data[0][1], 0), (42, data[0][1], 1)]
    data += [
        (50, None, 0),
        (51, [], 0),
        (52, [0.0] * 8, 0),
        (53, [float("nan")] * 8, 0),
        (54, [None] + [1.0] * 7, 0),
        (55, [float("inf")] * 8, 0),
        (56, data[0][1], None),
        (None, data[0][1], 0),
        (57, [1.0, 2.0], 0),
        (58, [2.0, 4.0], 0),
        (59, [1.0], 0),
    ]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    frame = frame.withColumn("unit", F.lit("x")).withColumn("id", F.lit(1)).repartition(3)
    expected = brute.vector_links(data)
    assert sort(embedding_dedup.near_copies(frame).collect()) == sort(expected)
    assert embedding_dedup.near_copies(frame.limit(0)).collect() == []


def test_vectors_met_block_by_block(spark, monkeypatch):
    """Lists of a few vectors, so that each label has many blocks, with copies in several tasks."""
    monkeypatch.setattr(embedding_dedup, "LIST_BYTES", 2000)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 8))
    near = base[:100] + 0.05 * rng.normal(size=(100, 8))
    hot = base[0] + 0.03 * rng.normal(size=(40, 8))
    vectors = [*base, *near, *hot, *base[:30], *base[:30], *near[:10]]
    data = [(i, [float(np.float32(x)) for x in v], i % 3 // 2) for i, v in enumerate(vectors)]
    data += [(7, data[7][1], data[7][2]), (1000, data[9][1][:5], 1), (1001, data[9][1][:5], 1)]
    for kind in ("float", "double"):
        frame = spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, label int")
        got = embedding_dedup.near_copies(frame.repartition(5)).collect()
        assert sort(got) == sort(brute.vector_links(data))


def test_vectors_of_a_dense_cell():
    """Pairs verified by products and one by one give the same links and trees."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(900, 16)).astype(np.float32)
    vectors[300:] = vectors[rng.integers(0, 2, 600)] + 0.08 * rng.normal(size=(600, 16))
    listed = embedding_dedup._Side(
        np.arange(900), rng.integers(1, 4, 900), vectors, *embedding_dedup._digests(vectors)
    )
    units = embedding_dedup._unit_rows(vectors)
    mask = units @ units.T >= 0.98
    np.fill_diagonal(mask, False)
    book = embedding_dedup.fit_codebooks(units, 4, 0.98, 1.0)
    found = []
    for dense in (5, 1 << 30):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(embedding_dedup, "DENSE", dense)
            patch.setattr(embedding_dedup, "QUERIES", 100)
            block = embedding_dedup._Block(listed, book, 0.98)
            block.own_links()
            block.reduce()
        links = np.zeros(900, dtype=np.int64)
        links[block.order] = block.links
        assert (links == mask @ listed.weight).all() and links.max() > 200
        found.append(dict(zip(*(x.tolist() for x in block.edges[0]), strict=True)))
    assert found[0] == found[1]


def test_vectors_travel_once_for_half_of_the_blocks():
    vectors = np.random.default_rng(10).normal(size=(1000, 6)).astype(np.float32)
    table = pa.record_batch(
        [pa.array(np.arange(1000)), pa.array(list(vectors)), pa.array(np.full(1000, 3, np.int32))],
        ["vec_id", "embedding", "label"],
    )
    rows = pa.Table.from_batches(list(embedding_dedup._sent({(3, 6): 4})(iter([table, table]))))
    first = rows.filter(pa.compute.is_valid(rows["values"]))
    assert first["id"].to_pylist() == list(range(1000)) and rows.num_rows == 2000
    others = first["others"].to_numpy()
    assert set(others) == {1, 2} and others.mean() < 1.6
    assert first["values"].to_pylist() == [x.tobytes() for x in vectors]


def test_vectors_are_not_stored_again(spark):
    """What is staged is smaller than the table: it was six times its size."""
    vectors = np.random.default_rng(11).normal(size=(4000, 64)).astype(np.float32)
    data = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int")
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p: p.stat().st_size for p in folder.rglob("*.parquet")}
    embedding_dedup.near_copies(frame).collect()
    staged = sum(p.stat().st_size for p in folder.rglob("*.parquet") if p not in before)
    assert staged < vectors.nbytes / 2


def test_recall_below_one_visits_less_and_links_no_more(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 16))
    data = [(i, [float(x) for x in v], 1) for i, v in enumerate(base)]
    data += [(100 + i, [float(x) for x in v + 0.04 * rng.normal(size=16)], 1) for i, v in enumerate(base)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    exact = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_copies(frame, codes=8).collect()}
    some = embedding_dedup.near_copies(frame, codes=8, target_recall=0.95).collect()
    assert all(r["n_links"] <= exact[r["vec_id"]] for r in some)
    assert sum(r["n_links"] for r in some) >= 0.9 * sum(exact.values())


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (None, 5)]
    frame = spark.createDataFrame(path, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_pipeline_stages(spark, docs, labels, nothing, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, function in corpus_pipeline.STAGES:
        found = function(spark, docs, str(tmp_path))
        if name != "packing":
            assert found.columns == corpus_pipeline.COLUMNS
        found = found.collect()
        assert found
        assert function(spark, nothing, str(tmp_path)).collect() == []
        ids = {r["doc_id"] for r in found}
        if name in ("mixing_to_targets", "packing"):
            assert ids == {r[0] for r in rows()}
        if name == "ngram_jaccard_join":
            groups = brute.jaccard_groups(plain())
            stays = {i for i, n, c in groups if i is None or n == 0 or i == c}
            assert ids == stays
            assert len(found) == len(stays)
        if name == "line_dedup":
            by_id = {r["doc_id"]: r["text"] for r in found}
            assert 4 not in by_id and by_id[None] == PASSAGE
            assert by_id[9] == "one same line here now"


def test_pipeline_run(spark, docs, labels, tmp_path):
    docs.select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digest = hashlib.sha256(b"".join(bytes(r["ids"]) for r in found)).hexdigest()
    assert found and digest


def members_of(spark, groups):
    """Rows of (chances, tokens, number of rows) as ``fit_rates`` reads them."""
    data = [(10 * i + n, i, t, [float(x) for x in c]) for i, (c, t, rows) in enumerate(groups) for n in range(rows)]
    return spark.createDataFrame(data, "doc_id bigint, rh bigint, n_tokens bigint, chances array<double>")


def expected_tokens(members, rates):
    found = [(r["n_tokens"], np.array(r["chances"])) for r in members.collect()]
    return sum(n * rates.of(c[None])[0] * c for n, c in found)


def test_rare_domains_reach_their_targets(spark):
    groups = [([1.0, 0, 0], 9950, 10), ([0, 1.0, 0], 50, 2), ([0, 0, 1.0], 200, 2)]
    members = members_of(spark, groups)
    mix = Mix({"a": 0.97, "b": 0.01, "c": 0.02}, tolerance=1e-7)
    rates, targets, reached = fit_rates(members, mix)
    assert np.allclose(targets, np.array([0.97, 0.01, 0.02]) * 100_000, rtol=1e-9)
    assert np.allclose(reached, targets, rtol=1e-6)
    assert np.allclose(expected_tokens(members, rates), targets, rtol=1e-6)


@pytest.mark.parametrize("mixed", [0.0, 0.05])
def test_most_tokens_reach_the_shares_without_dropping(spark, mixed):
    rest = 1 - mixed
    groups = [([1.0, 0, 0, 0], 9700, 10)]
    groups += [([mixed, *[rest * (j == i) for j in range(3)]], 500, 2) for i in range(3)]
    members = members_of(spark, groups)
    weights = {"en": 0.52, "de": 0.18, "fr": 0.18, "es": 0.12}
    rates, _, reached = fit_rates(members, Mix(weights, tokens="most", least=1.0, tolerance=1e-7))
    assert np.allclose(reached / reached.sum(), list(weights.values()), rtol=1e-6)
    assert np.allclose(expected_tokens(members, rates), reached, rtol=1e-6)
    if not mixed:
        assert np.isclose(reached.sum(), 97_000 / 0.52)


def test_targets_out_of_reach_are_met_as_well_as_possible(spark, caplog):
    """No document leans to b by more than a tenth, so b ends short, with a warning."""
    members = members_of(spark, [([0.9, 0.1], 100, 3), ([1.0, 0], 100, 3)])
    mix = Mix({"a": 0.5, "b": 0.5})
    rates, targets, reached = fit_rates(members, mix)
    # Along 0.9 : 0.1 the sum of squared misses over the tokens of 570 and 30 is least here.
    total = (0.9 * 300 / 570 + 0.1 * 300 / 30) / (0.81 / 570 + 0.01 / 30)
    assert np.allclose(reached, total * np.array([0.9, 0.1]), rtol=1e-3)
    assert rates.of(np.array([[1.0, 0]]))[0] == 0
    log_totals(mix, targets, reached)
    assert [r.levelname for r in caplog.records] == ["WARNING"] * 2


def test_rates_are_the_least_squares(spark, least=0.4):
    """Against coordinate descent over single documents."""
    draw = np.random.default_rng(8)
    chances = draw.dirichlet([0.3, 0.3, 0.3, 0.3], 200)
    tokens = draw.integers(1, 400, 200)
    groups = [(c, int(t), 1) for c, t in zip(chances, tokens, strict=True)]
    members = members_of(spark, groups)
    mix = Mix({"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, least=least, steps=40)
    rates, targets, reached = fit_rates(members, mix)
    part = chances * tokens[:, None]
    mass = part.sum(0)
    r = np.ones(200)
    for _ in range(400):
        for i in range(200):
            miss = (part.T @ r - targets) / mass
            r[i] = max(least, r[i] - (part[i] @ miss) / (part[i] ** 2 / mass).sum())

    def square(totals):
        return float((((totals - targets) ** 2) / mass).sum())

    # Near the end steps grow short: a hundredth of the sum of squares at rates of 1 may be left.
    assert square(reached) - square(part.T @ r) <= 0.01 * square(mass)
    assert np.allclose(part.T @ rates.of(chances), reached, rtol=1e-9)
    assert (rates.of(chances) >= least).all()


def test_held_out_labels_of_the_domains(spark):
    """Accuracy and expected numbers on labels that were not learned from."""
    from stratamart.llm.features import fit_softmax, sample_features
    from stratamart.llm.mixing import domains_of

    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = domains_of(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    truth = {r["doc_id"]: r["domain"] for r in known}
    names = ["en", "de", "fr", "es", "junk", "toxic"]
    sample = sample_features(docs, np.array(sorted(truth), dtype=np.int64))
    labels = np.array([names.index(truth[int(i)]) for i in sample.doc_id])
    held = sample.doc_id % 4 == 1
    model = fit_softmax(sample.text[~held], labels[~held], len(names))
    chances = model.chances(sample.text[held])
    found, right = chances.argmax(axis=1), labels[held]
    assert np.mean(found == right) > 0.85
    for k, name in enumerate(names):
        # The expected number of documents of a domain is near the true one.
        assert abs(chances[:, k].sum() - (right == k).sum()) < 0.35 * (right == k).sum() + 5, name


def test_no_number_of_open_sequences_ends_them():
    """Pieces that never share a sequence stay open until the end, however many."""
    packer, n, size = SumOfSquares(2048), 5000, 1500
    for i in range(n):
        assert not list(packer.place(Piece((i, size), 0, size, bytes(4 * size))))
    assert packer.n_open == n and packer.levels[size] == n
    done = list(packer.finish())
    assert sum(s.fill for s in done) == n * size
    assert all(s.fill == 2048 for s in done[: n * size // 2048])


def test_secrets_of_very_long_texts(spark):
    """A long key-like run and thousands of matches in one text, and entropy against brute force."""
    draw = np.random.default_rng(11)
    key = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    long_run = "".join(draw.choice(key, 300_000))
    hexes = " ".join("".join(draw.choice(list("0123456789abcdef"), 33)) for _ in range(6000))
    runs = ["".join(draw.choice(key[: int(k)], 40)) for k in draw.integers(2, 64, 60)]
    texts = [(0, long_run), (1, hexes), *((2 + i, r) for i, r in enumerate(runs))]
    found = find_secrets(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert [(s["start"], s["stop"]) for s in by_id[0]["extra"]] == [(0, 300_000)]
    assert [(s["start"], s["stop"]) for s in by_id[1]["base"]] == [(34 * i, 34 * i + 33) for i in range(6000)]
    assert by_id[1]["extra"] == []
    for i, run in enumerate(runs):
        if run.isalpha() or by_id[2 + i]["base"]:
            continue
        assert bool(by_id[2 + i]["extra"]) == (brute.largest_entropy(run) >= 3.8)


def test_lines_that_no_other_line_equals_are_not_shuffled_to_find_copies(spark):
    """Lines 0 to 3999 occur once, 300 others in two or three documents each."""
    once = spark.range(4000).selectExpr("id AS doc_id", "concat('only ', id, ' a b c d e') AS text")
    often = spark.range(750).selectExpr(
        "id + 4000 AS doc_id", "concat('line ', id % 300, ' f g h i j\\nline ', id % 300, ' f g h i j') AS text"
    )
    docs = once.union(often)
    spec = setjoin.SetSpec(by_line=True)
    texts = setjoin.set_input(docs, spec)
    signed = stage(setjoin.signatures(texts, spec, setjoin.frequency_levels(texts, spec)), "lines")
    bits = setjoin.repeated_sets(signed, signed.count())
    equal = setjoin.with_repeated_set(signed, bits)
    assert equal.where("doc_id >= 4000").count() == 1500
    assert equal.where("doc_id < 4000").count() < 200
    heads = equal.where("doc_id < 4300 AND line_no = 0").select(*spec.ids)
    listed = setjoin.postings(signed, spec, setjoin.ListKeys(80), heads, shared_sets=bits)
    # Copies seldom pass, so the keys of a head and its copies have one row and are left out.
    assert listed.where("doc_id >= 4000").count() < 50
    found = remove_repeated_lines(docs).where("n_removed > 0").selectExpr("doc_id", "n_removed").collect()
    expected = {4000 + i: 1 for i in range(300)} | {4300 + i: 2 for i in range(450)}
    assert dict(map(tuple, found)) == expected
