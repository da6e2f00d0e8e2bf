"""Quality rules of documents and of the hosts they come from, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.staging import stage

#: ASCII white space, the pattern of its runs, and the symbols that count.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """Shares are in percent. A host fails if a shrunk share of failing documents is above its."""

    least_words: int = 50
    most_repeated_words: int = 50
    most_symbols: int = 10
    most_repeated_lines: int = 50
    most_failing: int = 50


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_RUN)
    )


def repeated_window_words(words: Column) -> Column:
    """Words that lie in a three-word window which the text has twice or more.

    The windows' hashes are sorted with their places; equal neighbours are repeated windows, and
    their places, sorted, say how many words they cover together.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )

    def places(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                before = F.get(s, k - 1)["h"] == x["h"]
                after = F.get(s, k + 1)["h"] == x["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

        return bind(ordered, repeated)

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            p,
            start,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            covered(places(h))
        )

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(hashes(words), count))


def text_measures(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", "host", text.alias("text"))
    docs = docs.select("doc_id", "host", "text", words_of(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    line_counts = bind(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("repeated")
        ),
    )
    measured = docs.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        line_counts.alias("line_counts"),
        repeated_window_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )
    return measured.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("line_counts.repeated").cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("line_counts.n").cast("long").alias("n_lines"),
    )


def rule_failures(limits: Limits) -> dict[str, Column]:
    """Per rule: does the document fail it? Integer arithmetic only."""
    words = F.col("n_words")
    return {
        "few_words": words < limits.least_words,
        "repeated_words": 100 * F.col("n_repeat_words") > limits.most_repeated_words * words,
        "symbols": 100 * F.col("n_symbols") > limits.most_symbols * F.col("word_chars"),
        "repeated_lines": 100 * F.col("n_dup_lines")
        > limits.most_repeated_lines * F.col("n_lines"),
    }


def shrunk_rates(hosts: DataFrame, rules: list[str]) -> DataFrame:
    """The hosts (host, n, one count per rule) with ``rate_<rule>`` shrunk to the common rate.

    Per rule a beta prior is fitted to the counts by beta-binomial moments, which take the sampling
    noise of hosts of different sizes into account. With p the common rate of all k hosts, N all
    documents and S = sum n_i (p_i - p)^2, the expected S is p (1 - p) ((k - 1) + c (N - sum n_i^2 /
    N - (k - 1))); this gives c, the correlation of two documents of a host. The prior weighs as much
    as (1 - c) / c documents at rate p; c is kept between 0 and 1/2, so that it weighs one document
    at least. Where hosts do not differ by more than noise, or all have one document, c is 0 and
    every host gets the common rate.
    """
    sums = [F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")]
    for rule in rules:
        x = F.col(rule)
        sums += [F.sum(x).alias(f"x_{rule}"), F.sum(x * x / F.col("n")).alias(f"xx_{rule}")]
    total = hosts.agg(*sums).first()  # one row
    out = [F.col(c) for c in hosts.columns]
    for rule in rules:
        if not total["k"]:
            out.append(F.lit(None).cast("double").alias(f"rate_{rule}"))
            continue
        k, n, x = total["k"], total["n"], total[f"x_{rule}"]
        p = x / n
        room = n - total["nn"] / n - (k - 1)
        alike = 0.0
        if 0 < p < 1 and room > 0:
            alike = ((total[f"xx_{rule}"] - p * x) / (p * (1 - p)) - (k - 1)) / room
        alike = min(max(alike, 0.0), 0.5)
        # (x + p w) / (n + w) with w = (1 - c) / c, multiplied by c.
        rate = (F.col(rule) * alike + p * (1 - alike)) / (F.col("n") * alike + (1 - alike))
        out.append(rate.alias(f"rate_{rule}"))
    return hosts.select(*out)


def judge_by_host(docs: DataFrame, host: str = "source", limits: Limits | None = None) -> DataFrame:
    """Rule measures of every row and the verdict on it and on its host.

    Columns: doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed (too few words, or too many in repeated windows), host_failed, kept. A host fails if
    the shrunk share of its documents that fail one of the rules is above the limit; then all its
    documents go. Rule failures are combined before the shuffle, so a host with a third of all rows
    is a few partial counts; the join back can be split.

    - A null or empty text has no words and fails. Lines without a word do not count as lines.
    - A null host is no host: its documents are judged by themselves alone.
    - A null doc_id and repeated rows are judged like any other row.
    - Columns other than doc_id, text and the host's are ignored. An empty table gives no rows.
    - A text is handled as a whole, with its words as arrays in memory.
    """
    limits = limits or Limits()
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.col("text"),
    )
    measured = stage(text_measures(docs), "measures")
    failures = rule_failures(limits)
    sums = [F.count_if(failed).alias(rule) for rule, failed in failures.items()]
    hosts = measured.where("host is not null").groupBy("host")
    hosts = stage(hosts.agg(F.count(F.lit(1)).alias("n"), *sums), "hosts")
    rates = shrunk_rates(hosts, list(failures))
    too_many = F.greatest(*[F.col(f"rate_{r}") for r in failures]) * 100 > limits.most_failing
    bad = rates.where(too_many).select("host", F.lit(True).alias("host_failed"))
    judged = measured.join(bad, "host", "left")
    base = failures["few_words"] | failures["repeated_words"]
    host_failed = F.coalesce("host_failed", F.lit(False))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id",
        "host",
        *measures,
        base.alias("base_failed"),
        host_failed.alias("host_failed"),
        (~base & ~host_failed).alias("kept"),
    )
