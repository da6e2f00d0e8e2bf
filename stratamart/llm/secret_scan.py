"""Search for secrets in texts, in DataFrame functions only.

Three kinds of spans come from patterns. The fourth comes from entropy: over long runs of key-like
characters a window slides one character at a time, the counts of its characters are updated by
the one that enters and the one that leaves, and the run is a secret if the entropy of some window
reaches the threshold of the run's character class. An allow-list suppresses runs that look random
but are not secret.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.host_rules import bind

#: Patterns of the kinds. ``assign`` counts if its second group has 8 characters.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
LEAST_ASSIGNED = 8

#: Runs that entropy may call a secret: 20 key-like characters or more.
LEAST_RUN = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{{{LEAST_RUN},}}"

#: Runs that are not secret, whatever their entropy.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9+/=_-]+$",  # numbers, dates, telephone numbers
    r"^/?([A-Za-z0-9_-]{0,15}/){2,}[A-Za-z0-9_-]{0,15}$",  # paths
    r"^([A-Za-z]{0,19}[-_])+([A-Za-z0-9]{0,8}|[A-Z]?[a-z]{0,18}|[A-Z]{0,19})$",  # names of words
    r"(?i)(example|sample|dummy|placeholder|changeme|abcdefgh|01234567|xxxx)",
)


@dataclass(frozen=True)
class EntropyRule:
    """Window length in characters, and the bits per character that make a run a secret.

    ``letter_bits`` is for runs of letters only. Long words of natural languages and most
    names in code stay below it; of random keys of 32 letters in both cases about one in 800 does.
    """

    window: int = 20
    hex_bits: float = 3.0
    letter_bits: float = 3.7
    base64_bits: float = 3.8


_SPANS = "array<struct<start:int,kind:int,stop:int,match:string>>"
#: Bytes of a chunk of numbers while they are collected.
_CHUNK = 4096


class _Numbers:
    """Numbers collected as text in the state of an aggregation: ``a:b;c:d;``.

    An array in the state would be copied, and its elements converted, in every step. Text is only
    appended to, in chunks, so that a step costs about the same however many there are.
    """

    @staticmethod
    def empty() -> list[Column]:
        return [F.lit("").alias("whole"), F.lit("").alias("chunk")]

    @staticmethod
    def with_numbers(acc: Column, numbers: list[Column], wanted: Column) -> list[Column]:
        item = F.concat(F.concat_ws(":", *[n.cast("string") for n in numbers]), F.lit(";"))
        item = F.when(wanted, item).otherwise(F.lit(""))
        full = F.octet_length(acc["chunk"]) >= _CHUNK
        return [
            F.when(full, F.concat(acc["whole"], acc["chunk"])).otherwise(acc["whole"]).alias("whole"),
            F.when(full, item).otherwise(F.concat(acc["chunk"], item)).alias("chunk"),
        ]

    @staticmethod
    def all(acc: Column) -> Column:
        """An array of arrays of integers."""
        items = F.filter(F.split(F.concat(acc["whole"], acc["chunk"]), ";"), lambda x: x != "")
        return F.transform(items, lambda x: F.split(x, ":").cast("array<int>"))


def _span(start: Column, kind: Column, stop: Column, match: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        kind.cast("int").alias("kind"),
        stop.cast("int").alias("stop"),
        match.alias("match"),
    )


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Places of all matches as structs (start, kind, stop, match), in code points.

    The pieces between matches and the matches alternate, so their lengths add up to places.
    """

    def places(pieces: Column, matches: Column) -> Column:
        def step(acc: Column, pair: Column) -> Column:
            first = acc["at"] + F.length(pair["piece"])
            last = first + F.length(pair["match"])
            return F.struct(last.alias("at"), *_Numbers.with_numbers(acc, [first, last], F.lit(True)))

        pairs = F.zip_with(
            F.slice(pieces, F.lit(1), F.size(matches)),
            matches,
            lambda p, m: F.struct(p.alias("piece"), m.alias("match")),
        )
        start = F.struct(F.lit(0).alias("at"), *_Numbers.empty())
        return F.zip_with(
            F.aggregate(pairs, start, step, _Numbers.all),
            matches,
            lambda x, m: _span(F.get(x, F.lit(0)), F.lit(kind), F.get(x, F.lit(1)), m),
        )

    found = bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: bind(F.split(text, pattern), lambda p: places(p, m)),
    )
    none = F.array().cast(_SPANS)
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(none)


def _largest_entropy(run: Column, rule: EntropyRule) -> Column:
    """The largest Shannon entropy, in bits per character, of any window of the run.

    With c the counts of a window of w characters the entropy is log2(w) - sum(c log2 c) / w. A
    step changes the counts of the character that leaves and of the one that enters; both are
    counted in the window, so the sum is kept up to date instead of computed again and a step takes
    the same time wherever it is in the run.
    """
    w = rule.window

    def weight(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def uses(window: Column, character: Column) -> Column:
        return F.length(window) - F.length(F.replace(window, character, F.lit("")))

    def step(acc: Column, enters: Column) -> Column:
        def slide(leaves: Column) -> Column:
            before = uses(acc["window"], leaves)
            loss = F.when(leaves == "", F.lit(0.0)).otherwise(weight(before) - weight(before - 1))
            kept = F.when(leaves == "", acc["window"]).otherwise(F.substring(acc["window"], 2, w))

            def enter(inside: Column) -> Column:
                n = uses(inside, enters)
                total = acc["total"] - loss + weight(n + 1) - weight(n)
                whole = F.length(inside) == w - 1
                return F.struct(
                    F.concat(inside, enters).alias("window"),
                    total.alias("total"),
                    F.when(whole, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"),
                )

            return bind(kept, enter)

        full = F.length(acc["window"]) == w
        return bind(F.when(full, F.substring(acc["window"], 1, 1)).otherwise(F.lit("")), slide)

    start = F.struct(
        F.lit("").alias("window"), F.lit(0.0).alias("total"), F.lit(float(w * w)).alias("least")
    )
    return F.aggregate(
        F.filter(F.split(run, ""), lambda c: c != ""),
        start,
        step,
        lambda acc: F.log2(F.lit(float(w))) - acc["least"] / w,
    )


def _is_secret(run: Column, rule: EntropyRule) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.rlike(run, F.lit(pattern))
    bits = (
        F.when(F.rlike(run, F.lit("^[0-9a-fA-F]+$")), F.lit(rule.hex_bits))
        .when(F.rlike(run, F.lit("^[A-Za-z]+$")), F.lit(rule.letter_bits))
        .otherwise(F.lit(rule.base64_bits))
    )
    return F.when(allowed, F.lit(False)).otherwise(_largest_entropy(run, rule) >= bits)


def _outside(runs: Column, base: Column) -> Column:
    """The parts of all runs outside all base spans, without the characters that join them to one.

    Runs and base spans are met once each, in order of their starts. A base span ends a part of the
    run that it starts in; the next run, or the end, closes the run.
    """

    def event(start: Column, run: Column, stop: Column) -> Column:
        return F.struct(start.alias("start"), run.alias("run"), stop.alias("stop"))

    never = F.lit((1 << 31) - 1)
    events = F.sort_array(
        F.concat(
            F.transform(base, lambda b: event(b["start"], F.lit(-1), b["stop"])),
            F.transform(runs, lambda r, i: event(r["start"], i, r["stop"])),
            F.array(event(never, F.lit(0), never)),
        )
    )

    def step(acc: Column, e: Column) -> Column:
        is_run = e["run"] >= 0
        inside = ~is_run & (e["start"] < acc["stop"])
        last = F.when(is_run, acc["stop"]).otherwise(e["start"])
        wanted = (is_run | inside) & (last - acc["at"] >= LEAST_RUN)
        at = (
            F.when(is_run, F.greatest(e["start"], acc["covered"]))
            .when(inside, F.greatest(acc["at"], e["stop"]))
            .otherwise(acc["at"])
        )
        covered = F.when(is_run, acc["covered"]).otherwise(F.greatest(acc["covered"], e["stop"]))
        numbers = [acc["run"], acc["at"], last, (~is_run).cast("int")]
        return F.struct(
            F.when(is_run, e["run"]).otherwise(acc["run"]).alias("run"),
            F.when(is_run, e["stop"]).otherwise(acc["stop"]).alias("stop"),
            at.alias("at"),
            covered.alias("covered"),
            *_Numbers.with_numbers(acc, numbers, wanted),
        )

    def part(numbers: Column) -> Column:
        def of(run: Column) -> Column:
            first, last = F.get(numbers, F.lit(1)), F.get(numbers, F.lit(2))
            whole = F.substring(run["match"], first - run["start"] + 1, last - first)
            left = F.when(first > run["start"], F.regexp_replace(whole, "^[=_-]+", ""))
            left = left.otherwise(whole)
            ended = F.get(numbers, F.lit(3)) == 1
            match = F.when(ended, F.regexp_replace(left, "[=_-]+$", "")).otherwise(left)
            start = first + F.length(whole) - F.length(left)
            return _span(start, F.lit(3), start + F.length(match), match)

        return bind(F.get(runs, F.get(numbers, F.lit(0))), of)

    names = ("run", "stop", "at", "covered")
    start = F.struct(*[F.lit(0).alias(n) for n in names], *_Numbers.empty())
    parts = F.transform(F.aggregate(events, start, step, _Numbers.all), part)
    long_ = F.filter(parts, lambda p: F.length(p["match"]) >= LEAST_RUN)
    return F.when(F.size(runs) == 0, F.array().cast(_SPANS)).otherwise(long_)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def find_secrets(docs: DataFrame, rule: EntropyRule | None = None) -> DataFrame:
    """Spans of secrets in every row: (doc_id, base, extra), arrays of (start, kind, stop, match).

    ``base`` holds the spans of the patterns, ``extra`` those that entropy adds: runs of
    ``LEAST_RUN`` key-like characters or more, with or without digits. Of a run that overlaps base
    spans the parts outside them are judged, each as a run of its own; extra spans overlap no base
    span. ``kind`` indexes ``KINDS``; places are code points, the end exclusive; arrays
    are sorted by start, then kind. Matches of one kind are leftmost and do not overlap.

    - A null or empty text has no spans. Null doc_ids and repeated rows are scanned like others.
    - Columns other than doc_id and text are ignored. An empty table gives no rows.
    - Texts are scanned whole, in time that grows in proportion to their length and little faster
      than the number of their matches; nothing is shuffled.
    """
    rule = rule or EntropyRule()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    assigned = F.filter(
        _spans(F.col("text"), ASSIGN, 0),
        lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= LEAST_ASSIGNED,
    )
    base = F.sort_array(
        F.concat(assigned, _spans(F.col("text"), ACCESS, 1), _spans(F.col("text"), HEX, 2))
    )
    found = docs.select(
        "doc_id",
        base.alias("base"),
        _spans(F.col("text"), CANDIDATE, 3).alias("candidates"),
    )

    runs = _outside(F.col("candidates"), F.col("base"))
    extra = F.filter(runs, lambda r: _is_secret(r["match"], rule))
    return found.select("doc_id", "base", extra.alias("extra"))


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts and joined spans of ``find_secrets``, one row per row."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("base", "extra"))).alias("spans"),
    )
