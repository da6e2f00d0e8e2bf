"""DuckDB SQL of the queries that SQL can express.

The others have no SQL: line dedup and the secret scan need places and orders that take more than the
query itself, and classifiers, mixing and packing are iterative. Tests compare them with brute force.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

# Smallest node reachable from each node of links(a, b), both directions.
_COMPONENTS = """
reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
components AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a)"""

OP1 = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_COMPONENTS}
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component, e.vec_id) AS component_id,
       coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN components ON node = e.vec_id
LEFT JOIN (SELECT a, COUNT(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id"""

OP7 = f"""
WITH texts AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM places),
firsts AS (SELECT k, min(doc_id) AS lo FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (k)
  WHERE lo < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, COUNT(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept ON kept.doc_id = t.doc_id"""

OP9 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 0 END))) AS i
        FROM texts) p),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS n_both FROM shingles x JOIN shingles y
  ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
{_COMPONENTS}
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes USING (doc_id) LEFT JOIN components ON node = t.doc_id"""

_RULES = ("few_words", "repeated_words", "symbols", "repeated_lines")
_FAILS = (
    "n_words < 50",
    "100 * n_repeat_words > 50 * n_words",
    "100 * n_symbols > 10 * word_chars",
    "100 * n_dup_lines > 50 * n_lines",
)


def _rate(rule: str) -> str:
    return (
        f"(({rule} * c_{rule} + p_{rule} * (1 - c_{rule})) / (n * c_{rule} + (1 - c_{rule})))"
    )


def _alike(rule: str) -> str:
    moment = f"((xx_{rule} - p_{rule} * x_{rule}) / (p_{rule} * (1 - p_{rule})) - (k - 1))"
    return (
        f"CASE WHEN p_{rule} > 0 AND p_{rule} < 1 AND all_n - nn / all_n - (k - 1) > 0 "
        f"THEN least(greatest({moment} / (all_n - nn / all_n - (k - 1)), 0), 0.5) ELSE 0 END AS c_{rule}"
    )


OP10 = rf"""
WITH texts AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM places),
many AS (SELECT doc_id, k FROM windows GROUP BY doc_id, k HAVING COUNT(*) > 1),
covered AS (
  SELECT doc_id, COUNT(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM windows JOIN many USING (doc_id, k)) c
  GROUP BY doc_id),
measures AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
  FROM texts LEFT JOIN covered USING (doc_id)),
hosts AS (
  SELECT host, COUNT(*) AS n,
         {", ".join(f"COUNT(*) FILTER (WHERE {f}) AS {r}" for r, f in zip(_RULES, _FAILS, strict=True))}
  FROM measures WHERE host IS NOT NULL GROUP BY host),
moments AS (
  SELECT COUNT(*) AS k, SUM(n) AS all_n, SUM(n * n) AS nn,
         {", ".join(f"SUM({r}) AS x_{r}, SUM({r} * {r} / n) AS xx_{r}, SUM({r}) / SUM(n) AS p_{r}" for r in _RULES)}
  FROM hosts),
prior AS (SELECT *, {", ".join(map(_alike, _RULES))} FROM moments),
bad AS (
  SELECT host FROM hosts, (SELECT * EXCLUDE (k, all_n, nn) FROM prior)
  WHERE 100 * greatest({", ".join(_rate(r) for r in _RULES)}) > 50)
SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_FAILS[0]} OR {_FAILS[1]} AS base_failed,
       bad.host IS NOT NULL AS host_failed,
       NOT ({_FAILS[0]} OR {_FAILS[1]}) AND bad.host IS NULL AS kept
FROM measures LEFT JOIN bad USING (host)"""


def _cut(k: int, m: int) -> str:
    """Candidates of m words cut after the first k."""
    return f"""
  SELECT c.lang, c.p, c.m, c.a, {k} AS k, x.f AS l, y.f AS r,
         2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS score
  FROM candidates c
  JOIN grams x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:{k}], ' ')
  JOIN grams y ON y.lang = c.lang AND y.p = array_to_string(c.w[{k + 1}:], ' ')
  WHERE c.m = {m}"""


OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
runs AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
grams AS (
  SELECT lang, array_to_string(w[i:i + s], ' ') AS p, CAST(COUNT(*) AS BIGINT) AS f, s + 1 AS m
  FROM places, (VALUES (0), (1), (2), (3)) v(s) WHERE i + s <= len(w) GROUP BY ALL),
candidates AS (
  SELECT lang, p, f AS a, m, string_split(p, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
inner_parts AS (
  SELECT lang, f, array_to_string(w[b:b + n - 1], ' ') AS p
  FROM (SELECT lang, a AS f, w, m, n, unnest(range(1, m - n + 2)) AS b
        FROM candidates, (VALUES (2), (3)) v(n) WHERE n < m) x),
covered AS (
  SELECT DISTINCT c.lang, c.p FROM candidates c JOIN inner_parts i ON i.lang = c.lang AND i.p = c.p
  WHERE 100 * CAST(i.f AS HUGEINT) >= 80 * CAST(c.a AS HUGEINT)),
cuts AS ({" UNION ALL ".join(_cut(k, m) for m in (2, 3, 4) for k in range(1, m))}),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, p AS phrase, a, l, r, CAST(score AS BIGINT) AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank
  FROM lowest ANTI JOIN covered USING (lang, p))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# The table of the checksum by its rule: eight steps of its reversed polynomial for each byte.
_CRC_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_CRC_STEPS = " ".join(f", s{i} AS (SELECT b, {_CRC_STEP} AS x FROM s{i - 1})" for i in range(1, 9))

OP12 = rf"""
WITH RECURSIVE s0 AS (SELECT range AS b, CAST(range AS BIGINT) AS x FROM range(256))
{_CRC_STEPS},
steps AS MATERIALIZED (SELECT list(x ORDER BY b) AS t FROM s8),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents) x),
counted AS (SELECT doc_id, run, COUNT(*) AS n FROM runs GROUP BY doc_id, run),
keyed AS (
  SELECT run, n, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS k FROM counted),
summed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(1, len(k) // 2 + 1), lambda i: CAST(('0x' || k[2 * i - 1:2 * i]) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM keyed, steps),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT))
                                    || substring(run, CAST(h % length(run) + 2 AS BIGINT))
              ELSE run END AS word, n FROM summed),
words AS (
  SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6
  GROUP BY word HAVING SUM(n) >= 5),
shorter AS (
  SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS d
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) x),
near AS (
  SELECT x.word, y.word AS near, y.n AS m FROM shorter x JOIN shorter y
  ON x.i = y.i AND x.d = y.d AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM shorter x JOIN words y ON x.d = y.word
  UNION SELECT y.word, x.word, x.n FROM shorter x JOIN words y ON x.d = y.word),
best AS (
  SELECT word, COUNT(*) OVER (PARTITION BY word) AS n_near, near, m FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, near) = 1),
variants AS (
  SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN m >= 5 * w.n THEN near END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
follow AS (
  SELECT word, word AS at FROM variants
  UNION SELECT f.word, v.form FROM follow f JOIN variants v ON v.word = f.at WHERE v.form IS NOT NULL),
roots AS (
  SELECT f.word, f.at AS root FROM follow f JOIN variants v ON v.word = f.at WHERE v.form IS NULL)
SELECT v.word, form, root, n, n_near, form_n FROM variants v JOIN roots USING (word)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": OP1,
        "op7_substring_dedup": OP7,
        "op9_ngram_jaccard_join": OP9,
        "op10_host_quality_rules": OP10,
        "op11_phrase_collocations": OP11,
        "op12_spelling_variants": OP12,
    }
