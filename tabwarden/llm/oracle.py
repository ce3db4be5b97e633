"""SQL for the corpus queries that SQL can express; the others are tested against plain Python."""

from __future__ import annotations

from tabwarden.llm import licenses, quality

WORD = r"[^\x20\x09-\x0D]"


def quality_sql() -> str:
    rules = {
        "few_words": f"n_words < {quality.MIN_WORDS}",
        "repeats": f"100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words",
        "symbols": "2 * n_symbols > n_words",
        "same_lines": "100 * n_dup_lines > 30 * n_lines",
        "word_length": "word_chars > 15 * n_words OR word_chars < 2 * n_words",
    }
    flags = ", ".join(f"({sql}) AS {name}" for name, sql in rules.items())
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE {r}) AS DOUBLE) AS {r}" for r in rules)
    means = ", ".join(
        f"greatest(least(sum({r}) / sum(n), 1 - 1e-6), 1e-6) AS m_{r}, sum({r} * {r} / n) / sum(n) - pow(sum({r}) / sum(n), 2) AS v_{r}"
        for r in rules
    )
    spread = lambda r: f"(v_{r} - m_{r} * (1 - m_{r}) * hosts / docs)"
    weights = ", ".join(
        f"CASE WHEN {spread(r)} > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / {spread(r)} - 1, {quality.LEAST_PRIOR}), 1e6) ELSE 1e6 END AS w_{r}, m_{r}"
        for r in rules
    )
    rates = ", ".join(f"({r} + m_{r} * w_{r}) / (n + w_{r})" for r in rules)
    return f"""
    WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
    words AS (SELECT doc_id, regexp_extract_all(text, '{WORD}+') AS ws FROM docs),
    windows AS (SELECT doc_id, i, ws[i:i + 4] AS five FROM words, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS i)),
    twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, LATERAL (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
    ),
    lines AS (
      SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS same
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
    ),
    counted AS (
      SELECT d.doc_id, d.source, len(ws) AS n_words, CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
             coalesce(l.same, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM docs d JOIN words w USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
    ),
    judged AS (SELECT *, {flags} FROM counted),
    hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {counts} FROM judged WHERE source IS NOT NULL GROUP BY source),
    moments AS (SELECT count(*) AS hosts, sum(n) AS docs, {means} FROM hosts),
    priors AS (SELECT {weights} FROM moments),
    rated AS (SELECT source, greatest({rates}) AS host_rate FROM hosts, priors)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,
           NOT (few_words OR repeats OR (coalesce(host_rate > {quality.HOST_LIMIT}, false) AND ({' OR '.join(rules)}))) AS kept,
           n_lines, round(host_rate, 6) AS host_rate, coalesce(host_rate > {quality.HOST_LIMIT}, false) AS host_condemned
    FROM judged LEFT JOIN rated USING (source)
    """


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), {_text(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    out = f"trim(regexp_replace({out}, {_text('[^\\p{L}\\p{N}]+')}, ' ', 'g'))"
    for other, one in licenses.SPELLINGS.items():
        out = f"replace({out}, {_text(other)}, {_text(one)})"
    return out


def license_sql() -> str:
    texts = []
    for name, text in licenses.LICENSES.items():
        texts.append((name, text))
        head, _, rest = text.partition("\n\n")
        if rest and "\n" not in head and head.lower().endswith("license"):
            texts.append((name, rest))
    values = lambda rows: ", ".join(f"({_text(a)}, {_text(b)})" for a, b in rows)
    notices = [(name, line) for name, lines in licenses.NOTICES.items() for line in lines]
    return f"""
    WITH known AS (SELECT name, sha256({_canonical('t')}) AS digest FROM (VALUES {values(texts)}) AS v(name, t)),
    lines AS (SELECT name, sha256({_canonical('t')}) AS digest FROM (VALUES {values(notices)}) AS v(name, t)),
    docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256({_canonical("coalesce(text, '')")}) AS digest FROM documents),
    found AS (
      SELECT doc_id, list_sort(list(DISTINCT name)) AS notices, count(*) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) JOIN lines ON lines.digest = sha256({_canonical('line')})
      GROUP BY doc_id
    )
    SELECT doc_id, docs.digest, known.name AS license, array_to_string(coalesce(notices, []), ',') AS notices, coalesce(n, 0) AS n_notices
    FROM docs LEFT JOIN (SELECT DISTINCT digest, name FROM known) known USING (digest) LEFT JOIN found USING (doc_id)
    """


NEAR_DUPLICATES = f"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}+') AS ws
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, hash(ws[i:i + 4]) AS s FROM words, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 3, 2))) AS i) WHERE len(ws) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

EXACT_DEDUP = r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
FROM docs
"""

FILTER_AUDIT = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws FROM documents
),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
facts AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM docs d LEFT JOIN marks USING (doc_id)
),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM facts GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS f, filter_order[1:i - 1] AS earlier FROM orders, range(1, 6) AS r(i)),
joined AS (
  SELECT *, contains(fails, f) AS failing, earlier <> '' AND fails <> '' AND regexp_matches(fails, '[' || earlier || '_]') AS gone FROM steps, counts
),
summed AS (
  SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND failing), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE gone AND failing), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE fails = f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND failing), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND failing), 0) AS BIGINT) AS toxic_lost
  FROM joined GROUP BY ALL
)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM summed
"""

ORACLE_SQL = {
    "op3_quality_rules": quality_sql(),
    "op5_license_scan": license_sql(),
    "op9_near_duplicates": NEAR_DUPLICATES,
    "op11_exact_dedup": EXACT_DEDUP,
    "op12_filter_audit": FILTER_AUDIT,
}
