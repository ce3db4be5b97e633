"""The same results as ``tabwarden.queries`` in plain SQL over the whole test tables."""

from __future__ import annotations

from tabwarden.fixtures import FEATURES, LABEL_WEIGHTS, PARTS_SQL, site_traits_sql
from tabwarden.queries import DRIFT_COLUMNS, DRIFT_SINCE, ORDERS_SINCE, RUN_ID, TABLES
from tabwarden.spec import PHISHING

TRAITS = f"traits AS ({site_traits_sql()})"
NAMES = PHISHING.names


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _ratio(num: str, den: str) -> str:
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def _r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


# --- sources, projections, profiles -------------------------------------------------


def _scan_clean() -> str:
    return f"WITH {TRAITS} SELECT {', '.join(NAMES)} FROM traits"


def _bigint_traits() -> str:
    columns = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in FEATURES)
    return f"WITH {TRAITS} SELECT id, {columns}, Result FROM traits"


def _json() -> str:
    fields = " || ',' || ".join(
        ["'\"id\":' || CAST(id AS VARCHAR)"] + [f"'\"{c}\":' || COALESCE(CAST({c} AS VARCHAR), 'null')" for c in NAMES]
    )
    return f"WITH {TRAITS} SELECT id, '{{' || {fields} || '}}' AS record FROM traits"


APPEND_LOAD = """
WITH loaded AS (SELECT * FROM orders UNION ALL SELECT * FROM orders)
SELECT o_orderstatus, count(*) AS n_rows, count(*) AS n_ids, count(DISTINCT o_orderkey) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price, count(*) AS n_loaded_at,
       (SELECT count(*) FROM loaded) AS n_written
FROM loaded GROUP BY o_orderstatus
"""


def _probe() -> str:
    counts = _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES])
    return (
        f"WITH counted AS ({counts}) SELECT table_name, n_rows, column_name, CAST(ordinal_position AS INTEGER) AS position "
        "FROM counted JOIN information_schema.columns USING (table_name)"
    )


CLASS_BALANCE = f"""
WITH {TRAITS}
SELECT count(*) AS total_rows, count(CASE WHEN Result = 1 THEN 1 END) AS positive_count,
       count(CASE WHEN Result = -1 THEN 1 END) AS negative_count,
       round(CAST(count(CASE WHEN Result = 1 THEN 1 END) AS DOUBLE) / NULLIF(count(*), 0), 6) AS positive_ratio
FROM traits
"""

VALUE_COUNTS = f"""
WITH {TRAITS}
SELECT 'Result' AS column_name, Result AS value, count(*) AS n FROM traits GROUP BY Result
UNION ALL
SELECT 'quality', quality, count(*) FROM labels WHERE quality IS NOT NULL GROUP BY quality
"""


def _null_profile() -> str:
    rows = [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n_rows FROM traits" for c in NAMES]
    total = " + ".join(f"(count(*) - count({c}))" for c in NAMES)
    return f"WITH {TRAITS} " + _union(rows + [f"SELECT '(all)', {total}, count(*) FROM traits"])


def _range_profile() -> str:
    rows = [f"SELECT '{c}' AS column_name, min({c}) AS min_value, max({c}) AS max_value FROM lineitem" for c in DRIFT_COLUMNS]
    lows, highs = (", ".join(f"{f}({c})" for c in DRIFT_COLUMNS) for f in ("min", "max"))
    return _union(rows + [f"SELECT '(all)', least({lows}), greatest({highs}) FROM lineitem"])


# --- checks ---------------------------------------------------------------------------

VARIANTS = ("good", "column_missing", "column_added", "text_column", "label_zero", "label_null")


def _check_columns() -> str:
    actual = {"column_missing": 30, "column_added": 32}
    rows = []
    for v in VARIANTS:
        n = actual.get(v, 31)
        rows.append(f"SELECT '{v}' AS dataset, 31 AS expected, {n} AS actual, count(*) AS n_rows, {n == 31} AS ok FROM traits")
    return f"WITH {TRAITS} " + _union(rows)


def _check_numeric() -> str:
    rows = []
    for v in VARIANTS:
        for c in NAMES:
            present = not (v == "column_missing" and c == "Favicon")
            numeric = present and not (v == "text_column" and c == "URL_Length")
            values = f"count({c})" if present else "count(NULL)"
            if v == "label_null" and c == "Result":
                values = "count(CASE WHEN id % 1000 <> 0 THEN Result END)"
            rows.append(
                f"SELECT '{v}' AS dataset, '{c}' AS column_name, {present} AS present, {numeric} AS is_numeric, "
                f"{values} AS n_values, {numeric} AS ok FROM traits"
            )
    return f"WITH {TRAITS} " + _union(rows)


def _check_target() -> str:
    broken = "count(CASE WHEN id % 1000 = 0 THEN 1 END)"
    rows = []
    for v in VARIANTS:
        bad = broken if v.startswith("label") else "count(CASE WHEN Result NOT IN (-1, 1) OR Result IS NULL THEN 1 END)"
        rows.append(f"SELECT '{v}' AS dataset, true AS present, {bad} AS n_bad, {bad} = 0 AS ok FROM traits")
    return f"WITH {TRAITS} " + _union(rows)


TARGET_VIOLATIONS = f"""
WITH {TRAITS},
varied AS (
  SELECT 'label_zero' AS dataset, CASE WHEN id % 1000 = 0 THEN 0 ELSE Result END AS Result FROM traits
  UNION ALL SELECT 'label_null', CASE WHEN id % 1000 = 0 THEN NULL ELSE Result END FROM traits
  UNION ALL SELECT 'good', Result FROM traits
)
SELECT dataset, COALESCE(CAST(Result AS VARCHAR), 'null') AS value, count(*) AS n
FROM varied WHERE Result IS NULL OR Result NOT IN (-1, 1) GROUP BY 1, 2
"""


def _gate() -> str:
    """The later set of a variant holds a wrong label if any of its rows was changed."""
    width = {"column_missing": len(NAMES) - 1, "column_added": len(NAMES) + 1}
    wrong = "(SELECT count(*) FROM later WHERE id % 1000 = 0)"
    clean = "(SELECT count(*) = 0 FROM later WHERE id % 1000 = 0)"
    rows = []
    for v in VARIANTS:
        columns = "false" if v in ("column_missing", "column_added") else "true"
        numeric = "NULL" if columns == "false" else ("false" if v == "text_column" else "true")
        target = "NULL" if numeric in ("NULL", "false") else (clean if v.startswith("label") else "true")
        earlier = {"columns": "true", "numeric": "NULL" if numeric == "NULL" else "true", "target": "NULL" if target == "NULL" else "true"}
        found = {"columns": columns, "numeric": numeric, "target": target}
        message = {
            "columns": f"'test set: {width.get(v)} columns instead of {len(NAMES)}'",
            "numeric": "'test set: a declared numeric column is missing or not numeric'",
            "target": f"'test set: ' || {wrong} || ' rows without an allowed label'",
        }
        for i, check in enumerate(("columns", "numeric", "target")):
            rows.append(
                f"SELECT '{v}' AS variant, {2 * i + 1} AS position, '{check}' AS check_name, 'train' AS dataset, "
                f"CAST({earlier[check]} AS BOOLEAN) AS ok, CAST(NULL AS VARCHAR) AS message"
            )
            rows.append(
                f"SELECT '{v}', {2 * i + 2}, '{check}', 'test', CAST({found[check]} AS BOOLEAN), "
                f"CASE WHEN NOT CAST({found[check]} AS BOOLEAN) THEN {message[check]} END"
            )
    return f"""
    WITH {TRAITS},
    later AS (SELECT o_orderkey AS id FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SINCE}'),
    checks AS ({_union(rows)})
    SELECT * FROM checks
    UNION ALL
    SELECT variant, 7, 'gate', 'both', bool_and(ok), COALESCE(string_agg(message, chr(10) ORDER BY position), '')
    FROM checks GROUP BY variant
    """


def _routing() -> str:
    rows = []
    for v in VARIANTS:
        bad = "(SELECT count(*) FROM dated WHERE later AND id % 1000 = 0)"
        status = {"good": "'valid'"}.get(v, f"CASE WHEN {bad} = 0 THEN 'valid' ELSE 'invalid' END" if v.startswith("label") else "'invalid'")
        rows += [f"SELECT '{v}' AS variant, {status} AS status, '{d}' AS dataset, count(*) FILTER (WHERE {w}) AS n_rows FROM dated" for d, w in (("train", "NOT later"), ("test", "later"))]
    return f"WITH dated AS (SELECT o_orderkey AS id, o_orderdate >= TIMESTAMP '{ORDERS_SINCE}' AS later FROM orders) " + _union(rows)


# --- drift ------------------------------------------------------------------------------


def _ks(more: str | None = None) -> str:
    """CTEs ending in ``tested``: the statistic of every drift column, and of the rows of ``more``."""
    long = _union(
        [
            f"SELECT '{c}' AS column_name, {c} AS value, l_shipdate >= TIMESTAMP '{DRIFT_SINCE}' AS later FROM lineitem WHERE {c} IS NOT NULL"
            for c in DRIFT_COLUMNS
        ]
        + ([more] if more else [])
    )
    return f"""
    long AS ({long}),
    steps AS (
      SELECT column_name, value, CAST(count(CASE WHEN NOT later THEN 1 END) AS BIGINT) AS c1,
             CAST(count(CASE WHEN later THEN 1 END) AS BIGINT) AS c2
      FROM long GROUP BY column_name, value
    ),
    sums AS (
      SELECT column_name, CAST(sum(c1) OVER upto AS DOUBLE) AS s1, CAST(sum(c2) OVER upto AS DOUBLE) AS s2,
             CAST(sum(c1) OVER whole AS BIGINT) AS n1, CAST(sum(c2) OVER whole AS BIGINT) AS n2
      FROM steps
      WINDOW upto AS (PARTITION BY column_name ORDER BY value ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY column_name)
    ),
    ks AS (SELECT column_name, max(n1) AS n1, max(n2) AS n2, max(abs(s1 / n1 - s2 / n2)) AS d FROM sums GROUP BY column_name),
    lam AS (SELECT *, d * sqrt(CAST(n1 AS DOUBLE) * n2 / (CAST(n1 AS DOUBLE) + n2)) AS gap_size FROM ks),
    tested AS (
      SELECT column_name, n1, n2, d,
             CASE WHEN gap_size < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, (
               SELECT sum(2.0 * CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * gap_size * gap_size))
               FROM range(1, 101) AS r(k)))) END AS p_value
      FROM lam
    )
    """


DRIFT_ROWS = "round(d, 6) AS d, round(p_value, 6) AS p_value"
SOME_MISSING = f"(SELECT l_quantity AS v, l_linenumber AS line, l_shipdate >= TIMESTAMP '{DRIFT_SINCE}' AS later FROM lineitem)"
DRIFT_REPORT = f"""
WITH {_ks(f"SELECT 'some_missing', v, later FROM {SOME_MISSING} WHERE v IS NOT NULL AND (NOT later OR line > 1)")},
rates AS (SELECT CAST(count(*) FILTER (WHERE later AND line <= 1) AS DOUBLE) / count(*) FILTER (WHERE later) AS rate FROM {SOME_MISSING})
SELECT column_name, n1, n2, {DRIFT_ROWS}, 0.0 AS null_rate1,
       CASE WHEN column_name = 'some_missing' THEN round((SELECT rate FROM rates), 6) ELSE 0.0 END AS null_rate2,
       p_value < 0.05 AS drift_status, CAST(0.05 AS DOUBLE) AS threshold
FROM tested
UNION ALL
SELECT 'all_missing', 0, 0, NULL, NULL, 1.0, 1.0, false, CAST(0.05 AS DOUBLE)
"""
# The orderings of every sample of ``long`` (column_name, value, later) counted row by row.
ORDERINGS = """
steps AS (SELECT column_name, value, count(*) FILTER (WHERE NOT later) AS c1, count(*) FILTER (WHERE later) AS c2 FROM long GROUP BY ALL),
sums AS (
  SELECT column_name, CAST(sum(c1) OVER upto AS BIGINT) AS s1, CAST(sum(c2) OVER upto AS BIGINT) AS s2,
         CAST(sum(c1) OVER whole AS BIGINT) AS n1, CAST(sum(c2) OVER whole AS BIGINT) AS n2
  FROM steps
  WINDOW upto AS (PARTITION BY column_name ORDER BY value ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY column_name)
),
ks AS (SELECT column_name, max(n1) AS n1, max(n2) AS n2, max(abs(s1 * n2 - s2 * n1)) AS gap FROM sums GROUP BY column_name),
lattice AS (
  SELECT column_name, greatest(n1, n2) AS big, least(n1, n2) AS small, CAST(least(n1, n2) // gcd(n1, n2) AS DOUBLE) AS a,
         CAST(greatest(n1, n2) // gcd(n1, n2) AS DOUBLE) AS b, CAST(gap // gcd(n1, n2) AS DOUBLE) AS reach
  FROM ks
),
band AS (
  SELECT column_name, j, CAST(greatest(0, floor((j * b - reach) / a) + 1) AS BIGINT) AS low,
         CAST(least(big, ceil((j * b + reach) / a) - 1) AS BIGINT) AS high
  FROM lattice, LATERAL (SELECT unnest(range(0, small + 1)) AS j)
),
inside AS (
  SELECT column_name, 0 AS j, [1.0::DOUBLE for i in range(0, high + 1)] AS row, 0.0::DOUBLE AS scale, CAST(0 AS BIGINT) AS first
  FROM band WHERE band.j = 0
  UNION ALL
  SELECT column_name, j, [v / peak for v in row], scale + ln(peak), low FROM (
    SELECT *, list_max(row) AS peak FROM (
      SELECT s.column_name, b.j, s.scale, b.low,
             (SELECT list(total ORDER BY i) FROM (
                SELECT i, sum(COALESCE(s.row[i - s.first + 1], 0.0)) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS total
                FROM (SELECT unnest(range(b.low, b.high + 1)) AS i))) AS row
      FROM inside s JOIN band b ON b.column_name = s.column_name AND b.j = s.j + 1
    )
  )
)
"""
ORDERINGS_P = "round(1 - exp(ln(row[len(row)]) + scale - (lgamma(n1 + n2 + 1) - lgamma(n1 + 1) - lgamma(n2 + 1))), 6)"
KS_EXACT = f"""
WITH RECURSIVE
long AS (
  SELECT 'p_size' AS column_name, CAST(p_size AS DOUBLE) AS value, p_type = 'ECONOMY' AS later FROM part WHERE p_size IS NOT NULL
  UNION ALL SELECT 'p_retailprice', CAST(p_retailprice AS DOUBLE), p_type = 'ECONOMY' FROM part WHERE p_retailprice IS NOT NULL
),
{ORDERINGS}
SELECT k.column_name, k.n1, k.n2, round(CAST(gap AS DOUBLE) / n1 / n2, 6) AS d, {ORDERINGS_P} AS p_value
FROM ks k JOIN inside i ON i.column_name = k.column_name AND i.j = least(n1, n2)
"""


def _ks_segments() -> str:
    long = _union(
        [
            f"SELECT '{c}:' || l_suppkey AS column_name, {c} AS value, l_shipdate >= TIMESTAMP '{DRIFT_SINCE}' AS later FROM lineitem WHERE {c} IS NOT NULL"
            for c in DRIFT_COLUMNS[:2]
        ]
    )
    return f"""
    WITH RECURSIVE long AS ({long}), {ORDERINGS},
    counted AS (
      SELECT k.column_name, {ORDERINGS_P} AS p_value
      FROM ks k JOIN inside i ON i.column_name = k.column_name AND i.j = least(n1, n2) WHERE least(n1, n2) > 0 AND gap > 0
    ),
    sizes AS (SELECT *, CAST(gap AS DOUBLE) / n1 / n2 AS d, n1 * CAST(n2 AS DOUBLE) / (n1 + n2) AS weight FROM ks)
    SELECT CAST(split_part(s.column_name, ':', 2) AS BIGINT) AS l_suppkey, split_part(s.column_name, ':', 1) AS column_name, n1, n2,
           CASE WHEN least(n1, n2) > 0 THEN round(d, 6) END AS d,
           CASE WHEN least(n1, n2) = 0 THEN NULL WHEN d * sqrt(weight) < 0.2 THEN 1.0 ELSE round(greatest(0.0, least(1.0, (
             SELECT sum(2.0 * CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * d * d * weight))
             FROM range(1, 101) AS r(k)))), 6) END AS p_asymptotic,
           CASE WHEN least(n1, n2) > 0 THEN COALESCE(p_value, 1.0) END AS p_value
    FROM sizes s LEFT JOIN counted c ON c.column_name = s.column_name
    """


DRIFT_SUMMARY = f"""
WITH {_ks()}
SELECT count(*) AS total_columns_checked, bool_or(p_value < 0.05) AS drift_detected, CAST(0.05 AS DOUBLE) AS threshold_used,
       COALESCE(string_agg(CASE WHEN p_value < 0.05 THEN column_name END, ',' ORDER BY column_name), '') AS drift_columns
FROM tested
"""


# --- split, imputation, scaling -------------------------------------------------------------


def _split(source: str, key: str, stratum: str) -> str:
    """CTEs ending in ``split_rows`` (k, split): exact quotas by class on the md5 order."""
    return f"""
    ranked AS (
      SELECT {key} AS k, {stratum} AS c,
             row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || CAST({key} AS VARCHAR)), {key}) AS place
      FROM {source}
    ),
    sizes AS (SELECT c, CAST(count(*) AS BIGINT) AS n FROM ranked GROUP BY c),
    shares AS (
      SELECT c, n, total, total - CAST(ceil(round(total * 0.2, 6)) AS BIGINT) AS n_train
      FROM (SELECT c, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM sizes)
    ),
    bases AS (SELECT *, (n * n_train) // total AS base, (n * n_train) % total AS remainder FROM shares),
    quotas AS (
      SELECT c, n - base - CASE WHEN row_number() OVER (ORDER BY remainder DESC, c) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test
      FROM bases
    ),
    split_rows AS (
      SELECT k, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas USING (c)
    )
    """


STRATIFIED_SPLIT = f"""
WITH {_split('orders', 'o_orderkey', 'o_orderstatus')}
SELECT o_orderkey, o_orderstatus, split FROM orders JOIN split_rows ON o_orderkey = k
"""
RANDOM_SPLIT = f"""
WITH {_split('events', 'event_id', "'all'")}
SELECT event_id, event_type, split FROM events JOIN split_rows ON event_id = k
"""
STRATIFIED_FOLDS = """
WITH ranked AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS place,
         CAST(count(*) OVER (PARTITION BY quality) AS BIGINT) AS n
  FROM labels
)
SELECT doc_id, quality, CASE WHEN place > (2 * n) // 3 THEN 2 WHEN place > n // 3 THEN 1 ELSE 0 END AS fold FROM ranked
"""


def _knn(columns: list[str], key: str, rows: str, donors: str) -> str:
    """CTEs ending in ``filled``: every row's key and its columns with the gaps filled."""
    f = len(columns)
    both = " + ".join(f"CASE WHEN r.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in columns)
    square = " + ".join(f"COALESCE(CAST(r.{c} - d.{c} AS DOUBLE) * CAST(r.{c} - d.{c} AS DOUBLE), 0.0)" for c in columns)
    cells = _union(
        [
            f"SELECT row_key, '{c}' AS feature, donor_key, dist, CAST(d_{c} AS DOUBLE) AS value FROM pairs WHERE r_{c} IS NULL AND d_{c} IS NOT NULL"
            for c in columns
        ]
    )
    gaps = " OR ".join(f"r.{c} IS NULL" for c in columns)
    values = ", ".join(f"r.{c} AS r_{c}, d.{c} AS d_{c}" for c in columns)
    picked = ", ".join(f"max(CASE WHEN feature = '{c}' THEN value END) AS v_{c}" for c in columns)
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in columns)
    out = ", ".join(f"round(COALESCE(CAST(r.{c} AS DOUBLE), v_{c}, m_{c}), 6) AS {c}" for c in columns)
    return f"""
    pairs AS (
      SELECT row_key, donor_key, (CAST({f} AS DOUBLE) / shared) * total AS dist, {', '.join(f'r_{c}, d_{c}' for c in columns)}
      FROM (
        SELECT r.{key} AS row_key, d.{key} AS donor_key, {both} AS shared, {square} AS total, {values}
        FROM {rows} r CROSS JOIN {donors} d WHERE {gaps}
      ) WHERE shared > 0
    ),
    cells AS ({cells}),
    nearest AS (
      SELECT row_key, feature, value, row_number() OVER (PARTITION BY row_key, feature ORDER BY dist, donor_key) AS place FROM cells
    ),
    means AS (SELECT row_key, feature, avg(value) AS value FROM nearest WHERE place <= 3 GROUP BY row_key, feature),
    picked AS (SELECT row_key, {picked} FROM means GROUP BY row_key),
    fallback AS (SELECT {means} FROM {donors}),
    filled AS (SELECT r.{key}, {out} FROM {rows} r LEFT JOIN picked ON r.{key} = row_key CROSS JOIN fallback)
    """


XS = ["x1", "x2", "x3"]
KNN_IMPUTE = f"WITH parts AS ({PARTS_SQL}), {_knn(XS, 'p_partkey', 'parts', 'parts')} SELECT * FROM filled"
KNN_IMPUTE_APPLY = f"""
WITH parts AS ({PARTS_SQL}), {_split('parts', 'p_partkey', "'all'")},
train AS (SELECT parts.* FROM parts JOIN split_rows ON p_partkey = k WHERE split = 'train'),
test AS (SELECT parts.* FROM parts JOIN split_rows ON p_partkey = k WHERE split = 'test'),
{_knn(XS, 'p_partkey', 'test', 'train')}
SELECT * FROM filled
"""
ASSEMBLE = f"""
WITH {TRAITS}, {_knn(FEATURES, 'id', 'traits', 'traits')}
SELECT id, CASE WHEN Result = -1 THEN 0 ELSE Result END AS label, {', '.join(f'filled.{c} AS x{i}' for i, c in enumerate(FEATURES))}
FROM filled JOIN traits USING (id)
"""
STANDARD_SCALE = """
WITH s AS (SELECT avg(p_size) AS m1, stddev_pop(p_size) AS d1, avg(p_retailprice) AS m2, stddev_pop(p_retailprice) AS d2 FROM part)
SELECT p_partkey, round((p_size - m1) / d1, 6) AS p_size, round((p_retailprice - m2) / d2, 6) AS p_retailprice FROM part CROSS JOIN s
"""


# --- metrics ----------------------------------------------------------------------------------


def _counts(label: str, prediction: str, source: str, group: str = "") -> str:
    keys = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    cell = lambda t, p: f"count(CASE WHEN {label} = {t} AND {prediction} = {p} THEN 1 END)"
    return (
        f"SELECT {keys}{cell(0, 0)} AS tn, {cell(0, 1)} AS fp, {cell(1, 0)} AS fn, {cell(1, 1)} AS tp, count(*) AS total_samples, "
        f"count(CASE WHEN {label} = 1 THEN 1 END) AS positive_samples, count(CASE WHEN {label} = 0 THEN 1 END) AS negative_samples "
        f"FROM {source}{tail}"
    )


LABEL_COUNTS = _counts("quality", "toxic", "labels")
POSITIVE = {"precision": _ratio("tp", "tp + fp"), "recall": _ratio("tp", "tp + fn"), "f1_score": _ratio("2 * tp", "2 * tp + fp + fn")}
NEGATIVE = {"precision": _ratio("tn", "tn + fn"), "recall": _ratio("tn", "tn + fp"), "f1_score": _ratio("2 * tn", "2 * tn + fn + fp")}
ACCURACY = _ratio("tp + tn", "tp + tn + fp + fn")
WEIGHTED = {m: f"(({NEGATIVE[m]}) * (tn + fp) + ({POSITIVE[m]}) * (tp + fn)) / NULLIF(tp + tn + fp + fn, 0)" for m in POSITIVE}
MACRO = {m: f"(({NEGATIVE[m]}) + ({POSITIVE[m]})) / 2" for m in POSITIVE}


def _columns(scores: dict[str, str]) -> str:
    return ", ".join(f"{_r(e)} AS {m}" for m, e in scores.items())


CONFUSION_CELLS = f"WITH c AS ({LABEL_COUNTS}) " + _union(
    [
        f"SELECT {t} AS label, {p} AS prediction, {n} AS n FROM c"
        for t, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
)
CLASS_REPORT = f"""
WITH c AS ({LABEL_COUNTS})
SELECT 'Legitimate' AS class_name, {_columns(NEGATIVE)}, tn + fp AS support FROM c
UNION ALL SELECT 'Phishing', {_columns(POSITIVE)}, tp + fn FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, {_r(ACCURACY)}, tp + tn + fp + fn FROM c
UNION ALL SELECT 'macro avg', {_columns(MACRO)}, tp + tn + fp + fn FROM c
UNION ALL SELECT 'weighted avg', {_columns(WEIGHTED)}, tp + tn + fp + fn FROM c
"""

STEPS = """
distinct_scores AS (
  SELECT CAST(n_chars AS DOUBLE) AS score, CAST(count(CASE WHEN quality = 1 THEN 1 END) AS DOUBLE) AS pos,
         CAST(count(CASE WHEN quality = 0 THEN 1 END) AS DOUBLE) AS neg
  FROM labels JOIN documents USING (doc_id) GROUP BY n_chars
),
steps AS (
  SELECT score, pos, neg, sum(pos) OVER upto AS cp, sum(neg) OVER upto AS cn, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
         lead(pos) OVER down AS np, lead(neg) OVER down AS nn, row_number() OVER down AS place
  FROM distinct_scores
  WINDOW upto AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING), down AS (ORDER BY score DESC)
)
"""
ROC_AUC = f"WITH {STEPS} SELECT round(sum(neg * (cp - pos / 2)) / (max(p) * max(n)), 6) AS roc_auc FROM steps"
AVERAGE_PRECISION = f"WITH {STEPS} SELECT round(sum((pos / p) * (cp / (cp + cn))), 6) AS average_precision FROM steps"
ROC_CURVE = f"""
WITH {STEPS}
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT score, round(cn / n, 6), round(cp / p, 6) FROM steps WHERE place = 1 OR np IS NULL OR pos <> np OR neg <> nn
"""
PR_CURVE = f"""
WITH {STEPS}
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(1 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall
UNION ALL
SELECT score, round(cp / (cp + cn), 6), round(cp / p, 6) FROM steps
"""
ROC_CURVE_BOUNDED = f"""
WITH {STEPS},
points AS (SELECT score AS threshold, cn / n AS fpr, cp / p AS tpr FROM steps WHERE place = 1 OR np IS NULL OR pos <> np OR neg <> nn),
parts AS (SELECT *, least(19, floor((fpr + tpr) / 2 * 20)) AS part FROM points)
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT threshold, round(fpr, 6), round(tpr, 6) FROM parts
QUALIFY threshold = max(threshold) OVER (PARTITION BY part) OR threshold = min(threshold) OVER (PARTITION BY part)
"""
PR_CURVE_BOUNDED = f"""
WITH {STEPS},
points AS (SELECT score AS threshold, cp / (cp + cn) AS precision, cp / p AS recall FROM steps),
parts AS (SELECT *, least(9, floor(recall * 10)) AS part FROM points),
places AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY threshold) AS lowest,
         row_number() OVER (PARTITION BY part ORDER BY threshold DESC) AS highest,
         row_number() OVER (PARTITION BY part ORDER BY precision, threshold DESC) AS worst,
         row_number() OVER (PARTITION BY part ORDER BY precision DESC, threshold DESC) AS best
  FROM parts
)
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(1 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall
UNION ALL
SELECT threshold, round(precision, 6), round(recall, 6) FROM places WHERE least(lowest, highest, worst, best) = 1
"""
R2 = """
WITH g AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY o_custkey) AS f FROM orders)
SELECT count(*) AS n, round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(*)), 6) AS r2 FROM g
"""


# --- comparison, selection, run records -----------------------------------------------------------


def _rules(source: str, keep: str = "") -> str:
    return "rules AS (" + _union(
        [
            f"SELECT {keep}'{c}' AS model, {i} AS position, CASE WHEN Result = 1 THEN 1 ELSE 0 END AS label, "
            f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS prediction FROM {source}"
            for i, c in enumerate(FEATURES)
        ]
    ) + ")"


RULE_COUNTS = f"{TRAITS}, {_rules('traits')}, counts AS ({_counts('label', 'prediction', 'rules', 'model, position')})"
MODEL_COMPARE = f"WITH {RULE_COUNTS} SELECT model, {_r(ACCURACY)} AS accuracy, {_columns(WEIGHTED)} FROM counts"
SELECT_BEST = f"""
WITH {RULE_COUNTS}, scored AS (SELECT model, position, {WEIGHTED['f1_score']} AS f1_score FROM counts)
SELECT model AS best_model, round(f1_score, 6) AS f1_score FROM scored WHERE f1_score > 0 ORDER BY scored.f1_score DESC, position LIMIT 1
"""
RULE_SUMMARY = f"""
{TRAITS}, {_split('traits', 'id', 'Result')},
both_sets AS (SELECT traits.*, split FROM traits JOIN split_rows ON id = k),
{_rules('both_sets', 'split, ')},
counts AS ({_counts('label', 'prediction', 'rules', 'model, split')}),
scored AS (SELECT model, split, {', '.join(f'{e} AS {m}' for m, e in POSITIVE.items())} FROM counts),
summary AS (
  SELECT '{RUN_ID}' AS run_id, model,
         {', '.join(f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in ('train', 'test') for m in ('f1_score', 'precision', 'recall'))}
  FROM scored GROUP BY model
)
"""
RUN_SUMMARY = f"""
WITH {RULE_SUMMARY}
SELECT run_id, model, {', '.join(f'round({s}_{m}, 6) AS {s}_{m}' for s in ('train', 'test') for m in ('f1_score', 'precision', 'recall'))},
       round(abs(train_f1_score - test_f1_score), 6) AS f1_gap, abs(train_f1_score - test_f1_score) <= 0.05 AS good
FROM summary
"""
QUALITY_GATES = f"""
WITH {RULE_SUMMARY}
SELECT model, 'expected_f1' AS gate, round(test_f1_score, 6) AS value, CAST(0.6 AS DOUBLE) AS threshold, test_f1_score >= 0.6 AS ok FROM summary
UNION ALL
SELECT model, 'train_test_gap', round(abs(train_f1_score - test_f1_score), 6), CAST(0.05 AS DOUBLE), abs(train_f1_score - test_f1_score) <= 0.05
FROM summary
"""


def _tracking() -> str:
    number = lambda kind, key, e: f"SELECT model AS run_id, '{kind}' AS kind, '{key}' AS key, {e} AS number, CAST(NULL AS VARCHAR) AS text FROM counts"
    text = lambda kind, key, e: f"SELECT model AS run_id, '{kind}' AS kind, '{key}' AS key, CAST(NULL AS DOUBLE) AS number, {e} AS text FROM counts"
    rows = [number("metric", m, _r(e)) for m, e in POSITIVE.items()]
    rows.append(number("metric", "additional_total_samples", "CAST(total_samples AS DOUBLE)"))
    rows += [text("param", "model", "model"), text("param", "source", "'orders'"), text("tag", "task", "'phishing_detection'")]
    return f"WITH {RULE_COUNTS} " + _union(rows)


RUN_RETENTION = """
WITH named AS (
  SELECT strftime(ts, '%m_%d_%Y_%H_%M_%S') AS name FROM events UNION ALL SELECT 'notes_' || event_type FROM events
),
parsed AS (SELECT DISTINCT name, try_strptime(name, '%m_%d_%Y_%H_%M_%S') AS started FROM named),
runs AS (SELECT name, row_number() OVER (ORDER BY started DESC) AS place FROM parsed WHERE started IS NOT NULL)
SELECT name, CASE WHEN place <= 3 THEN 'keep' ELSE 'drop' END AS action FROM runs
"""

EVERY_ROW_SAME = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders"



# --- models: a fit is held to facts that follow from the table alone ---------------------------------------

FACTS = """count(*) AS n_rows, count(*) FILTER (WHERE Result = 1) AS n_positive, CAST(0 AS BIGINT) AS n_unpredicted,
       CAST(0 AS BIGINT) AS n_off, true AS beats_majority"""


def _fit(family: str) -> str:
    return (
        f"WITH {TRAITS}, {_split('traits', 'id', 'Result')} "
        f"SELECT split, {FACTS}, '{family}' AS family FROM traits JOIN split_rows ON id = k GROUP BY split"
    )


def _boost(rounds: int = 3) -> str:
    """Boosting by one-split trees, each round the argmin of the weighted impurity."""
    impurity = lambda p, t: f"CASE WHEN {t} > 0 THEN 2 * {p} * ({t} - {p}) / {t} ELSE 0 END"
    sign = lambda p, t: f"CASE WHEN {p} > {t} - {p} THEN 1 ELSE -1 END"
    steps = [
        f"r0 AS (SELECT id, [{', '.join(f'COALESCE({c}, 0)' for c in FEATURES)}] AS xs, Result AS y, CAST(0 AS DOUBLE) AS vote, "
        "CAST(0 AS DOUBLE) AS total FROM traits)"
    ]
    for k in range(rounds):
        steps += [
            f"l{k} AS (SELECT unnest(range(0, {len(FEATURES)})) AS f, unnest(xs) AS v, y, exp(-0.5 * y * vote) AS w FROM r{k})",
            f"a{k} AS (SELECT f, v, COALESCE(sum(w) FILTER (WHERE y = 1), 0) AS pos, sum(w) AS tot FROM l{k} GROUP BY f, v)",
            f"c{k} AS (SELECT f, v, lead(v) OVER o AS nv, sum(pos) OVER o AS lp, sum(tot) OVER o AS lt, sum(pos) OVER a AS p, sum(tot) OVER a AS t "
            f"FROM a{k} WINDOW o AS (PARTITION BY f ORDER BY v), a AS (PARTITION BY f))",
            f"b{k} AS (SELECT f, (v + nv) / 2.0 AS cut, round(({impurity('lp', 'lt')} + {impurity('(p - lp)', '(t - lt)')}) / t, 12) AS impurity, "
            f"{sign('lp', 'lt')} AS low, {sign('(p - lp)', '(t - lt)')} AS high, "
            f"(least(lp, lt - lp) + least(p - lp, t - lt - (p - lp))) / t AS err FROM c{k} WHERE nv IS NOT NULL ORDER BY impurity, f, cut LIMIT 1)",
            f"r{k + 1} AS (SELECT id, xs, y, vote + ln((1 - err) / err) * CASE WHEN xs[f + 1] <= cut THEN low ELSE high END AS vote, "
            f"total + ln((1 - err) / err) AS total FROM r{k}, b{k})",
        ]
    return f"WITH {TRAITS}, {', '.join(steps)} SELECT id, CAST(vote > 0 AS INTEGER) AS prediction, round(1 / (1 + exp(-vote / total)), 6) AS p FROM r{rounds}"


def _fold_scores(depth: int = 2) -> str:
    """Fold scores of trees of every depth up to ``depth``, grown split by split: R² of the predicted labels."""
    share = lambda p, t: f"(CAST({p} AS DOUBLE) / {t})"
    log = lambda x: f"CASE WHEN {x} > 0 AND {x} < 1 THEN -{x} * ln({x}) - (1 - {x}) * ln(1 - {x}) ELSE 0 END"
    impurity = lambda p, t: f"{t} * CASE WHEN criterion = 'gini' THEN 2 * {share(p, t)} * (1 - {share(p, t)}) ELSE {log(share(p, t))} END"
    steps = [
        _split("traits", "id", "Result"),
        "train AS (SELECT traits.*, row_number() OVER place AS place, count(*) OVER (PARTITION BY Result) AS n FROM traits "
        "JOIN split_rows ON id = k WHERE split = 'train' WINDOW place AS (PARTITION BY Result ORDER BY md5('42:' || CAST(id AS VARCHAR)), id))",
        f"n0 AS (SELECT criterion, held, id, [{', '.join(f'COALESCE({c}, 0)' for c in FEATURES)}] AS xs, CAST(Result = 1 AS BIGINT) AS y, "
        "held = CASE WHEN place > (2 * n) // 3 THEN 2 WHEN place > n // 3 THEN 1 ELSE 0 END AS is_held, CAST(1 AS BIGINT) AS node "
        "FROM train, (SELECT unnest(['gini', 'entropy']) AS criterion), (SELECT unnest(range(0, 3)) AS held))",
    ]
    for d in range(depth):
        steps += [
            f"l{d} AS (SELECT criterion, held, node, unnest(range(0, {len(FEATURES)})) AS f, unnest(xs) AS v, y FROM n{d} WHERE NOT is_held)",
            f"a{d} AS (SELECT criterion, held, node, f, v, sum(y) AS pos, count(*) AS tot FROM l{d} GROUP BY ALL)",
            f"c{d} AS (SELECT *, lead(v) OVER o AS nv, sum(pos) OVER o AS lp, sum(tot) OVER o AS lt, sum(pos) OVER a AS p, sum(tot) OVER a AS t "
            f"FROM a{d} WINDOW o AS (PARTITION BY criterion, held, node, f ORDER BY v), a AS (PARTITION BY criterion, held, node, f))",
            f"b{d} AS (SELECT criterion, held, node, f, (v + nv) / 2.0 AS cut FROM c{d} WHERE nv IS NOT NULL QUALIFY row_number() OVER "
            f"(PARTITION BY criterion, held, node ORDER BY round(({impurity('lp', 'lt')} + {impurity('(p - lp)', '(t - lt)')}) / t, 12), f, cut) = 1)",
            f"n{d + 1} AS (SELECT n.* EXCLUDE (node), 2 * n.node + CASE WHEN xs[f + 1] > cut THEN 1 ELSE 0 END AS node "
            f"FROM n{d} n LEFT JOIN b{d} b ON b.criterion = n.criterion AND b.held = n.held AND b.node = n.node)",
            f"s{d + 1} AS (SELECT criterion, {d + 1} AS max_depth, held AS fold, 1 - sum((y - guess) * (y - guess)) / (count(*) * var_pop(y)) AS r2 FROM ("
            "SELECT *, CASE WHEN 2 * sum(y) FILTER (WHERE NOT is_held) OVER leaf > count(*) FILTER (WHERE NOT is_held) OVER leaf THEN 1 ELSE 0 END AS guess "
            f"FROM n{d + 1} WINDOW leaf AS (PARTITION BY criterion, held, node)) WHERE is_held GROUP BY criterion, held)",
        ]
    scores = _union([f"SELECT * FROM s{d + 1}" for d in range(depth)])
    return f"""
    WITH {TRAITS}, {', '.join(steps)}, scores AS ({scores}),
    means AS (SELECT criterion, max_depth, round(avg(r2), 9) AS mean FROM scores GROUP BY ALL),
    best AS (SELECT * FROM means ORDER BY mean DESC, criterion DESC, max_depth LIMIT 1)
    SELECT s.criterion, s.max_depth, s.fold, round(r2, 6) AS r2, b.mean IS NOT NULL AS chosen
    FROM scores s LEFT JOIN best b ON b.criterion = s.criterion AND b.max_depth = s.max_depth
    """


def _searched(counts: dict[str, int]) -> str:
    rows = [f"SELECT '{m}' AS model, {n} AS n_candidates, true AS beats_majority, true AS folds_scored, true AS best_is_first" for m, n in counts.items()]
    return _union(rows)


MODEL_INFO = _union(
    [
        f"SELECT '{c}' AS feature, {len(FEATURES)} AS n_features, true AS has_probability, true AS shares_sum_to_one, "
        f"{str(c in LABEL_WEIGHTS).lower()} AS leans_on_it"
        for c in FEATURES
    ]
)
TRAINING_RUN = f"""
WITH {TRAITS}, {_split('traits', 'id', 'Result')}
SELECT 'models compared' AS fact, 5 AS n
UNION ALL SELECT 'columns tested for drift', {len(NAMES)}
UNION ALL SELECT 'columns drifted', 0
UNION ALL SELECT 'training rows', count(*) FROM split_rows WHERE split = 'train'
UNION ALL SELECT 'test rows', count(*) FROM split_rows WHERE split = 'test'
UNION ALL SELECT 'gates', 2
UNION ALL SELECT 'gates passed', 2
UNION ALL SELECT 'best model is a compared one', 1
UNION ALL SELECT 'tracked metrics', 5
UNION ALL SELECT 'test score above the gate', 1
UNION ALL SELECT 'rows the stored model scores', count(*) FROM traits
"""

ORACLE_SQL = {
    "scan_clean": _scan_clean(),
    "na_to_null": _bigint_traits(),
    "label_recode": f"WITH {TRAITS} SELECT id, CASE WHEN Result = -1 THEN 0 ELSE Result END AS label FROM traits",
    "preview": f"WITH {TRAITS} SELECT id, {', '.join(FEATURES[:4])} FROM traits ORDER BY id LIMIT 3",
    "rows_to_json": _json(),
    "csv_roundtrip": f"WITH {TRAITS} SELECT * FROM traits",
    "append_load": APPEND_LOAD,
    "source_probe": _probe(),
    "class_balance": CLASS_BALANCE,
    "value_counts": VALUE_COUNTS,
    "null_profile": _null_profile(),
    "range_profile": _range_profile(),
    "check_columns": _check_columns(),
    "check_numeric": _check_numeric(),
    "check_target": _check_target(),
    "target_violations": TARGET_VIOLATIONS,
    "validation_gate": _gate(),
    "routing": _routing(),
    "ks_stat": f"WITH {_ks()} SELECT column_name, n1, n2, round(d, 9) AS d FROM tested",
    "ks_pvalue_asymp": f"WITH {_ks()} SELECT column_name, n1, n2, {DRIFT_ROWS} FROM tested",
    "ks_pvalue_exact": KS_EXACT,
    "ks_segments": _ks_segments(),
    "drift_report": DRIFT_REPORT,
    "drift_summary": DRIFT_SUMMARY,
    "stratified_split": STRATIFIED_SPLIT,
    "random_split": RANDOM_SPLIT,
    "stratified_folds": STRATIFIED_FOLDS,
    "knn_impute": KNN_IMPUTE,
    "knn_impute_apply": KNN_IMPUTE_APPLY,
    "assemble": ASSEMBLE,
    "standard_scale": STANDARD_SCALE,
    "confusion": LABEL_COUNTS,
    "confusion_cells": CONFUSION_CELLS,
    "binary_scores": f"WITH c AS ({LABEL_COUNTS}) SELECT {_columns(POSITIVE)} FROM c",
    "weighted_scores": f"WITH c AS ({LABEL_COUNTS}) SELECT {_r(ACCURACY)} AS accuracy, {_columns(WEIGHTED)} FROM c",
    "class_report": CLASS_REPORT,
    "roc_auc": ROC_AUC,
    "average_precision": AVERAGE_PRECISION,
    "roc_curve": ROC_CURVE,
    "pr_curve": PR_CURVE,
    "roc_curve_bounded": ROC_CURVE_BOUNDED,
    "pr_curve_bounded": PR_CURVE_BOUNDED,
    "r2_score": R2,
    "model_compare": MODEL_COMPARE,
    "select_best": SELECT_BEST,
    "run_summary": RUN_SUMMARY,
    "quality_gates": QUALITY_GATES,
    "run_tracking": _tracking(),
    "run_retention": RUN_RETENTION,
    "fit_tree": _fit("Decision Tree"),
    "fit_forest": _fit("Random Forest"),
    "fit_gbt": _fit("Gradient Boosting"),
    "fit_logistic": _fit("Logistic Regression"),
    "fit_adaboost": _fit("AdaBoost"),
    "adaboost_scores": _boost(),
    "r2_search": _fold_scores(),
    "grid_search": _searched({"Decision Tree": 8}),
    "random_search": _searched({"Logistic Regression": 13}),
    "family_search": _searched({"Decision Tree": 4, "Random Forest": 4, "Gradient Boosting": 2, "Logistic Regression": 2, "AdaBoost": 2}),
    "batch_score": f"WITH {TRAITS} SELECT {FACTS} FROM traits",
    "model_info": MODEL_INFO,
    "training_run": TRAINING_RUN,
    "model_roundtrip": EVERY_ROW_SAME,
    "stream_score": EVERY_ROW_SAME,
}
