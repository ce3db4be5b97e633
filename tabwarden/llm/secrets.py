"""Secrets in texts: fixed patterns, and random strings told from identifiers by Markov models.

Two character models give the chance of each character after the one before it: one of random
strings, trained on the values the patterns find (all of them), and one of ordinary
identifiers, trained on the words that at least two of a bounded sample of texts (``SAMPLE``
rows) share. A token that no pattern covers is a secret if its mean log-likelihood ratio per transition
passes ``RATIO``. Everything runs as DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The patterns and the least length of what counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
# A maximal run is matched whole, so the least length can be asked for at once.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

# Tokens the models judge, and the words that identifiers are learned from.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
WORD = r"[A-Za-z_][A-Za-z0-9_-]{5,}"
SAMPLE = 20_000
RATIO = 0.7

# Characters + to z; a transition is one number below LOW_SIZE squared.
LOW, LOW_SIZE = 43, 80


def _places(text: Column, pattern: str, keep: Column | None = None) -> Column:
    """(start, end) of every match of ``pattern``, end exclusive, from the pieces between matches.

    ``keep`` says for each match whether it counts.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("hit"))
    if keep is not None:
        pairs = F.arrays_zip(gaps.alias("gap"), found.alias("hit"), keep.alias("keep"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["hit"]), F.lit(0))
        counts = pair["hit"].isNotNull()
        if keep is not None:
            counts = counts & pair["keep"]
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(counts, F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
    return F.when(text.rlike(pattern), spans).otherwise(none)


def assign_values(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed patterns, by kind."""
    long_enough = F.transform(assign_values(text), lambda v: F.length(v) >= ASSIGN_VALUE)
    return {"assign": _places(text, ASSIGN, long_enough), "access": _places(text, ACCESS), "hex": _places(text, HEX)}


# --- the models -----------------------------------------------------------------------------


def _code(char: Column) -> Column:
    return F.ascii(char) - LOW


def _transitions(strings: DataFrame) -> dict[int, int]:
    """How often each transition occurs in the column ``s``; at most LOW_SIZE squared numbers."""
    pairs = strings.where("length(s) > 1").select(F.col("s"), F.explode(F.sequence(F.lit(1), F.length("s") - 1)).alias("i"))
    code = _code(F.substr("s", F.col("i"), F.lit(1))) * LOW_SIZE + _code(F.substr("s", F.col("i") + 1, F.lit(1)))
    counted = pairs.select(code.alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    return {r["pair"]: r["n"] for r in counted.collect()}


def _conditional(counts: dict[int, int], weight: float, uniform: bool) -> list[float]:
    """Log chance of every transition. ``weight`` pseudo-counts follow the character frequencies, or are
    spread over all characters alike."""
    after, follow, total = [0] * LOW_SIZE, [0] * LOW_SIZE, sum(counts.values())
    for pair, n in counts.items():
        after[pair // LOW_SIZE] += n
        follow[pair % LOW_SIZE] += n
    prior = [1 / LOW_SIZE if uniform else (f + 0.5) / (total + 0.5 * LOW_SIZE) for f in follow]
    return [
        math.log((counts.get(a * LOW_SIZE + b, 0) + weight * prior[b]) / (after[a] + weight))
        for a in range(LOW_SIZE)
        for b in range(LOW_SIZE)
    ]


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio of every transition, random string over identifier.

    Without labelled random strings their model is uniform; without identifiers theirs is.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    labelled = docs.select(text.alias("text")).where(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX))
    values = F.concat(
        F.filter(assign_values(F.col("text")), lambda v: F.length(v) >= ASSIGN_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    random = labelled.select(F.explode(values).alias("v")).select(F.regexp_replace("v", "[^A-Za-z0-9+/_-]", "").alias("s"))
    share = min(1.0, SAMPLE / max(1, docs.count()))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int(share * (1 << 40)))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = picked.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("s"), F.xxhash64("text").alias("t"))
    # Names recur, random strings do not: a word of two different texts is an ordinary one.
    words = words.groupBy("s").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low <> high").select("s")
    a = _conditional(_transitions(random), 50.0, uniform=True)
    b = _conditional(_transitions(words), 1.0, uniform=False)
    return [x - y for x, y in zip(a, b, strict=True)]


def mean_ratio(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of a token."""
    table = F.split(F.lit(" ".join(f"{r:.4f}" for r in ratios)), " ").cast("array<double>")

    def add(total: Column, i: Column) -> Column:
        pair = _code(F.substr(token, i, F.lit(1))) * LOW_SIZE + _code(F.substr(token, i + 1, F.lit(1)))
        return total + F.get(table, pair)

    steps = F.sequence(F.lit(1), F.length(token) - 1)
    return F.aggregate(steps, F.lit(0.0), add) / (F.length(token) - 1)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row of ``docs`` (doc_id,
    text; other columns are ignored).

    A null text is empty and holds nothing. Rows are searched one by one, so repeated ones and
    those without a doc_id change nothing. An empty table gives an empty result.
    """
    ratios = train(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumns(base_spans(F.col("text")))
    named = lambda kind: F.transform(
        kind, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"))
    )
    base = F.concat(named("assign"), named("access"), named("hex"))
    tokens = F.when(F.col("text").rlike(TOKEN), F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    likely = F.transform(tokens, lambda t: mean_ratio(t, ratios) > RATIO)
    rows = rows.withColumn("random", _places(F.col("text"), TOKEN, likely)).withColumn("base", base)
    free = F.filter("random", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    rows = rows.withColumn("random", free)
    written = lambda spans: F.concat_ws(
        ",",
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )
    count = lambda kind: F.size(kind).cast("bigint")
    return rows.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", named("random"))).alias("spans"),
        count("random").alias("n_random"),
    )
