"""Host-level quality rules with empirical beta priors.

Every document is held against a few rules. The share of a host's documents that fail a
rule is shrunk towards the corpus by a beta prior fitted to all hosts, so a host with few
documents is judged mostly by the corpus. A host whose shrunk rate passes ``HOST_LIMIT``
is condemned. A condemned host costs a document its benefit of the doubt: there, one
failed rule of any kind drops it, while a document without a failure stays wherever it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.llm import text as tx
from tabwarden.session import materialise

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# More than half of a host's documents must fail a rule to condemn the host.
HOST_LIMIT = 0.5
# The prior counts for so many documents at least, so that a handful never condemns a host.
LEAST_PRIOR = 10.0
# Condemned hosts are broadcast up to this many, and joined by shuffle beyond it.
BROADCAST_HOSTS = 100_000

FEATURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
RULES = ["few_words", "repeats", "symbols", "same_lines", "word_length"]

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def features_of(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column."""
    out = {name: np.zeros(len(column), np.int64) for name in FEATURES}
    for i, j, data, offsets in tx.sliced(column):
        for name, values in _features(data, offsets).items():
            out[name][i:j] = values
    return out


def _features(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    start, end, bounds = tx.word_spans(data, offsets)
    sums = tx.prefix_sums(data)
    salt = tx.mix(np.arange(1, rows + 1, dtype=np.uint64))

    # Code points are the bytes that do not continue one.
    lead = (data & 0xC0) != 0x80
    words = tx.row_sums(lead & ~tx.SPACE[data], offsets)
    symbols = tx.row_sums(SYMBOL[data], offsets)

    # A line ends at a \n or at the end of its text.
    breaks = data == 0x0A
    cuts = np.union1d(np.flatnonzero(breaks) + 1, offsets)
    line_start, line_end = cuts[:-1], cuts[1:]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = line_end - breaks[line_end - 1]
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_row = line_start[worded], line_end[worded], line_row[worded]
    lines = np.bincount(line_row, minlength=rows)
    keys = tx.span_hash(sums, line_start, line_end) ^ salt[line_row]
    _, first = np.unique(keys, return_index=True)
    same = lines - np.bincount(line_row[first], minlength=rows)

    hashes = tx.span_hash(sums, start, end)
    word_row = tx.row_of(bounds)
    windows = tx.window_hash(hashes, WINDOW)
    covered = np.zeros(len(hashes), bool)
    inside = word_row[: len(windows)] == word_row[WINDOW - 1 :]
    at = np.flatnonzero(inside)
    keys = windows[at] ^ salt[word_row[at]]
    order = np.argsort(keys)
    equal = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][equal]] = True
    repeated[order[:-1][equal]] = True
    for k in range(WINDOW):
        covered[at[repeated] + k] = True

    return {
        "n_words": np.diff(bounds),
        "word_chars": words,
        "n_symbols": symbols,
        "n_lines": lines,
        "n_dup_lines": same,
        "n_repeat_words": tx.row_sums(covered, bounds),
    }


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = features_of(batch.column("text"))
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in others] + [pa.array(found[n]) for n in FEATURES], names=others + FEATURES
        )


def doc_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the counts of each text, without the text."""
    kept = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    return kept.mapInArrow(_batches, f"{types}, " + ", ".join(f"{n} bigint" for n in FEATURES))


@F.arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in FEATURES]))
def text_features(texts: pa.Array) -> pa.Array:
    found = features_of(texts)
    return pa.StructArray.from_arrays([pa.array(found[n]) for n in FEATURES], names=FEATURES)


def failures(count: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Which rules a document fails, from its counts. The first two are the base rules."""
    n_words = count("n_words")
    return {
        "few_words": n_words < MIN_WORDS,
        "repeats": 100 * count("n_repeat_words") > MAX_REPEAT_PERCENT * n_words,
        "symbols": 2 * count("n_symbols") > n_words,
        "same_lines": 100 * count("n_dup_lines") > 30 * count("n_lines"),
        "word_length": (count("word_chars") > 15 * n_words) | (count("word_chars") < 2 * n_words),
    }


def base_failed() -> Column:
    return F.col("few_words") | F.col("repeats")


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failures and shrunk failure rate of each rule.

    The prior of a rule has the mean of all documents; its weight follows from how much more
    hosts differ than chance explains. Rows without a host belong to none and are left out.
    """
    counts = judged.where(F.col(host).isNotNull()).groupBy(host)
    hosts = counts.agg(F.count(F.lit(1)).alias("n_docs"), *[F.count_if(r).alias(f"n_{r}") for r in RULES])
    hosts = materialise(hosts, "host-rates")
    n = F.col("n_docs")
    totals = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n).alias("docs"),
        *[F.sum(f"n_{r}").alias(r) for r in RULES],
        *[F.sum(F.pow(F.col(f"n_{r}").cast("double"), 2) / n).alias(f"square_{r}") for r in RULES],
    ).first()
    rates = {}
    for r in RULES:
        a, b = beta_prior(totals["hosts"], totals["docs"] or 0, totals[r] or 0, totals[f"square_{r}"] or 0.0)
        rates[f"rate_{r}"] = (F.col(f"n_{r}") + a) / (n + a + b)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return hosts.withColumns(rates).withColumn("host_rate", worst).withColumn("condemned", worst > HOST_LIMIT)


def beta_prior(hosts: int, docs: int, failed: int, square: float) -> tuple[float, float]:
    """Moments fit of the prior: ``square`` is the sum of failed² / documents over hosts."""
    if not docs:
        return 1.0, 1.0
    mean = min(max(failed / docs, 1e-6), 1 - 1e-6)
    chance = mean * (1 - mean)
    between = square / docs - (failed / docs) ** 2 - chance * hosts / docs
    weight = chance / between - 1 if between > 0 else 1e6
    weight = min(max(weight, LEAST_PRIOR), 1e6)
    return mean * weight, (1 - mean) * weight


def quality_rules(docs: DataFrame, host: str = "source", key: str = "doc_id") -> DataFrame:
    """Counts and verdicts of every document.

    ``docs`` has ``key``, ``text`` and ``host``, and may have more columns, which are ignored.
    Rows are judged one by one, repeated ones and those without a key too. A null or empty
    text has no words and fails the base rules. A null host is no host and is never
    condemned. An empty table gives an empty result.
    """
    counted = materialise(doc_features(docs.select(key, host, "text"), [key, host]), "quality-counts")
    judged = counted.withColumns(failures())
    hosts = host_rates(judged, host).select(F.col(host), "host_rate", "condemned")
    out = _join_hosts(judged, hosts, host)
    failed_any = F.greatest(*[F.col(r) for r in RULES])
    condemned = F.coalesce(F.col("condemned"), F.lit(False))
    return out.withColumns({"base_failed": base_failed(), "host_condemned": condemned}).withColumn(
        "kept", ~(F.col("base_failed") | (condemned & failed_any))
    )


def _join_hosts(judged: DataFrame, hosts: DataFrame, host: str) -> DataFrame:
    """Hosts joined to documents. A host's documents are spread over salted copies of its row, so
    one that owns a third of all documents is not one task."""
    salts = 32
    salted = judged.withColumn("salt", F.pmod(F.xxhash64(*judged.columns), F.lit(salts)))
    copies = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(copies, [host, "salt"], "left").drop("salt")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, with the columns of ``docs``, whatever they are called.

    A null or empty text fails, a null host is never condemned, repeated rows are judged one by one and
    an empty table stays empty. The texts are not shuffled: the counts are taken once to judge the
    hosts and once to judge the documents beside the list of condemned hosts.
    """
    own = docs.columns
    p = tx.clear_prefix(own)
    judged = doc_features(docs.select(host, "text"), [host]).withColumns(failures())
    bad = materialise(host_rates(judged, host).where("condemned").select(F.col(host).alias(f"{p}host")), "bad-hosts")
    counts = docs.withColumn(f"{p}counts", text_features("text"))
    fails = {f"{p}{name}": rule for name, rule in failures(lambda n: F.col(f"{p}counts.{n}")).items()}
    rated = counts.withColumns(fails)
    n_bad = bad.count()
    if n_bad:
        bad = F.broadcast(bad) if n_bad <= BROADCAST_HOSTS else bad
        rated = rated.join(bad, rated[host] == bad[f"{p}host"], "left")
    else:
        rated = rated.withColumn(f"{p}host", F.lit(None).cast("string"))
    failed_any = F.greatest(*[F.col(f"{p}{r}") for r in RULES])
    dropped = F.col(f"{p}few_words") | F.col(f"{p}repeats") | (F.col(f"{p}host").isNotNull() & failed_any)
    return rated.where(~dropped).select(*[F.col(f"`{c}`") for c in own])
