"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order weigh 3, 1, 2, repeating, and share 150 % of all words;
no source gives more than twice its words, and what it cannot give is shared again.

Inside a source every document expects some copies, more for longer documents: ``copies`` =
min(2, c * weight of its length class) with c set so that the expected words are the target.
The whole part is certain. The rest is the inclusion chance p of an unequal-probability
sample of fixed size (in words): documents are ranked by u / (1 - u) over p / (1 - p), u being
a hash of the document, and taken in that order while the words fit the target. The gap
that is left goes to the one document that fills it best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwarden.llm import text as tx
from tabwarden.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Rows of the plan (sources times length classes) that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def count_words(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for i, j, data, offsets in tx.sliced(column):
        out[i:j] = np.diff(tx.word_spans(data, offsets)[2])
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [n for n in batch.schema.names if n != "text"]
        sizes = pa.array(count_words(batch.column("text")))
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], sizes], names=[*others, "size"])


def doc_sizes(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the words of each text, without the text."""
    kept = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    return kept.mapInArrow(_batches, f"{types}, size bigint")


@F.arrow_udf(T.LongType())
def n_words(texts: pa.Array) -> pa.Array:
    return pa.array(count_words(texts))


def size_class() -> Column:
    """Length class of a document: the bits of its number of words."""
    return F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)


def _ordered_sources(sizes: DataFrame, source: str) -> DataFrame:
    """(source, source_size, weight) of every source; ranks are taken in ordered slices, so the
    number of sources is not bound by one task."""
    totals = materialise(sizes.groupBy(source).agg(F.sum("size").alias("source_size")), "mix-sources")
    order = F.col(source).asc_nulls_last()
    cut = materialise(totals.repartitionByRange(order).withColumn("slice", F.spark_partition_id()), "mix-order")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("slice").orderBy(order)) - 1 + F.col("before")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = cut.join(slices.select("slice", "before"), "slice")
    return ranked.select(source, "source_size", F.get(weights, F.pmod(rank, F.lit(len(WEIGHTS))).cast("int")).alias("weight"))


def source_targets(sizes: DataFrame, source: str) -> DataFrame:
    """(source, source_size, target) from one row per document with ``size``."""
    ranked = materialise(_ordered_sources(sizes, source), "mix-weights")
    most = MOST * F.col("source_size")
    totals = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = SHARE * (totals["size"] or 0)
    level = wanted / totals["weight"] if totals["weight"] else 0.0
    full = -1
    while True:
        at_most = most <= level * F.col("weight")
        now = ranked.agg(
            F.count_if(at_most).alias("full"),
            F.sum(F.when(at_most, most)).alias("given"),
            F.sum(F.when(~at_most, F.col("weight"))).alias("weight"),
        ).first()
        if now["full"] == full or not now["weight"]:
            break
        full, level = now["full"], (wanted - (now["given"] or 0)) / now["weight"]
    return ranked.select(source, "source_size", F.least(most.cast("double"), level * F.col("weight")).alias("target"))


def class_copies(sizes: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    """(source, class, source_size, target, copies): expected copies of the documents of a length class.

    Longer classes reach two copies first; with j of them full, c follows from what is left,
    and the smallest j whose next class stays under two is the right one.
    """
    words = sizes.groupBy(source, size_class().alias("class")).agg(F.sum("size").alias("words"))
    named = targets.withColumnRenamed(source, "__source")
    joined = words.join(named, words[source].eqNullSafe(named["__source"])).drop("__source")
    whole = Window.partitionBy(source)
    longer = whole.orderBy(F.col("class").desc()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("class").cast("double")
    filled = MOST * F.coalesce(F.sum("words").over(longer), F.lit(0))
    rest = F.sum(F.col("words") * weight).over(whole) - F.coalesce(F.sum(F.col("words") * weight).over(longer), F.lit(0.0))
    tried = joined.withColumn("c", F.try_divide(F.col("target") - filled, rest))
    right = F.max(F.when(F.col("c") * weight <= MOST, F.struct("class", "c"))).over(whole)
    level = F.coalesce(right["c"], F.lit(float("inf")))
    full = right.isNull() | (F.col("class") > right["class"])
    copies = F.when(F.col("class") == 0, 0.0).when(full, F.lit(float(MOST))).otherwise(F.least(F.lit(float(MOST)), level * weight))
    return tried.select(source, "class", "source_size", "target", copies.alias("copies"))


def rank_value(key: str, source: str, seed: int) -> Column:
    """Pareto rank of a document on a scale from 0 to 1, from its inclusion chance ``p``: with q =
    odds of its random number over odds of inclusion, q / (1 + q)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(source), F.col("size")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    mine, chance = u * (1 - F.col("p")), F.col("p") * (1 - u)
    return F.when(F.col("p") > 0, mine / (mine + chance))


def mix_plan(sizes: DataFrame, source: str, key: str, seed: int) -> DataFrame:
    """(source, class, source_size, target, copies, last, extra), all that decides what is taken.

    A document gets floor(copies), and one more if its rank is at most ``last`` or equals ``extra``.
    """
    targets = materialise(source_targets(sizes, source), "mix-targets")
    classes = materialise(class_copies(sizes, targets, source), "mix-classes")
    ranked = _ranked(sizes, classes, source, key, seed)
    # Documents of one rank share their fate; a repeated row has the rank of its twin.
    places = ranked.where("p > 0").groupBy(source, "rank").agg(F.sum("size").alias("words"))
    order = [F.col(source).asc_nulls_last(), F.col("rank")]
    cut = materialise(places.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "mix-ranks")
    slices = cut.groupBy(source, "slice").agg(F.sum("words").alias("words"))
    before = Window.partitionBy(source).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col(source).alias("__source"), F.col("slice").alias("__slice"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(source, "slice").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.withColumn("upto", F.sum("words").over(inside))
    summed = summed.join(slices, summed[source].eqNullSafe(slices["__source"]) & (F.col("slice") == F.col("__slice")))
    summed = summed.withColumn("upto", F.col("upto") + F.col("before")).select(source, "rank", "words", "upto")

    certain = sizes.where("size > 0").groupBy(source, size_class().alias("class")).agg(F.sum("size").alias("words"))
    c = classes.withColumnsRenamed({source: "__source", "class": "__class"})
    certain = certain.join(c, certain[source].eqNullSafe(c["__source"]) & (F.col("class") == F.col("__class")))
    budget = certain.groupBy(source).agg((F.max("target") - F.sum(F.floor("copies") * F.col("words"))).alias("budget"))
    budget = budget.withColumnRenamed(source, "__source")
    summed = materialise(summed.join(budget, summed[source].eqNullSafe(budget["__source"])).drop("__source"), "mix-sums")

    fits = F.col("upto") <= F.col("budget")
    chosen = summed.groupBy(source).agg(
        F.coalesce(F.max(F.when(fits, F.col("rank"))), F.lit(-1.0)).alias("last"),
        (F.max("budget") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0))).alias("gap"),
    )
    chosen = materialise(chosen.withColumnRenamed(source, "__source"), "mix-last")
    open_places = summed.join(chosen, summed[source].eqNullSafe(chosen["__source"])).where("rank > last and words < 2 * gap")
    best = open_places.groupBy(source).agg(F.min(F.struct(F.abs(F.col("words") - F.col("gap")), "rank"))["rank"].alias("extra"))
    best = best.withColumnRenamed(source, "__other")
    ends = chosen.join(best, chosen["__source"].eqNullSafe(best["__other"]), "left").select("__source", "last", "extra")
    plan = classes.join(ends, classes[source].eqNullSafe(ends["__source"]), "left")
    return plan.select(
        source, "class", "source_size", "target", "copies",
        F.coalesce("last", F.lit(-1.0)).alias("last"), F.coalesce("extra", F.lit(-1.0)).alias("extra"),
    )


def _join_plan(rows: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """Rows with ``size`` beside their line of the plan; a large plan is joined by shuffle, where
    Spark splits the rows of a hot source."""
    named = plan.withColumnsRenamed({source: "__source", "class": "__class"})
    if plan.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    rows = rows.withColumn("class", size_class())
    same = rows[source].eqNullSafe(named["__source"]) & (rows["class"] == named["__class"])
    return rows.join(named, same, "left").drop("__source", "__class", "class")


def _ranked(sizes: DataFrame, classes: DataFrame, source: str, key: str, seed: int) -> DataFrame:
    joined = _join_plan(sizes, classes, source)
    return joined.withColumn("p", F.col("copies") - F.floor("copies")).withColumn("rank", rank_value(key, source, seed))


def _n_taken(key: str, source: str, seed: int) -> Column:
    rank = F.col("rank")
    more = F.coalesce((rank <= F.col("last")) | (rank == F.col("extra")), F.lit(False))
    return F.coalesce(F.floor("copies") + more.cast("bigint"), F.lit(0))


def mix_sizes(docs: DataFrame, source: str = "source", key: str = "doc_id", seed: int = 7) -> DataFrame:
    """(key, size, source_size, target, taken) of every document.

    ``docs`` has ``key``, ``source`` and ``text``; more columns are ignored. A null source is a
    source of its own, the last one. A null or empty text has no words and is never taken.
    Repeated rows share one rank, so they are taken alike. An empty table gives an empty result.
    The choice follows from the seed and the rows alone.
    """
    sizes = materialise(doc_sizes(docs.select(key, source, "text"), [key, source]), "mix-sizes")
    plan = materialise(mix_plan(sizes, source, key, seed), "mix-plan")
    rows = _ranked(sizes, plan, source, key, seed)
    taken = _n_taken(key, source, seed)
    return rows.select(
        key, "size", "source_size", "target", (F.col("size") * taken).alias("taken")
    )


def mix_documents(docs: DataFrame, source: str = "source", key: str = "doc_id", seed: int = 7) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    own = docs.columns
    sizes = materialise(doc_sizes(docs.select(key, source, "text"), [key, source]), "mix-sizes")
    plan = materialise(mix_plan(sizes, source, key, seed), "mix-plan")
    rows = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(own)], F.col(key).alias("key"), F.col(source).alias("src"), n_words("text").alias("size"))
    rows = _ranked(rows, plan.withColumnRenamed(source, "src"), "src", "key", seed)
    copies = F.explode(F.array_repeat(F.lit(0), _n_taken("key", "src", seed).cast("int")))
    return rows.withColumn("__copy", copies).select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(own)])
