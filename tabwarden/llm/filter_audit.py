"""What filters do to one another in every order, from one table of failing rows per filter.

Every filter's failing rows are stored once. For a filter f and a set S of others, the rows that f
removes after S are those of f's table that are left after an anti join with the table of every filter in
S; the rows that a semi join keeps are redundant there. The order within S does not matter, so the
120 orders of five filters need 80 such results. They come from one walk: the failing rows go past the tables one after
another, all dealt out by row number once, and at each a row stays in its prefix and, if it is not in the
table, enters the prefix longer by that filter. The counts of all prefixes are summed in one aggregation, and
everything by order is arithmetic on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwarden.llm.exact_dedup import normalised
from tabwarden.llm.groups import join_groups
from tabwarden.session import materialise, new_path

# SQL conditions under which a text fails by itself, on ``text``, its ``words`` and their number ``n``.
RULES = {
    "A": "n < 100",
    "B": "100 * size(array_distinct(words)) < 80 * n",
    "C": "100 * length(regexp_replace(text, '[^A-Z]+', '')) > 10 * length(text)",
    "D": "rlike(text, '[#$%&*|]')",
}
COPIES = "E"


def text_facts(docs: DataFrame, rules: Mapping[str, str], key: str, text: str, part: str) -> DataFrame:
    """(row, key, part, one boolean per rule, digest) of every document."""
    return (
        docs.select(
            F.col(f"`{key}`").alias("key"),
            F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("words", F.array_remove(F.split(normalised(F.col("text")), " "), ""))
        .withColumn("n", F.size("words"))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "key",
            "part",
            *[F.expr(rule).alias(name) for name, rule in rules.items()],
            F.unhex(F.sha2("text", 256)).alias("digest"),
        )
    )


def mark_copies(facts: DataFrame, name: str = COPIES) -> DataFrame:
    """Adds whether a smaller key has the same text. ``facts`` is a written table."""
    groups = facts.groupBy("digest").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    joined = join_groups(facts, materialise(groups, "copies"), "digest", "size", facts.count())
    return joined.withColumn(name, F.coalesce(F.col("key") > F.col("least"), F.lit(False))).drop("digest", "least", "size")


def store_failing(facts: DataFrame, filters: Sequence[str], labels: DataFrame, key: str) -> dict[str, DataFrame]:
    """One stored table (row, key, part, good, toxic) of failing documents per filter, written in one pass."""
    marks = labels.groupBy(F.col(f"`{key}`").alias("key")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    failed = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in filters]))
    failing = facts.where(reduce(Column.__or__, [F.col(f) for f in filters])).select("row", "key", "part", failed.alias("failed"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    labelled = failing.join(marks, "key", "left").select("row", "key", "part", *flags, F.explode("failed").alias("filter"))
    spark, path = facts.sparkSession, new_path(facts.sparkSession, "failing")
    labelled.write.partitionBy("filter").parquet(path)
    stored = spark.read.schema(labelled.schema).parquet(path)
    return {f: stored.where(F.col("filter") == f).drop("filter") for f in filters}


def prefix_counts(failing: Mapping[str, DataFrame]) -> DataFrame:
    """(part, filter, before, removed, good_lost, toxic_lost): what ``filter`` removes after the set ``before``.

    ``before`` is the sum of 2^i over the filters i of the set. Results of no rows are left out.
    """
    names = list(failing)
    flags = ["row", "part", "good", "toxic", "f"]
    tagged = [t.select("row", "part", "good", "toxic", F.lit(i).alias("f"), F.lit(0).alias("before")) for i, t in enumerate(failing.values())]
    walk = reduce(DataFrame.unionByName, tagged)
    for i, name in enumerate(names):
        walk = walk.join(failing[name].select("row", F.lit(True).alias("in")), "row", "left")
        # Kept by the semi join, or the filter itself: no longer prefix. Kept by the anti join: both.
        stays = F.array("before")
        enters = F.array("before", F.col("before") + F.lit(1 << i))
        reached = F.when((F.col("f") == i) | F.col("in").isNotNull(), stays).otherwise(enters)
        walk = walk.select(*flags, F.explode_outer(reached).alias("before"))
    named = F.array(*[F.lit(n) for n in names])
    return (
        walk.groupBy("part", "f", "before")
        .agg(F.count(F.lit(1)).alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost"))
        .select("part", F.element_at(named, F.col("f") + 1).alias("filter"), "before", "removed", "good_lost", "toxic_lost")
    )


def by_order(counts: DataFrame, sizes: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Every part, order and step from the counts of all prefixes; ``sizes`` has ``part`` and ``n``.

    What a filter removes first is all that fails it, what it removes last fails nothing else, and
    its share of the removals (Shapley) is the sum over all orders of what it removes.
    """
    bit = {f: 1 << i for i, f in enumerate(filters)}
    steps = [("".join(o), i + 1, f, sum(bit[g] for g in o[:i])) for o in permutations(filters) for i, f in enumerate(o)]
    orders = sizes.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, before int")
    sets = [(f, sum(bit[g] for g in s)) for f in filters for r in range(len(filters)) for s in combinations([g for g in filters if g != f], r)]
    pairs = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(s).alias("before")) for f, s in sets])
    every = sizes.select("part", "n", F.explode(pairs).alias("pair")).select("part", "n", "pair.*")
    values = ["removed", "good_lost", "toxic_lost"]
    known = every.join(counts, ["part", "filter", "before"], "left").fillna(0, values)
    so_far = W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    same = W.partitionBy("part", "filter")
    return known.join(F.broadcast(orders), ["filter", "before"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.max("removed").over(same) - F.col("removed")).alias("redundant"),
        F.min("removed").over(same).alias("unique_fails"),
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(same).alias("shapley"),
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    rules: Mapping[str, str] = RULES,
    copies: str = COPIES,
) -> DataFrame:
    """One row for each part, order of the filters and step, those without any removal included.

    The filters are the ``rules`` and ``copies``, which a document fails if one with a smaller key has the same
    text, wherever it is. A null text is empty and a null part is the part ``""``. Every row is a document by
    itself: repeated rows count each time, and as equal keys are not smaller they are no copies. A null
    key is not larger or smaller than any, and has no label. A document is good or toxic if one of its
    labels says so; null labels say nothing. An empty table gives no part and no row. Other columns of either
    table are ignored.
    """
    filters = [*rules, copies]
    facts = materialise(text_facts(docs, rules, key, text, part), "audit-facts")
    failing = store_failing(mark_copies(facts, copies), filters, labels, key)
    sizes = facts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return by_order(prefix_counts(failing), sizes, filters)
