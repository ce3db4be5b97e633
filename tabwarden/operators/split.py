"""Exact stratified split and folds, without sorting whole classes."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwarden.functions import order_key
from tabwarden.operators.cumulative import ordered_rank
from tabwarden.session import materialise

TEST_SIZE = 0.2
SEED = 42
FOLDS = 3
# Hex digits of the order key in a histogram: 65536 buckets.
DIGITS = 4
# Per-class tables are broadcast up to this many classes and shuffled beyond.
BROADCAST_CLASSES = 10_000


def test_quotas(sizes: DataFrame, test_size: float = TEST_SIZE) -> DataFrame:
    """(class_key, cut, target): test rows per class, ceil(test_size * N) in all.

    Each class keeps its share of the training rows by largest remainder; an equal
    remainder goes to the smaller label. Two sums reach the driver; where classes compete for
    the seats left over, they are ranked in ordered slices.
    """
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_train = total - ceil(round(total * test_size, 6))
    product = F.col("n").cast("decimal(38,0)") * n_train
    shares = sizes.withColumn("remainder", product % total if total else F.lit(0).cast("decimal(38,0)"))
    base = F.round((product - F.col("remainder")) / total, 0).cast("bigint") if total else F.lit(0).cast("bigint")
    shares = shares.withColumn("base", base)
    spare = n_train - (shares.agg(F.sum("base")).first()[0] or 0)
    seated = ordered_rank(shares, [F.col("remainder").desc(), F.col("label").asc()], "seat") if spare else shares.withColumn("seat", F.lit(1))
    quota = F.col("n") - F.col("base") - F.when(F.col("seat") <= spare, F.lit(1)).otherwise(F.lit(0))
    return seated.select("class_key", F.lit(0).alias("cut"), quota.cast("bigint").alias("target"))


test_quotas.__test__ = False


def fold_cuts(sizes: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(class_key, cut, target): cut a class into ``folds`` runs, equal give or take one."""
    at = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda j: F.floor(j * F.col("n") / folds).cast("bigint"))
    return sizes.select("class_key", F.posexplode(at).alias("cut", "target"))


def rank_intervals(
    df: DataFrame,
    key: str,
    stratum: Column,
    cuts: Callable[[DataFrame], DataFrame],
    n_cuts: int,
    name: str,
    seed: int = SEED,
) -> DataFrame:
    """Add ``name``: how many of its class's cuts a row's rank lies beyond.

    Rows rank within their class by (md5 of seed and key, key). No class is ever sorted:
    a histogram of the md5 order, combined map-side, pins each cut down to one of 65536
    buckets, a second one inside it to one of 65536 again, and only the rows there are
    ranked. ``key`` must be unique. A null stratum is a class of its own.
    """
    class_key = F.when(stratum.isNull(), F.lit("null")).otherwise(F.concat(F.lit("is "), stratum.cast("string")))
    slim = df.select(F.col(key).alias("key"), stratum.alias("label"), class_key.alias("class_key"))
    slim = materialise(slim.withColumn("order", order_key(F.col("key"), seed)), "order-keys")
    digits = lambda level: F.substring("order", 1 + level * DIGITS, DIGITS)

    histogram = slim.groupBy("class_key", digits(0).alias("bucket"))
    histogram = materialise(histogram.agg(F.count(F.lit(1)).alias("n"), F.first("label").alias("label")), "order-histogram")
    sizes = histogram.groupBy("class_key").agg(F.sum("n").alias("n"), F.first("label").alias("label"))
    sizes = materialise(sizes, "class-sizes")
    side = F.broadcast if sizes.count() <= BROADCAST_CLASSES else (lambda d: d)

    upto = F.sum("n").over(Window.partitionBy("class_key").orderBy("bucket"))
    place = (F.col("target") - F.col("upto") + F.col("n")).alias("place")
    holds = (F.col("upto") >= F.col("target")) & (F.col("upto") - F.col("n") < F.col("target"))
    counted = histogram.withColumn("upto", upto)
    marks = counted.join(side(cuts(sizes)), "class_key").where(holds).select("class_key", "cut", "bucket", place)
    marks = materialise(marks, "order-marks")

    near = slim.withColumn("bucket", digits(0)).join(side(marks), ["class_key", "bucket"])
    near = near.select("class_key", "cut", F.col("place").alias("target"), "key", "order", digits(1).alias("fine"))
    fine = near.groupBy("class_key", "cut", "target", "fine").agg(F.count(F.lit(1)).alias("n"))
    fine = fine.withColumn("upto", F.sum("n").over(Window.partitionBy("class_key", "cut").orderBy("fine")))
    fine = fine.where(holds).select("class_key", "cut", "fine", place)

    within = Window.partitionBy("class_key", "cut").orderBy("order", "key")
    last_inside = (
        near.join(side(fine), ["class_key", "cut", "fine"])
        .withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") == F.col("place"))
    )
    # One row per class: the last row inside each cut, none for a cut at rank 0.
    bound = lambda i: F.max(F.when(F.col("cut") == i, F.struct("order", "key"))).alias(f"_cut{i}")
    bounds = last_inside.groupBy(F.col("class_key").alias("_class")).agg(*[bound(i) for i in range(n_cuts)])

    tagged = df.withColumns({"_order": order_key(F.col(key), seed), "_class": class_key}).join(side(bounds), "_class", "left")

    def beyond(i: int) -> Column:
        at = F.col(f"_cut{i}")
        after = (F.col("_order") > at["order"]) | ((F.col("_order") == at["order"]) & (F.col(key) > at["key"]))
        return F.coalesce(after, F.lit(True)).cast("int")

    interval = sum((beyond(i) for i in range(1, n_cuts)), beyond(0))
    return tagged.withColumn(name, interval).select(*df.columns, name)


def stratified_split(df: DataFrame, key: str, target: str | None, test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """Add ``split``: exact test and train sizes per class of ``target``.

    Without a target, or if the table lacks it, the whole table is one class.
    """
    stratum = F.col(target) if target and target in df.columns else F.lit("all")
    marked = rank_intervals(df, key, stratum, lambda s: test_quotas(s, test_size), 1, "_side", seed)
    return marked.withColumn("split", F.when(F.col("_side") == 0, F.lit("test")).otherwise(F.lit("train"))).drop("_side")


def random_split(df: DataFrame, key: str, test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    return stratified_split(df, key, None, test_size, seed)


def stratified_folds(df: DataFrame, key: str, target: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold`` in 0..folds-1; every class is spread evenly over the folds."""
    return rank_intervals(df, key, F.col(target), lambda s: fold_cuts(s, folds), folds - 1, "fold", seed)
