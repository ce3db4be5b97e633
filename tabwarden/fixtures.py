"""Inputs of the registered queries, derived from the shared test tables.

``site_traits`` is the 31-column web-site table computed from ``orders`` with integer
arithmetic only, so the same table can be had from SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.spec import PHISHING

FEATURES = PHISHING.features
# Features whose values decide the label, with their weights.
LABEL_WEIGHTS = {"SSLfinal_State": 2, "URL_of_Anchor": 2, "having_Sub_Domain": 1, "web_traffic": 1}


def _odd_primes(n: int) -> list[int]:
    out, candidate = [], 3
    while len(out) < n:
        if all(candidate % p for p in out):
            out.append(candidate)
        candidate += 2
    return out


PRIMES = _odd_primes(len(FEATURES))


def raw_feature_sql(i: int) -> str:
    """Feature ``i`` of an order before any value goes missing: -1, 0 or 1."""
    return f"(CAST(((o_orderkey * {PRIMES[i]} + o_custkey * {i + 3}) % {101 + 2 * i}) % 3 AS INT) - 1)"


def feature_sql(i: int) -> str:
    return f"CASE WHEN o_orderkey % {97 + i} = 0 THEN NULL ELSE {raw_feature_sql(i)} END"


def label_sql() -> str:
    score = " + ".join(f"{w} * {raw_feature_sql(FEATURES.index(c))}" for c, w in LABEL_WEIGHTS.items())
    return f"CASE WHEN {score} > 0 THEN 1 ELSE -1 END"


def site_traits_sql(extra: str = "") -> str:
    columns = ", ".join(f"{feature_sql(i)} AS {c}" for i, c in enumerate(FEATURES))
    return f"SELECT o_orderkey AS id, {columns}, {label_sql()} AS Result{extra} FROM orders"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_traits(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """The web-site table, with more columns computed from the orders where asked for."""
    orders = table(spark, sf_dir, "orders")
    cores = spark.sparkContext.defaultParallelism
    if orders.rdd.getNumPartitions() < cores:
        # A file of few row groups would leave all work on the orders to as few cores.
        orders = orders.repartition(cores, "o_orderkey")
    features = [F.expr(feature_sql(i)).alias(c) for i, c in enumerate(FEATURES)]
    # The id and the label go through ``aggregate``, which keeps the columns out of whole-stage code also where one of the two
    # is not asked for: as one method they are too long to be compiled by the JVM and take several times as long.
    key = F.aggregate(F.array("o_orderkey"), F.lit(0).cast("bigint"), lambda _, value: value)
    terms = F.array(*[F.expr(f"{w} * {raw_feature_sql(FEATURES.index(c))}") for c, w in LABEL_WEIGHTS.items()])
    score = F.aggregate(terms, F.lit(0), lambda total, term: total + term)
    return orders.select(key.alias("id"), *features, F.when(score > 0, 1).otherwise(-1).alias("Result"), *more)


# Part rows with two columns that have gaps, for imputation.
PARTS_SQL = (
    "SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_size END AS x1, "
    "CASE WHEN p_partkey % 75 = 0 THEN NULL ELSE p_retailprice END AS x2, length(p_name) AS x3 FROM part"
)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        F.expr("CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_size END").alias("x1"),
        F.expr("CASE WHEN p_partkey % 75 = 0 THEN NULL ELSE p_retailprice END").alias("x2"),
        F.length("p_name").alias("x3"),
    )
