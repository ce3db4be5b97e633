import pytest
from pyspark.sql import functions as F

from tabwarden.operators.split import random_split, stratified_folds, stratified_split, test_quotas as quotas


def test_published_sizes(spark):
    sizes = spark.createDataFrame([("1", 6157, 1), ("-1", 4898, -1)], "class_key string, n bigint, label int")
    assert {r["class_key"]: r["target"] for r in quotas(sizes).collect()} == {"1": 1231, "-1": 980}


def _naive(rows, key, stratum, seed=42):
    import hashlib

    out = {}
    for r in rows:
        out.setdefault(r[stratum], []).append((hashlib.md5(f"{seed}:{r[key]}".encode()).hexdigest(), r[key]))
    return {c: [k for _, k in sorted(v)] for c, v in out.items()}


def test_split_takes_the_first_of_each_class(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = stratified_split(orders, "o_orderkey", "o_orderstatus").select("o_orderkey", "o_orderstatus", "split").collect()
    assert len(got) == 1500 and sum(r["split"] == "test" for r in got) == 300
    for c, keys in _naive(got, "o_orderkey", "o_orderstatus").items():
        test = {r["o_orderkey"] for r in got if r["o_orderstatus"] == c and r["split"] == "test"}
        assert test == set(keys[: len(test)])


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_split_does_not_depend_on_partitions(spark, sf, parts):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    want = stratified_split(labels, "doc_id", "quality")
    got = stratified_split(labels.repartition(parts), "doc_id", "quality")
    assert want.exceptAll(got).isEmpty() and got.columns == [*labels.columns, "split"]


def test_missing_target_falls_back_to_a_plain_split(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    sizes = {r["split"]: r["count"] for r in stratified_split(events, "event_id", "nothing").groupBy("split").count().collect()}
    assert sizes == {"test": 200, "train": 800}
    assert random_split(events.limit(3), "event_id").where("split = 'test'").count() == 1


def test_null_class_and_tiny_class(spark):
    df = spark.range(20).select("id", F.when(F.col("id") == 7, 1).when(F.col("id") < 12, 0).alias("y"))
    got = stratified_split(df, "id", "y")
    assert got.count() == 20 and got.where("split = 'test'").count() == 4


def test_empty_table(spark):
    assert stratified_split(spark.range(0).withColumn("y", F.lit(1)), "id", "y").isEmpty()


def test_folds_are_even_in_every_class(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = stratified_folds(labels, "doc_id", "quality", 3)
    sizes = {}
    for r in got.groupBy("quality", "fold").count().collect():
        sizes.setdefault(r["quality"], {})[r["fold"]] = r["count"]
    for by_fold in sizes.values():
        assert set(by_fold) == {0, 1, 2} and max(by_fold.values()) - min(by_fold.values()) <= 1


def test_null_is_not_the_text_null(spark):
    label = F.when(F.col("id") < 50, F.lit(None)).when(F.col("id") < 100, F.lit("<null>")).otherwise(F.lit("null"))
    df = spark.range(150).withColumn("y", label)
    got = stratified_split(df, "id", "y").where("split = 'test'").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in got} == {None: 10, "<null>": 10, "null": 10}
    folds = stratified_folds(df, "id", "y").groupBy("y", "fold").count().collect()
    assert len(folds) == 9 and all(16 <= r["count"] <= 17 for r in folds)


def test_many_classes_without_one_task_for_all(spark):
    df = spark.range(150_000).withColumn("y", F.col("id") % 100_000)
    got = stratified_split(df, "id", "y")
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"test": 30_000, "train": 120_000}
    assert "SinglePartition" not in got._jdf.queryExecution().toString()


def test_one_hot_class_is_cut_exactly(spark):
    df = spark.range(300_000).withColumn("y", F.lit("hot"))
    got = stratified_folds(df, "id", "y", 3)
    assert [r["count"] for r in got.groupBy("fold").count().orderBy("fold").collect()] == [100_000] * 3
