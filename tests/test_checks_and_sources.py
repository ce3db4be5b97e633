import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tabwarden import PHISHING, TableSpec
from tabwarden.fixtures import site_traits
from tabwarden.operators import validate
from tabwarden.sources import append_load, csv_to_json, jdbc_options, na_to_null, probe_tables, read_csv, rows_to_json, scan_clean, write_csv


@pytest.fixture(scope="module")
def traits(spark, sf):
    return site_traits(spark, sf).drop("id")


def _gate(train, test):
    return {(r["check_name"], r["dataset"]): r["ok"] for r in validate.validation_gate(train, test, PHISHING).collect()}


def test_gate_passes(traits):
    assert set(_gate(traits, traits).values()) == {True}


def test_gate_stops_early(traits):
    got = _gate(traits.drop("port"), traits)
    assert got[("columns", "train")] is False and got[("columns", "test")] is True
    assert got[("numeric", "train")] is None and got[("target", "test")] is None and got[("gate", "both")] is False
    got = _gate(traits, traits.withColumn("port", F.col("port").cast("string")))
    assert got[("numeric", "test")] is False and got[("target", "train")] is None
    got = _gate(traits.withColumn("Result", F.lit(None).cast("int")), traits)
    assert got[("target", "train")] is False and got[("target", "test")] is True


def test_both_sets_go_the_same_way(spark, traits, tmp_path):
    bad = traits.withColumn("Result", F.lit(0))
    ok, where = validate.route(traits, bad, PHISHING, str(tmp_path))
    assert not ok and where.endswith("status=invalid") and spark.read.parquet(f"{where}/train").count() == traits.count()
    ok, where = validate.route(traits, traits, PHISHING, str(tmp_path))
    assert ok and where.endswith("status=valid")


def test_declarations():
    new = TableSpec.from_dict({"columns": [{"a": "int64"}, {"Result": "int64"}], "target_column": "Result"})
    assert new.expected_columns == 2 and new.numeric is None and new.features == ["a"]
    assert TableSpec.from_dict({"a": "int64", "b": "int64", "c": "int64"}).expected_columns == 3
    assert PHISHING.expected_columns == 31 and len(PHISHING.features) == 30


def test_numeric_check_without_list_and_special_types(spark):
    spec = TableSpec((("a", "int64"),), None)
    df = spark.createDataFrame([(True, None)], "a boolean, b double")
    assert validate.check_numeric(df, spec, "x").isEmpty() and validate.numeric_ok(df, spec)
    rows = validate.check_numeric(df, TableSpec((), ("a", "b", "c")), "x").collect()
    assert [(r["column_name"], r["present"], r["ok"]) for r in rows] == [("a", True, True), ("b", True, True), ("c", False, False)]


def test_marker_is_exact_and_text_stays(spark):
    df = spark.createDataFrame([("1", "na", "x", 1.0), ("na", "NA", "na", float("nan"))], "a string, b string, c string, d double")
    got = na_to_null(df)
    assert dict(got.dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "double"}
    assert [tuple(r) for r in got.collect()] == [(1, None, "x", 1.0), (None, "NA", None, None)]
    assert na_to_null(spark.createDataFrame([("1.5",), ("na",)], "a string")).dtypes == [("a", "double")]


def test_target_is_required(spark):
    with pytest.raises(ValueError, match="Result"):
        scan_clean(spark.range(3), PHISHING)


def test_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, -1)], "a int, b int")
    path = str(tmp_path / "t")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [(1, None), (2, -1)] or {tuple(r) for r in back.collect()} == {(1, None), (2, -1)}
    records = [json.loads(r["record"]) for r in csv_to_json(spark, path).collect()]
    assert {"a": 1, "b": None} in records
    assert rows_to_json(df, ["b"]).where("a = 1").first()["record"] == '{"b":null}'


def test_append_twice(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).cast("int").alias("a"))
    name = f"loads_{tmp_path.name.replace('-', '_')}"
    for _ in range(2):
        assert append_load(df.repartition(3), name, str(tmp_path / "t")) == 100
    got = spark.read.table(name)
    assert got.columns == ["id", "a", "created_at", "load_id"] and got.count() == 200
    assert got.select("id").distinct().count() == 200 and got.where("created_at is null").isEmpty()
    probed = {r["column_name"]: r["n_rows"] for r in probe_tables(spark, [name, "no_such_table"]).collect()}
    assert probed == {"id": 200, "a": 200, "created_at": 200, "load_id": 200, None: None}


def test_loads_side_by_side_share_no_id(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("a`b"))
    name, folder = f"side_{tmp_path.name.replace('-', '_')}", str(tmp_path / "it's here")
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: append_load(df.repartition(4), name, folder), range(6)))
    got = spark.read.table(name)
    assert counts == [500] * 6 and got.count() == 3000
    assert got.select("id").distinct().count() == 3000 and got.select("load_id").distinct().count() == 6


def test_a_failed_load_leaves_nothing_to_see(spark, tmp_path):
    name = f"broken_{tmp_path.name.replace('-', '_')}"
    good = spark.range(10).select(F.col("id").alias("a"))
    assert append_load(good, name, str(tmp_path / "t")) == 10
    bad = good.select(F.when(F.col("a") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("a")).alias("a"))
    with pytest.raises(Exception, match="stop"):
        append_load(bad, name, str(tmp_path / "t"))
    assert append_load(good, name, str(tmp_path / "t")) == 10
    assert spark.read.table(name).count() == 20


def test_jdbc_settings(monkeypatch):
    for name in ("JDBC_URL", "JDBC_USER", "JDBC_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(ValueError):
        jdbc_options("t")
    got = jdbc_options("Net", url="jdbc:postgresql://db/ns", partition_column="id", bounds=(1, 9), partitions=4)
    assert got["dbtable"] == '"Net"' and "password" not in got
    assert (got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("1", "9", "4")
    monkeypatch.setenv("JDBC_PASSWORD", "from-env")
    assert jdbc_options("t", url="u")["password"] == "from-env"
