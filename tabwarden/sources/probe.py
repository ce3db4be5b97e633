"""What a source holds: tables, row counts, columns in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def probe_columns(name: str, df: DataFrame) -> DataFrame:
    """One row per column with its position and type, beside the table's row count."""
    columns = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("type_name"))
            for i, f in enumerate(df.schema, start=1)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.lit(name).alias("table_name"), "n_rows", F.inline(columns))


def probe_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Probe catalog tables; names that do not exist are reported with no columns."""
    if names is None:
        names = [t.name for t in spark.catalog.listTables()]
    found = [probe_columns(n, spark.read.table(n)) for n in names if spark.catalog.tableExists(n)]
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    absent = spark.createDataFrame(
        [(n, None, None, None, None) for n in missing],
        "table_name string, n_rows bigint, column_name string, position int, type_name string",
    )
    return reduce(DataFrame.unionByName, found, absent)
