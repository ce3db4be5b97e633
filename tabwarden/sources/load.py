"""Loading rows into a table: create if absent, append, JSON records."""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.sources.tables import read_csv


# Bits of an id: number of the load, partition in it, row in the partition; 63 in all.
LOAD_BITS, PART_BITS, ROW_BITS = 20, 19, 24


def _quoted_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str) -> str:
    return ".".join(_quoted_part(part) for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, location: str | None = None) -> None:
    """Create the table with a surrogate ``id``, a ``created_at`` and a partition per load if it is absent."""
    fields = ", ".join(f"{_quoted_part(f.name)} {f.dataType.simpleString()}" for f in schema)
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} (id BIGINT, {fields}, created_at TIMESTAMP, load_id BIGINT) "
        f"USING parquet PARTITIONED BY (load_id){where}"
    )


def _table_folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


_reserving = threading.Lock()


def _create(spark: SparkSession, fs, path) -> bool:
    """Create an empty file unless it is there, in one step of the file system: an exclusive create on a local disk, where
    Hadoop's own is two steps, and elsewhere a create that may not overwrite."""
    if fs.getScheme() == "file":
        return spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
    try:
        fs.create(path, False).close()
    except Py4JJavaError:
        if not fs.exists(path):
            raise
        return False
    return True


def _reserve(spark: SparkSession, folder: str) -> int:
    """The first load number nobody has taken; two loads never share one where creating a file is atomic."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_loads")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    with _reserving:
        fs.mkdirs(path)
        taken = [int(s.getPath().getName()) for s in fs.listStatus(path)]
        number = max(taken, default=-1) + 1
        while not _create(spark, fs, spark._jvm.org.apache.hadoop.fs.Path(path, str(number))):
            number += 1
    return number


def append_load(df: DataFrame, table: str, location: str | None = None) -> int:
    """Append every row with a fresh id and load time; returns the rows written.

    A load has a number of its own, which is the head of its ids, followed by the partition and
    the row in it; so ids are unique without reading the table, also where loads run side
    by side. The rows are staged and their folder is then renamed into place, so a load is seen
    as a whole or not at all. Running it again appends the rows again.
    """
    spark = df.sparkSession
    ensure_table(spark, table, df.schema, location)
    folder = _table_folder(spark, table)
    load = _reserve(spark, folder)
    if load >= 1 << LOAD_BITS:
        raise ValueError(f"more than {1 << LOAD_BITS} loads in {table}")
    part = F.spark_partition_id().cast("bigint")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    number = F.lit(load << (PART_BITS + ROW_BITS)) + F.shiftleft(part, ROW_BITS) + row
    seen = Observation(f"load-{load}")
    counted = df.withColumns({"_part": part, "_row": row, "_id": number}).observe(
        seen, F.count(F.lit(1)).alias("n"), F.max("_part").alias("part"), F.max("_row").alias("row")
    )
    # A folder, and so a committer, of its own: another load's commit removes what lies beside its files.
    staged = f"{folder}/_staged/{uuid.uuid4().hex}"
    rows = counted.select(F.col("_id").alias("id"), *[F.col(_quoted_part(c)) for c in df.columns], F.current_timestamp().alias("created_at"))
    rows.write.parquet(staged)
    found = seen.get
    if (found["part"] or 0) >= 1 << PART_BITS or (found["row"] or 0) >= 1 << ROW_BITS:
        raise ValueError(f"a load takes {1 << PART_BITS} partitions of {1 << ROW_BITS} rows; repartition it")
    source, target = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, f"{folder}/load_id={load}")]
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"{staged} could not be renamed into the table")
    spark.catalog.recoverPartitions(table) if _tracked(spark, table) else spark.catalog.refreshTable(table)
    return found["n"]


def _tracked(spark: SparkSession, table: str) -> bool:
    """Whether the catalog keeps the table's partitions itself, rather than listing folders."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Partition Provider'")
    return not rows.isEmpty()


def rows_to_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON record per row; a null stays in the record as JSON null."""
    names = df.columns if columns is None else columns
    return df.withColumn("record", F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"}))


def csv_to_json(spark: SparkSession, path: str) -> DataFrame:
    return rows_to_json(read_csv(spark, path)).select("record")
