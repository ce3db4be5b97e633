"""Profiling aggregates. Each is one pass over the columns it names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.functions import safe_ratio


def class_balance(df: DataFrame, target: str, positive: int = 1, negative: int = -1) -> DataFrame:
    """Total, positive and negative rows and the positive share (null on no rows)."""
    label = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(label == positive).alias("positive_count"),
        F.count_if(label == negative).alias("negative_count"),
    ).withColumn("positive_ratio", safe_ratio(F.col("positive_count"), F.col("total_rows"), None))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value; nulls are not counted."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(column))


def _as_rows(wide: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Turn one aggregate row into one row per name; ``fields`` maps a name to its cells."""
    cells = [F.struct(F.lit(name).alias("column_name"), *[F.col(c).alias(a) for a, c in parts]) for name, parts in fields.items()]
    return wide.select(F.inline(F.array(*cells)))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells per column, the row count, and the ``(all)`` row with their total."""
    names = df.columns if columns is None else columns
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}

    def missing(c: str):
        col = F.col(f"`{c}`")
        return F.count_if(col.isNull() | F.isnan(col)) if c in floats else F.count_if(col.isNull())

    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[missing(c).alias(f"m{i}") for i, c in enumerate(names)])
    total = sum((F.col(f"m{i}") for i in range(len(names))), F.lit(0).cast("bigint"))
    wide = wide.withColumn("total", total)
    fields = {c: [("missing", f"m{i}"), ("n_rows", "rows")] for i, c in enumerate(names)}
    fields["(all)"] = [("missing", "total"), ("n_rows", "rows")]
    return _as_rows(wide, fields)


def range_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value per column and over all of them, as doubles."""
    bounds = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`").cast("double")
        bounds += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
    wide = df.agg(*bounds)
    lows, highs = [[F.col(f"{side}{i}") for i in range(len(columns))] for side in ("lo", "hi")]
    wide = wide.withColumns({"lo": F.array_min(F.array(*lows)), "hi": F.array_max(F.array(*highs))})
    fields = {c: [("min_value", f"lo{i}"), ("max_value", f"hi{i}")] for i, c in enumerate(columns)}
    fields["(all)"] = [("min_value", "lo"), ("max_value", "hi")]
    return _as_rows(wide, fields)


def preview(df: DataFrame, key: str, columns: list[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows by key, as a bounded top-n (no full sort)."""
    return df.orderBy(key).limit(n).select(*columns)
