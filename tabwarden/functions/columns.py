"""Column expressions shared by the operators; all of them run in the JVM."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A boolean counts as numeric, as it does in the declared checks.
NUMERIC_TYPES = (T.NumericType, T.BooleanType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep one missing marker: NaN becomes null in the floating columns."""
    wanted = set(df.columns if columns is None else columns)
    floats = {f.name for f in df.schema if isinstance(f.dataType, FLOAT_TYPES)} & wanted
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def recode_label(label: Column) -> Column:
    """-1 becomes 0; every other value stays."""
    return F.when(label == -1, F.lit(0)).otherwise(label).cast("int")


def safe_ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den as double, or ``default`` where the denominator is zero."""
    ratio = F.try_divide(num.cast("double"), den.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def order_key(key: Column, seed: int) -> Column:
    """A repeatable pseudo-random order of rows, equal on every engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def class1_probability(df: DataFrame, column: str) -> Column:
    """The score of the positive class from a two-class vector, array or plain number."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, VectorUDT):
        return vector_to_array(F.col(column))[1]
    if isinstance(dtype, T.ArrayType):
        return F.col(column)[1].cast("double")
    return F.col(column).cast("double")
