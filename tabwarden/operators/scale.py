"""Standard scaling with the population deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaler_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and deviation per column: one aggregate row, whatever the table's size."""
    stats = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`").cast("double")
        stats += [F.avg(col).alias(f"mean{i}"), F.stddev_pop(col).alias(f"dev{i}")]
    row = df.agg(*stats).first()
    return {c: (row[f"mean{i}"], row[f"dev{i}"]) for i, c in enumerate(columns)}


def standard_scale(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a constant column is only centred, an empty one stays."""
    scaled = {
        c: (F.col(f"`{c}`").cast("double") - F.lit(mean)) / F.lit(dev or 1.0)
        for c, (mean, dev) in stats.items()
        if mean is not None
    }
    return df.withColumns(scaled)
