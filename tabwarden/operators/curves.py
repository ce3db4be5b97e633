"""Ranking scores and curves over ordered score thresholds.

Every operator first aggregates to distinct scores with map-side combining and then
takes running counts, so a score shared by a third of all rows is one row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import class1_probability, safe_ratio
from tabwarden.operators.cumulative import running_counts

GROUP = "curve"


def _steps(df: DataFrame, label: str, score: str, following: bool = False, **sizes) -> DataFrame:
    """Distinct scores, highest first, with running positives and negatives."""
    scored = df.select(F.col(label).alias("y"), class1_probability(df, score).alias("score"))
    distinct = (
        scored.where(F.col("y").isin(0, 1) & F.col("score").isNotNull())
        .groupBy("score")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
        .withColumn(GROUP, F.lit(0))
    )
    return running_counts(distinct, "score", ["pos", "neg"], GROUP, descending=True, following=following, **sizes)


def roc_auc(df: DataFrame, label: str, score: str, **sizes) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties one half."""
    steps = _steps(df, label, score, **sizes)
    won = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2)
    pairs = F.max("total_pos").cast("double") * F.max("total_neg")
    return steps.agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, **sizes) -> DataFrame:
    """Sum of precision times the recall gained at each threshold."""
    steps = _steps(df, label, score, **sizes)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    gained = F.try_divide(F.col("pos").cast("double"), F.col("total_pos"))
    return steps.agg(F.sum(gained * precision).alias("average_precision"))


def _reduced(points: DataFrame, travelled: Column, cells: int, kept) -> DataFrame:
    """Of the points of each of ``cells`` equal parts of ``travelled`` (0 to 1) those that ``kept`` picks.

    One aggregation with map-side combining: a task passes on a bounded number of points.
    """
    cell = F.least(F.lit(cells - 1), F.floor(F.coalesce(travelled, F.lit(0.0)) * cells))
    row = F.struct(*points.columns)
    picked = [pick(row, by).alias(f"p{i}") for i, (pick, by) in enumerate(kept)]
    per_cell = points.groupBy(cell.alias("cell")).agg(*picked)
    return per_cell.select(F.inline(F.array_distinct(F.array(*[f"p{i}" for i in range(len(kept))]))))


def _cells(max_points: int, per_cell: int) -> int:
    """Cells that leave room for the end point of the curve."""
    if max_points <= per_cell:
        raise ValueError(f"a curve needs room for {per_cell + 1} points at least, not {max_points}")
    return (max_points - 1) // per_cell


def roc_curve(df: DataFrame, label: str, score: str, max_points: int | None = None, **sizes) -> DataFrame:
    """(threshold, fpr, tpr), from (0, 0) with no threshold down to the lowest score.

    A point between two steps of equal size adds nothing to the line and is left out,
    except at the highest score.

    ``max_points`` bounds the rows. The way along the curve, fpr + tpr, is cut into
    (max_points - 1) // 2 equal parts, and the first and last point of each stay. Both rates only
    grow, so a point left out lies between the two kept ones of its part, neither of which is
    further than 2 / ((max_points - 1) // 2) from it in fpr and tpr together; the line through the
    kept points is nowhere further from the curve than that, upwards or sideways.
    """
    steps = _steps(df, label, score, following=True, **sizes)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    turns = first | F.col("next_pos").isNull() | (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    points = steps.where(turns).select(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("cum_neg"), F.col("total_neg"), None).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("total_pos"), None).alias("tpr"),
    )
    if max_points is not None:
        way = (F.col("fpr") + F.col("tpr")) / 2
        points = _reduced(points, way, _cells(max_points, 2), [(F.max_by, F.col("threshold")), (F.min_by, F.col("threshold"))])
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def pr_curve(df: DataFrame, label: str, score: str, max_points: int | None = None, **sizes) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the closing (1, 0).

    ``max_points`` bounds the rows. Recall is cut into (max_points - 1) // 4 equal parts; of each the
    first and last point and those of the largest and smallest precision stay (of equal ones that of
    the higher threshold). So a point left out has kept points above and below it in precision
    that are closer in recall than 4 / (max_points - 4).
    """
    steps = _steps(df, label, score, **sizes)
    points = steps.select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        safe_ratio(F.col("cum_pos"), F.col("total_pos"), None).alias("recall"),
    )
    if max_points is not None:
        high, low = F.struct("precision", "threshold"), F.struct("precision", -F.col("threshold"))
        kept = [(F.max_by, F.col("threshold")), (F.min_by, F.col("threshold")), (F.max_by, high), (F.min_by, low)]
        points = _reduced(points, F.col("recall"), _cells(max_points, 4), kept)
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)
