"""Running sums over ordered distinct keys, for tables of any size."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwarden.session import materialise

# Up to this many distinct keys one ordered window per group is enough.
WINDOW_KEYS = 100_000
# Beyond it, the keys are cut into ordered slices of about this many.
SLICE_KEYS = 100_000


def running_counts(
    df: DataFrame,
    key: str,
    counts: list[str],
    group: str,
    descending: bool = False,
    following: bool = False,
    window_keys: int = WINDOW_KEYS,
    slice_keys: int = SLICE_KEYS,
) -> DataFrame:
    """Add ``cum_<c>`` and ``total_<c>`` for every count column, by group in key order.

    ``df`` holds one row per (group, key). ``following`` adds ``next_<c>``, the counts
    at the next key of the group (null at its end). The input is written once to the
    shared folder, which also gives its exact size: a small one goes through one window
    per group, a large one through ordered slices whose sums are added up apart, so no
    task ever holds a whole group.
    """
    stored = materialise(df.select(group, key, *counts), "counts")
    rows = stored.count()
    if rows <= window_keys:
        return _windowed(stored, key, counts, [group], descending, following)
    return _sliced(stored, key, counts, group, descending, following, ceil(rows / slice_keys))


def _ordered(key: str, descending: bool) -> Column:
    return F.col(key).desc() if descending else F.col(key).asc()


def _windowed(df, key, counts, groups, descending, following) -> DataFrame:
    whole = Window.partitionBy(*groups)
    ordered = whole.orderBy(_ordered(key, descending))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {}
    for c in counts:
        added[f"cum_{c}"] = F.sum(c).over(upto)
        added[f"total_{c}"] = F.sum(c).over(whole)
        if following:
            added[f"next_{c}"] = F.lead(c).over(ordered)
    return df.withColumns(added)


def _sliced(df, key, counts, group, descending, following, slices) -> DataFrame:
    order = _ordered(key, descending)
    # The slice number is fixed by the write, so it stays the same however often it is read.
    cut = materialise(df.repartitionByRange(slices, F.col(group), order).withColumn("slice", F.spark_partition_id()), "slices")
    inside = _windowed(cut, key, counts, [group, "slice"], descending, following).drop(*[f"total_{c}" for c in counts])

    # One row per slice and group: its sums and its first counts.
    pick_first = F.max_by if descending else F.min_by
    sums = [F.sum(c).alias(f"sum_{c}") for c in counts]
    per_slice = cut.groupBy(group, "slice").agg(*sums, pick_first(F.struct(*counts), F.col(key)).alias("head"))
    by_slice = Window.partitionBy(group).orderBy("slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    offsets = {}
    for c in counts:
        offsets[f"before_{c}"] = F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0))
        offsets[f"total_{c}"] = F.sum(f"sum_{c}").over(Window.partitionBy(group))
    per_slice = per_slice.withColumns(offsets | {"next_head": F.lead("head").over(by_slice)})

    joined = inside.join(per_slice.drop("head"), [group, "slice"])
    out = {f"cum_{c}": F.col(f"cum_{c}") + F.col(f"before_{c}") for c in counts}
    if following:
        out |= {f"next_{c}": F.coalesce(F.col(f"next_{c}"), F.col("next_head")[c]) for c in counts}
    kept = [group, key, *counts, *[f"cum_{c}" for c in counts], *[f"total_{c}" for c in counts]]
    kept += [f"next_{c}" for c in counts] if following else []
    return joined.withColumns(out).select(*kept)


def ordered_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the place of every row, from 1, in the given order.

    Rows are range-partitioned into ordered slices and ranked inside them; only one count per
    slice reaches the driver, to be added up.
    """
    cut = materialise(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "ranked-slices")
    before, offsets = 0, []
    for r in cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).orderBy("_slice").collect():
        offsets.append((r["_slice"], before))
        before += r["n"]
    offsets = df.sparkSession.createDataFrame(offsets, "_slice int, _before bigint")
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    ranked = cut.join(F.broadcast(offsets), "_slice").withColumn(name, inside + F.col("_before"))
    return ranked.drop("_slice", "_before")
