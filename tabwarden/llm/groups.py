"""Joining rows to their groups where one group may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups with at least one row in HOT_GROUPS of all rows; there cannot be more than HOT_GROUPS of them.
HOT_GROUPS = 1_000


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Names like the given ones that no column has, in any case."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Left join of ``rows`` with one row per group; groups may lack keys that rows have.

    ``size`` is the number of rows of a group, of ``n_rows`` in all. Large groups, ``HOT_GROUPS`` at
    most, are broadcast and their rows are not shuffled; the other groups are joined by shuffle,
    where no key holds more than one row in ``HOT_GROUPS``. Both frames are read twice, so they
    should be written tables.
    """
    least = max(2, -(-n_rows // HOT_GROUPS))
    hot = F.broadcast(groups.where(F.col(size) >= least))
    cold = groups.where(F.col(size) < least)
    rest = rows.join(hot.select(key), key, "left_anti").join(cold.hint("shuffle_merge"), key, "left")
    return rows.join(hot, key).unionByName(rest)
