"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000


def join_counted(
    rows: DataFrame, counted: DataFrame, on: str, total: int, n: str = "n"
) -> DataFrame:
    """Inner join of ``rows`` with ``counted``, which has one row per key and, in ``n``,
    the number of ``rows`` of that key.

    Keys with more than ``total / HEAVY_KEYS`` rows number fewer than ``HEAVY_KEYS``,
    since their rows add up to at most ``total``: that part of ``counted`` is bounded and
    is broadcast, so the rows of a heavy key stay where they are. All others are shuffled,
    and none of them is larger than one share.
    """
    share = max(total // HEAVY_KEYS, 1)
    heavy = counted.where(F.col(n) > share)
    light = counted.where(F.col(n) <= share)
    stay = rows.join(F.broadcast(heavy), on)
    move = rows.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on)
    return stay.unionByName(move)
