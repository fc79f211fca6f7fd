"""Top-k per group with window functions.

``rank``/``row_number`` filtered by ``<= k`` (or ``= k``) is planned by Catalyst
as WindowGroupLimit: a *partial* limit runs before the shuffle, so even a group
holding a third of all rows sends at most ~k rows per input partition to the
final window. No group is ever collected into memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    rank_col: str = "rk", ties: bool = False) -> DataFrame:
    """Rows ranked 1..k inside each group. ``ties=True`` uses ``rank()`` (ties
    share a rank, so more than k rows may pass); otherwise ``row_number()`` with
    the given total order."""
    w = Window.partitionBy(*group).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(rank_col, fn.over(w).cast("long")).where(F.col(rank_col) <= k)


def kth_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                  rank_col: str = "rn") -> DataFrame:
    """The k-th row of each group in ``order`` (groups with fewer rows vanish)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == k).drop(rank_col)
