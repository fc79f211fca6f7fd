"""Key-wise additive merge of count tables (U2; the accumulator / UDAF merge)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_counts(*tables: DataFrame, keys: list[str], value: str = "clicks") -> DataFrame:
    """Sum ``value`` per key over all tables. Associative and commutative, and a
    partial aggregate runs before the shuffle."""
    u = reduce(lambda a, b: a.unionByName(b), [t.select(*keys, value) for t in tables])
    return u.groupBy(*keys).agg(F.sum(value).cast("long").alias(value))
