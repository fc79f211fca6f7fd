"""Scalar helpers: id lists, half-up rounding, percent text, JSON of pairs, time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def id_list(text: str | Column, sep: str = ",") -> Column:
    """``"3,7,9"`` -> ``array<bigint>`` (F1, F6). Null stays null; a bad id becomes a
    null element (``try_cast`` of an array is element-wise)."""
    return F.split(_c(text), sep).try_cast("array<bigint>")


def half_up_1dp(x: str | Column) -> Column:
    """Round half up to one decimal as ``floor(x * 10 + 0.5) / 10`` (F5), as a double."""
    return F.floor(_c(x) * F.lit(10.0) + F.lit(0.5)).cast("double") / F.lit(10.0)


def percent_text(name: str | Column, pct: str | Column) -> Column:
    """``name:pct%`` with the double rendered by Spark's cast (one decimal: ``21.0%``)."""
    return F.concat(_c(name), F.lit(":"), _c(pct).cast("string"), F.lit("%"))


def pairs_to_json(pairs: str, key: str, value: str) -> Column:
    """array<struct> column -> ``[{"k1":v1},{"k2":v2}]``, one single-entry object per
    pair, in array order (F12)."""
    return F.expr(f"to_json(transform(`{pairs}`, p -> map(cast(p.`{key}` AS STRING), p.`{value}`)))")


def parse_day(text: str | Column) -> Column:
    """``yyyy-MM-dd`` text -> DATE; malformed text gives null."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd")).cast("date")


def day_of(ts_ntz: str | Column) -> Column:
    """``yyyy-MM-dd`` text of a wall-clock timestamp."""
    return F.date_format(_c(ts_ntz), "yyyy-MM-dd")


def minute_of(ts_ntz: str | Column) -> Column:
    """Minute bucket as a timestamp: the key keeps the date (defect D12)."""
    return F.date_trunc("minute", _c(ts_ntz)).cast("timestamp_ntz")


def minute_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm`` display text of a minute key (F8 without the date loss)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")
