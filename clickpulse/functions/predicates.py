"""Optional conjunctive filters built as ``Column`` objects (P4-P6), never SQL text."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(preds: Iterable[Column]) -> Column:
    """AND of the predicates; ``True`` when there are none."""
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _given(params: dict, key: str):
    """A parameter is set when present and not empty (missing keys never raise; D7)."""
    v = params.get(key)
    if v is None:
        return None
    if isinstance(v, str):
        v = v.strip()
        return v or None
    if isinstance(v, (list, tuple, set)):
        return list(v) or None
    return v


def _as_list(v) -> list[str]:
    if isinstance(v, str):
        return [s.strip() for s in v.split(",") if s.strip()]
    return [str(x) for x in v]


def optional_predicates(params: dict) -> list[Column]:
    """One predicate per set parameter.

    Keys: ``startDate`` / ``endDate`` (inclusive, on ``date``), ``startAge`` /
    ``endAge`` (inclusive, on ``age``), ``professional`` (or ``professionals``,
    comma list -> equality/isin), ``city`` (comma list of city names, on
    ``city_name``), ``gender`` (equality), ``keywords`` (comma list on
    ``search_keyword``), ``categoryIds`` (comma list on ``click_category_id``).
    """
    out: list[Column] = []
    if (v := _given(params, "startDate")) is not None:
        out.append(F.col("date") >= F.lit(str(v)))
    if (v := _given(params, "endDate")) is not None:
        out.append(F.col("date") <= F.lit(str(v)))
    if (v := _given(params, "startAge")) is not None:
        out.append(F.col("age") >= F.lit(int(v)))
    if (v := _given(params, "endAge")) is not None:
        out.append(F.col("age") <= F.lit(int(v)))
    prof = _given(params, "professional") or _given(params, "professionals")
    if prof is not None:
        out.append(F.col("professional").isin(_as_list(prof)))
    if (v := _given(params, "city")) is not None:
        out.append(F.col("city_name").isin(_as_list(v)))
    if (v := _given(params, "gender")) is not None:
        out.append(F.col("gender") == F.lit(str(v)))
    if (v := _given(params, "keywords")) is not None:
        out.append(F.col("search_keyword").isin(_as_list(v)))
    if (v := _given(params, "categoryIds")) is not None:
        out.append(F.col("click_category_id").isin([int(x) for x in _as_list(v)]))
    return out
