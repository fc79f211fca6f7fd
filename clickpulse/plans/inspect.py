"""Plan inspection used by tests and the bench (``explain`` text, no UI)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, captured as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def assert_plan(df: DataFrame, contains=(), absent=()) -> str:
    text = plan_text(df)
    for s in contains:
        assert s in text, f"expected {s!r} in plan:\n{text}"
    for s in absent:
        assert s not in text, f"unexpected {s!r} in plan:\n{text}"
    return text
