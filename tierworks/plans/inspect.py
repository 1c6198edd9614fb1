"""Look at what Catalyst chose (used by tests and by hand)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text that ``df.explain(mode)`` prints."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()


def plan_has(df: DataFrame, *words: str) -> dict[str, bool]:
    text = plan_text(df)
    return {word: word in text for word in words}
