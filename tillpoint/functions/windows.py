"""Anchor-relative day windows as Column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillpoint.config import WINDOWS, Window


def in_window(day: Column, anchor: Column, window: Window | str) -> Column:
    """``anchor - start <= day < anchor - end`` (start None: no lower bound).

    A NULL anchor makes the predicate NULL, i.e. the row is outside every
    window, as in ``CASE WHEN ... THEN x END``.
    """
    w = WINDOWS[window] if isinstance(window, str) else window
    upper = anchor if w.end == 0 else F.date_sub(anchor, w.end)
    cond = day < upper
    if w.start is not None:
        cond = cond & (day >= F.date_sub(anchor, w.start))
    return cond


def lookback_start(anchor: Column, window: Window | str) -> Column | None:
    w = WINDOWS[window] if isinstance(window, str) else window
    return None if w.start is None else F.date_sub(anchor, w.start)
