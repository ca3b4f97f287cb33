"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int, source: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df`` unchanged.

    The check counts up to ``max_rows + 1`` rows of ``df``.  If ``df`` is computed (an
    aggregate is computed whole for that), give as ``source`` a scan that has at least as
    many rows, which is counted instead.  Past the bound the caller's join stays a shuffle
    join and AQE may still pick a broadcast from runtime statistics.
    """
    n = (df if source is None else source).limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
