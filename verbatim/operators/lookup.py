"""Dimension lookups: zip → State (J3, P6) and restricted attributes by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.functions.zipcodes import normalize_zip
from verbatim.operators.broadcast import bounded_broadcast

# A full national gazetteer has ~41k zips; anything past this is joined by shuffle.
MAX_GAZETTEER_ROWS = 2_000_000


def gazetteer_states(gazetteer: DataFrame, dedupe: bool = True) -> DataFrame:
    """``(zip, State)`` with normalised zips; NULL zips are dropped so NULL never matches.

    ``dedupe=True`` keeps one State per zip (the smallest), ``False`` reproduces the
    reference's fan-out on duplicate zips.
    """
    z = normalize_zip(F.col("zip").cast("string"))
    states = gazetteer.select(z.alias("zip"), F.col("State")).where(F.col("zip").isNotNull())
    if dedupe:
        states = states.groupBy("zip").agg(F.min("State").alias("State"))
    return states


def lookup_state(df: DataFrame, states: DataFrame, zip_col: str = "zip",
                 max_broadcast_rows: int = MAX_GAZETTEER_ROWS,
                 gazetteer: DataFrame | None = None) -> DataFrame:
    """Left join ``State`` on the zip column, explicitly on that one key.

    ``gazetteer``, the table that ``states`` came from, is counted for the size check, so
    that the deduplication runs once."""
    if "State" in df.columns:
        raise ValueError("lookup_state: input already has a State column; a natural join "
                         "would silently use it as a second key — drop or rename it first")
    side = states.withColumnRenamed("zip", "__zip")
    side = bounded_broadcast(side, max_broadcast_rows, gazetteer)
    out = df.join(side, F.col(f"`{zip_col}`") == F.col("__zip"), "left")
    return out.drop("__zip")


def lookup_left(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Generic left lookup (J4, J6).  Broadcast only behind a row-count check."""
    if max_broadcast_rows is not None:
        dim = bounded_broadcast(dim, max_broadcast_rows)
    return df.join(dim, on=on, how="left")
