"""Zip code text handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def zip_text(df: DataFrame, name: str) -> Column:
    """Zip as text.  Numeric zips go through bigint first so 1234.0 reads "1234"."""
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, NumericType):
        c = c.cast("bigint")
    return c.cast("string")


def normalize_zip(z: Column) -> Column:
    """5 characters as is, 4 → one leading zero, 3 → two leading zeros, anything else NULL.

    Deliberately not ``lpad``: lpad would also pad lengths 1-2 and truncate > 5.
    """
    n = F.length(z)
    return (F.when(n == 5, z)
            .when(n == 4, F.concat(F.lit("0"), z))
            .when(n == 3, F.concat(F.lit("00"), z)))
