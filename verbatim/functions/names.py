"""Dotted survey column names (``OPEN.001``) are renamed on ingest (``OPEN_001``)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def dotted_to_snake(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def rename_dotted(df: DataFrame) -> DataFrame:
    mapping = {c: dotted_to_snake(c) for c in df.columns if dotted_to_snake(c) != c}
    return df.withColumnsRenamed(mapping) if mapping else df
