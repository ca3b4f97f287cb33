"""S4 — codebook tables (question texts and value labels).

``variable_labels(panel, variable, position, label)`` and
``value_labels(panel, variable, code, label)``; written next to the wave files when
they are converted from the survey tool's format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VARIABLE_LABELS_SCHEMA = "panel string, variable string, position int, label string"
VALUE_LABELS_SCHEMA = "panel string, variable string, code int, label string"


def read_variable_labels(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(VARIABLE_LABELS_SCHEMA).load(path)


def read_value_labels(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(VALUE_LABELS_SCHEMA).load(path)
