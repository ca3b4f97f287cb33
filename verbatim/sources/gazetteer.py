"""S2/S3 — header-less, tab-separated zip gazetteer with 12 named columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verbatim.sources.quarantine import Quarantined, read_delimited

# The gazetteer's column order.
ZIP_SCHEMA = (
    "CountryCode string, zip string, PlaceName string, AdminName1 string, State string, "
    "AdminName2 string, AdminCode2 string, AdminName3 string, AdminCode3 string, "
    "latitude double, longitude double, accuracy int"
)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """``quote=""`` on purpose: place names contain apostrophes."""
    return (spark.read.schema(ZIP_SCHEMA)
            .option("sep", "\t").option("header", "false").option("quote", "")
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_gazetteer_checked(spark: SparkSession, path: str) -> Quarantined:
    """The gazetteer's good rows, and those that don't parse as a counted table of their own."""
    return read_delimited(spark, path, ZIP_SCHEMA)
