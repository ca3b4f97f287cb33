"""S2/S3 — rows that don't parse are set apart and counted, not turned into NULLs.

A row of a delimited file is good if it has exactly the schema's columns, each NULL or of its
type.  Spark's reader keeps the text of a row that it can't parse in a corrupt-record column;
what it lets pass is found as well: a row with too few or too many fields, which it fills
up or cuts.  All comes from one scan of the raw lines; the good rows are parsed by the same
options as an ordinary read, so they are the rows that it would give.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
REASONS = ("too_few_fields", "too_many_fields", "bad_value")


@dataclass
class Quarantined:
    """good: the parsed rows; bad: ``(file, line, n_fields, reason)`` of the others."""

    good: DataFrame
    bad: DataFrame

    def counts(self) -> DataFrame:
        """``(file, reason, n)`` of the bad rows."""
        return self.bad.groupBy("file", "reason").agg(F.count("*").alias("n"))

    def require(self, most: int = 0) -> DataFrame:
        """The good rows, or an error that says what is wrong if there are more than ``most`` bad ones."""
        found = {r["reason"]: r["n"] for r in self.bad.groupBy("reason").agg(F.count("*").alias("n")).collect()}
        if sum(found.values()) > most:
            first = self.bad.first()
            raise ValueError(f"{sum(found.values())} rows don't parse ({found}), such as {first['line']!r} of {first['file']}")
        return self.good


def _fields(line: Column, sep: str) -> Column:
    """Fields of an unquoted line."""
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(sep), F.lit(""))) + 1


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = "\t", **options) -> Quarantined:
    """Header-less, unquoted lines, one row each; blank lines are no rows.

    ``options`` go to the CSV parser (``nullValue``, ``dateFormat``, …)."""
    if len(sep) != 1:
        raise ValueError("the separator must be one character")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where(F.trim("line") != "")
    parser = {"sep": sep, "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **{k: str(v) for k, v in options.items()}}
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], f"`{CORRUPT}` string"])
    rows = lines.select("line", "file", _fields(F.col("line"), sep).alias("n_fields"), F.from_csv("line", ddl, parser).alias("row"))
    n = len(fields)
    reason = (F.when(F.col("n_fields") < n, REASONS[0]).when(F.col("n_fields") > n, REASONS[1])
              .when(F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull(), REASONS[2]))
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason IS NULL").select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in fields])
    return Quarantined(good, rows.where("reason IS NOT NULL").select("file", "line", "n_fields", "reason"))

