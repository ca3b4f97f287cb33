"""S1 — yearly wave files.

Wave files land as Parquet (or CSV) converted from the survey tool's export; the
binary SPSS parser is not part of this library.  Dotted column names are renamed to
underscores on ingest; the original codes live in the panel configuration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from verbatim.functions.names import rename_dotted


def read_waves(spark: SparkSession, paths: Mapping[str, str] | Sequence[str],
               fmt: str = "parquet", schema: StructType | None = None,
               options: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """One DataFrame per wave file, in the given order, keyed by wave name.

    A list is keyed by file stem; two files with one stem are an error, not one wave lost
    (give a mapping to name them).
    """
    if not isinstance(paths, Mapping):
        named: dict[str, str] = {}
        for p in paths:
            stem = p.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
            if stem in named:
                raise ValueError(f"two wave files are named {stem!r}: {named[stem]} and {p}; "
                                 "give a mapping of wave names to paths")
            named[stem] = p
        paths = named
    out = {}
    for name, path in paths.items():
        reader = spark.read.format(fmt).options(**(options or {}))
        if schema is not None:
            reader = reader.schema(schema)
        out[name] = rename_dotted(reader.load(path))
    return out


def wave_columns(spark: SparkSession, paths: Mapping[str, str] | Sequence[str],
                 fmt: str = "parquet", options: Mapping[str, str] | None = None) -> list[str]:
    """The waves' column names as recorded (dotted), each once, oldest wave first."""
    files = paths.values() if isinstance(paths, Mapping) else paths
    read = [spark.read.format(fmt).options(**(options or {})).load(p).columns for p in files]
    return list(dict.fromkeys(c for columns in read for c in columns))
