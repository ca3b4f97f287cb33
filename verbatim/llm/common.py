"""Helpers shared by the training-data operators: whitespace words, text buffers, tables."""

from __future__ import annotations

import contextlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.session import checkpoint_dir

#: A word is a run of anything but space and the control characters TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts at once: the joined bytes, word starts and ends in them, and
    the number of words of each text."""
    joined = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    inside = ~SPACES[joined]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return joined, starts, ends, np.diff(np.searchsorted(starts, begins + 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits well mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_hash(*columns) -> F.Column:
    """64-bit hash of a row's values; a null counts as such, not as the neighbouring value."""
    return F.xxhash64(*[c for x in columns for c in (x, x.isNull())])


def doc_crc(doc_id="doc_id"):
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


class Tables:
    """Intermediate tables of one operator call in the shared checkpoint folder.

    A written table cuts lineage: after a lost executor the later steps read it again
    instead of running the earlier ones.  Every call has a folder of its own.  With ``tidy``
    the shuffle files of a step go when its table is written, as nothing reads them again.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark, self.tidy = spark, tidy
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/verbatim-llm/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(self.CLEANUP)
        if self.tidy:
            self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.mode("error").option("compression", "zstd").parquet(self.path(name))
        finally:
            if self.tidy:
                self.spark.conf.set(self.CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path(name))
        with contextlib.suppress(Exception):
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
