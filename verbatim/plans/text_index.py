"""V1/F10 — substring search that reads only the files that can match.

``contains`` filters read every text.  The index keeps, for each n-gram (``N`` characters in a
row) of the lower-cased text, the data files in which it occurs.  A text that contains the
searched string contains all its n-grams, so a file that lacks one of them has no match:
only files that hold all of them are read, and there every row is verified by the same
``contains``, so the rows are those of a scan.

    <root>/data/question_num=…/part-…   the rows, at most ``rows_per_file`` a file
    <root>/grams/bucket=…/…             (gram, file), distinct; partitioned by a hash of the gram

A search reads the buckets of its own grams, and of these the row groups with the gram.  What
reaches the driver is the list of files that match, at most one row a file.  A string shorter
than ``N`` reads all files.  Rows are sorted within a question's files by what they are
grouped on when the caller says so (``cluster_by``), which makes rare strings fall into few files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

N = 3
BUCKETS = 256
ROWS_PER_FILE = 100_000


def grams(text: Column, n: int = N) -> Column:
    """The distinct n-grams of a lower-cased text, in time linear in its length."""
    letters = F.split(text, "")  # one character each
    letters = F.array_remove(letters, "")
    k = F.greatest(F.size(letters) - (n - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice(letters, F.lit(i + 1), k).alias(f"c{i}") for i in range(n)])
    return F.array_distinct(F.transform(shifted, lambda x: F.concat(*[x[f"c{i}"] for i in range(n)])))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


class TextIndex:
    """An indexed copy of a response table; ``build`` it once, then ``search``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def build(self, df: DataFrame, text_col: str = "response", question_col: str | None = "question",
              cluster_by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> TextIndex:
        """Write rows and index; rows without text are kept, and match nothing."""
        rows = df
        if question_col:
            rows = rows.hint("rebalance", question_col)
        if cluster_by or question_col:
            rows = rows.sortWithinPartitions(*([question_col] if question_col else []), *cluster_by)
        writer = rows.write.mode("error").option("maxRecordsPerFile", rows_per_file)
        if question_col:
            writer = writer.partitionBy(question_col)
        writer.parquet(f"{self.root}/data")
        # the index is made from the files as they were written
        written = self.spark.read.schema(df.schema).parquet(f"{self.root}/data")
        found = written.select(F.col("_metadata.file_path").alias("file"), F.explode(grams(F.lower(F.col(f"`{text_col}`")))).alias("gram")).distinct()
        found = found.withColumn("bucket", _bucket(F.col("gram")))
        found.repartition("bucket", "gram").sortWithinPartitions("bucket", "gram").write.mode("error").partitionBy("bucket").parquet(f"{self.root}/grams")
        meta = self.spark.createDataFrame([(text_col, question_col, df.schema.json())], "text_col string, question_col string, schema string")
        meta.coalesce(1).write.mode("error").json(f"{self.root}/meta")
        return self

    def _meta(self):
        return self.spark.read.schema("text_col string, question_col string, schema string").json(f"{self.root}/meta").first()

    def files(self, text: str) -> list[str] | None:
        """The data files that hold every n-gram of ``text``, or None if it is too short to tell."""
        own = self.spark.range(1).select(grams(F.lower(F.lit(text))).alias("g")).first()["g"]
        if not own:
            return None
        index = self.spark.read.schema("gram string, file string, bucket int").parquet(f"{self.root}/grams")
        hits = index.where(F.col("bucket").isin(sorted(self._buckets(own))) & F.col("gram").isin(own))
        return [r["file"] for r in hits.groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") == len(own)).collect()]

    def _buckets(self, own: Sequence[str]) -> set[int]:
        return {r["b"] for r in self.spark.createDataFrame([(g,) for g in own], "gram string").select(_bucket(F.col("gram")).alias("b")).collect()}

    def search(self, text: str, question: str | None = None) -> DataFrame:
        """All rows whose text contains ``text``, whatever the case; of one question if given."""
        meta = self._meta()
        schema, files = StructType.fromJson(json.loads(meta["schema"])), self.files(text)
        if files is not None and not files:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        rows = reader.parquet(*(files if files is not None else [f"{self.root}/data"]))
        if question is not None:
            rows = rows.where(F.col(meta["question_col"]) == question)
        return rows.where(F.lower(F.col(f"`{meta['text_col']}`")).contains(F.lower(F.lit(text)))).select(*[F.col(f"`{c}`") for c in schema.names])
