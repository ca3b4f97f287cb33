"""Documents dealt out in ascending order of their id, with the next one at hand.

The ids are cut at approximate quantiles into as many ranges as there are shuffle
partitions; only the cuts and the first id of each range reach the driver.  A range's first
document is also sent to the range before it (the very first to the last range), so each
range knows every document's successor after a single shuffle of the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_ID = -(1 << 63)  # a null id comes first


@dataclass
class Ranges:
    cuts: np.ndarray  # smallest id of each range but the first
    parts: int

    def of(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, ids, "right")


def order_key(doc_id="doc_id"):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))


def ranges(docs: DataFrame) -> Ranges:
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = [i / parts for i in range(1, parts)]
    cuts = docs.select(order_key().alias("at")).agg(F.percentile_approx("at", marks, 20 * parts)).first()[0] if marks else None
    return Ranges(np.unique(np.array(cuts or [], np.int64)), parts)


def deal(docs: DataFrame, cut: Ranges, successor: bool = False) -> DataFrame:
    """Adds ``at`` (order), ``range`` and ``guest``; sorted by range, guest, order and text.

    With ``successor`` the document after a range's last one is there as its guest; of
    several guests (rows with one id) the first counts."""
    spark, rows = docs.sparkSession, docs.withColumn("at", order_key())
    guests: dict[int, int] = {}
    if successor:
        @F.arrow_udf(T.IntegerType())
        def range_of(at: pa.Array) -> pa.Array:
            return pa.array(cut.of(at.to_numpy(zero_copy_only=False)).astype(np.int32))

        firsts = sorted(tuple(r) for r in rows.select("at", range_of("at").alias("r")).groupBy("r").agg(F.min("at")).collect())
        for (r, _), (_, following) in zip(firsts, firsts[1:] + firsts[:1]):
            guests[following] = r

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def places(at: pa.Array) -> pa.Array:
        ids = at.to_numpy(zero_copy_only=False)
        return pa.array([[2 * r] + ([2 * guests[i] + 1] if i in guests else []) for i, r in zip(ids.tolist(), cut.of(ids).tolist())], pa.list_(pa.int32()))

    rows = rows.withColumn("place", F.explode(places("at")))
    rows = rows.withColumn("range", F.shiftright("place", 1)).withColumn("guest", F.col("place") % 2).drop("place")
    return rows.repartition(cut.parts, "range").sortWithinPartitions("range", "guest", "at", "text")
