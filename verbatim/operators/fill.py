"""W1 — last observation carried forward within each respondent.

Semantics: within ``by``, in ``order`` (NULLs last) then ``tiebreak``, every NULL in a
filled column takes the latest earlier non-NULL value; leading NULLs stay NULL.

Plan
----
Ordinary keys: one ``Window.partitionBy(by)`` — one shuffle, one sort.  A key holding more
rows than a balanced partition and than ``HOT_FLOOR`` ("hot", found by a partial/final count
per key; there are fewer than partitions of them) would make one task process all of its
rows, so the rows of hot keys go another way:

1. ``repartitionByRange`` on (key, full order, tie-break included; a coarse week alone could
   not be cut) deals them out evenly; Spark's range partitioner finds a row's range by
   binary search, whatever their number.  The range's number is written with the row to a table in the
   shared checkpoint folder, so that every later step and every retry sees the same ranges.
2. Local fill per (key, range) with the same window; groups are range-sized.
3. Tails: per (key, range) and column, the value of the last non-NULL row (``max_by``
   with a NULL ordering for NULL values) — a partial/final aggregation.
4. Carry-in: over the tails, the last non-NULL of all earlier ranges of the key.
5. ``coalesce(local, carry)`` through a broadcast join on (key, range): a range holds its
   own part of at most two keys more than it holds whole, so there are fewer tails than
   ranges and hot keys together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatim.session import cut_lineage

HOT_FLOOR = 100_000  # rows; a key with fewer is never worth cutting


def _names(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _key_match(by: Sequence[str], other: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [_c(x).eqNullSafe(F.col(y)) for x, y in zip(by, other)])


def _window_fill(df: DataFrame, by, within, columns, extra_partition=()) -> DataFrame:
    w = (Window.partitionBy(*[F.col(p) for p in extra_partition], *[_c(b) for b in by])
         .orderBy(*within).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(_c(c), ignorenulls=True).over(w) for c in columns})


def _hot_keys(df: DataFrame, by: Sequence[str], num_partitions: int, min_rows: int):
    """(hot keys, ranges to deal their rows out to), or (None, 0) if there are none.

    Per-key counts are a partial/final aggregation, safe under skew.  Fewer than
    ``num_partitions`` keys can hold more than a balanced partition's rows.
    """
    counts = df.groupBy(*[_c(b) for b in by]).count()
    stats = counts.agg(F.sum("count").alias("total"), F.max("count").alias("largest")).first()
    per_range = max(1, min_rows, (stats["total"] or 0) // max(num_partitions, 1))
    if not stats["largest"] or stats["largest"] <= per_range:
        return None, 0
    rows = counts.where(F.col("count") > per_range).collect()
    kinds = df.select(*[_c(b).alias(f"__h{i}") for i, b in enumerate(by)]).schema
    hot = df.sparkSession.createDataFrame([tuple(r[b] for b in by) for r in rows], kinds)
    return hot, -(-sum(r["count"] for r in rows) // per_range)


def _order_key(order: Sequence[str], tie: Sequence[str]) -> Column:
    """The order as one comparable value, NULLs last."""
    return F.struct(*[x for i, o in enumerate([*order, *tie])
                      for x in (_c(o).isNull().alias(f"n{i}"), _c(o).alias(f"o{i}"))])


def _dealt(df: DataFrame, by: Sequence[str], within: Sequence[Column], parts: int) -> DataFrame:
    """The rows with ``__c``, the number of their range of the full order."""
    dealt = df.repartitionByRange(parts, *[_c(b) for b in by], *within)
    return cut_lineage(dealt.withColumn("__c", F.spark_partition_id()), "fill-ranges")


def fill_forward(df: DataFrame, by: str | Sequence[str], order: str | Sequence[str],
                 columns: Sequence[str], tiebreak: str | Sequence[str] | None = None,
                 split_hot_keys: bool = True, num_partitions: int | None = None,
                 hot_min_rows: int = HOT_FLOOR) -> DataFrame:
    by, order, columns = _names(by), _names(order), list(columns)
    tie = _names(tiebreak)
    added = False
    if tiebreak is None:
        # No input order survives a distributed read: break ties by content, which is
        # deterministic across recomputation (rows equal in every column are
        # interchangeable for the result).  ``tiebreak=()`` says (by, order) is unique
        # and skips this hash over every column.
        df = df.withColumn("__tb", F.xxhash64(*[_c(c) for c in df.columns]))
        tie, added = ["__tb"], True
    within = [_c(o).asc_nulls_last() for o in order] + [_c(t).asc_nulls_last() for t in tie]

    hot, parts = None, 0
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if split_hot_keys:
        hot, parts = _hot_keys(df, by, n, hot_min_rows)
    if hot is None:
        out = _window_fill(df, by, within, columns)
        return out.drop("__tb") if added else out

    names = [x for x in df.columns if not (added and x == "__tb")]
    hot = F.broadcast(hot)  # fewer than n keys
    match = _key_match(by, [f"__h{i}" for i in range(len(by))])
    ordinary = _window_fill(df.join(hot, match, "left_anti"), by, within, columns)

    rows = _dealt(df.join(hot, match, "left_semi"), by, within, parts)
    local = _window_fill(rows, by, within, columns, extra_partition=["__c"])
    vcols, kcols = [f"__v{j}" for j in range(len(columns))], [f"__k{i}" for i in range(len(by))]
    order_key = _order_key(order, tie)
    tails = rows.groupBy(*[_c(b).alias(x) for b, x in zip(by, kcols)], F.col("__c").alias("__cc")).agg(
        *[F.max_by(_c(c), F.when(_c(c).isNotNull(), order_key)).alias(v) for c, v in zip(columns, vcols)])
    earlier = Window.partitionBy(*kcols).orderBy("__cc").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*kcols, "__cc", *[F.last(F.col(v), ignorenulls=True).over(earlier).alias(v) for v in vcols])
    joined = local.join(F.broadcast(carry), (F.col("__c") == F.col("__cc")) & _key_match(by, kcols), "left")
    filled = joined.withColumns({c: F.coalesce(_c(c), F.col(v)) for c, v in zip(columns, vcols)})
    own = [_c(x) for x in names]
    return ordinary.select(*own).unionByName(filled.select(*own))
