"""Wave harmonisation: natural full outer join (J1), its fold (J2), stacking.

The reference merges yearly files with a *natural* full join: every common column is
a key and missing matches missing.  We keep that meaning exactly (null-safe ``<=>``
keys, coalesced key columns) and add a no-shuffle fast path: when the waves are
provably disjoint on a column they all share (e.g. the survey week), no row can match
across waves and the fold equals ``unionByName(allowMissingColumns=True)``.

Skew: AQE splits skewed partitions of inner and one-sided outer joins but not of a full
outer join, so key tuples holding more rows than a balanced partition are found first
(one partial/final count) and joined by an exact salted plan of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.operators.attributes import merged_attributes, with_metadata
from verbatim.operators.broadcast import bounded_broadcast
from verbatim.operators.wavetypes import align_types
from verbatim.session import cut_lineage


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    rset = set(right.columns)
    return [c for c in left.columns if c in rset]


def _q(alias: str, name: str):
    return F.col(f"{alias}.`{name}`")


HOT_FLOOR = 100_000  # rows; a key tuple with fewer is never worth splitting
MAX_TUPLES = 1_000_000  # 8-byte hashes; broadcast up to here, shuffle join beyond
COPIES = 1 << 16     # copies of a matched pair of rows that one row expands to at once


def _check_case(frames: Sequence[DataFrame]) -> None:
    """Spark's column names don't differ by case; waves whose columns do are an error."""
    seen: dict[str, str] = {}
    for df in frames:
        for c in df.columns:
            other = seen.setdefault(c.lower(), c)
            if other != c:
                raise ValueError(f"columns {other!r} and {c!r} differ only in case; "
                                 "rename one on ingest")


def _check_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("natural_full_join: no common columns (would be a cross join)")
    for k in keys:
        lt, rt = left.schema[k].dataType, right.schema[k].dataType
        if lt != rt:
            raise TypeError(f"natural_full_join: key {k!r} is {lt.simpleString()} on the "
                            f"left and {rt.simpleString()} on the right; cast one side first")


def _output_columns(lcols, rcols, keys, common, lref, rref):
    """Column list of the joined result: left's columns, then right-only ones."""
    key_set, common_set = set(keys), set(common)
    cols = []
    for c in lcols:
        if c in key_set:
            cols.append(F.coalesce(lref(c), rref(c)).alias(c))
        else:
            cols.append(lref(c).alias(f"{c}_x" if c in common_set else c))
    for c in rcols:
        if c not in key_set:
            cols.append(rref(c).alias(f"{c}_y" if c in common_set else c))
    return cols


def _plain_full_join(left, right, keys, common, lcols, rcols) -> DataFrame:
    l, r = left.alias("__l"), right.alias("__r")
    cond = reduce(lambda a, b: a & b, [_q("__l", k).eqNullSafe(_q("__r", k)) for k in keys])
    joined = l.join(r, cond, "full")
    return joined.select(_output_columns(lcols, rcols, keys, common,
                                         lambda c: _q("__l", c), lambda c: _q("__r", c)))


def hot_join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  num_partitions: int, min_rows: int = 0) -> DataFrame | None:
    """Key tuples with more rows (on either side) than a balanced partition.

    Per-key counts of both sides come from one partial/final aggregation; the result
    is ``keys..., __a, __b`` (rows on the left, on the right), fewer than two per partition.
    """
    kc = [F.col(f"`{k}`") for k in keys]
    lc = left.groupBy(*kc).agg(F.count(F.lit(1)).alias("__a")).withColumn("__b", F.lit(0).cast("bigint"))
    rc = right.groupBy(*kc).agg(F.count(F.lit(1)).alias("__b")).withColumn("__a", F.lit(0).cast("bigint"))
    both = lc.unionByName(rc).groupBy(*kc).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    big = F.greatest("__a", "__b")
    stats = both.agg(F.sum(F.col("__a") + F.col("__b")).alias("total"), F.max(big).alias("largest")).first()
    if not stats or stats["total"] is None:
        return None
    threshold = max(min_rows, stats["total"] // max(num_partitions, 1))
    if stats["largest"] <= threshold:
        return None
    rows = both.where(big > threshold).collect()  # fewer than twice the partitions
    schema = both.schema
    return left.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def _hot_full_join(left, right, hot, keys, common, lcols, rcols, rows_per_task) -> DataFrame:
    """Exact natural full join for hot key tuples (stats in ``hot``: ``__a``, ``__b``).

    A key on one side only passes through.  A key on both sides matches all-with-all,
    i.e. an inner join: exact duplicates are collapsed to (row, multiplicity) by a
    partial/final aggregation, the side with more rows is salted by a content hash into
    ``S`` buckets and the other side is replicated ``S`` times, then multiplicities are
    expanded again.  No task holds more than ~1/S of a hot key's rows.
    """
    hk = [f"__h{i}" for i in range(len(keys))]
    stats = F.broadcast(hot.select(*[F.col(f"`{k}`").alias(h) for k, h in zip(keys, hk)],
                                   "__a", "__b"))  # fewer than two per partition

    def tag(df: DataFrame) -> DataFrame:
        cond = reduce(lambda a, b: a & b,
                      [F.col(f"`{k}`").eqNullSafe(F.col(h)) for k, h in zip(keys, hk)])
        return df.join(stats, cond, "inner").drop(*hk)

    def col(c):
        return F.col(f"`{c}`")

    lh, rh = tag(left), tag(right)
    lonly = lh.where(F.col("__b") == 0).select(_output_columns(
        lcols, rcols, keys, common, col, lambda c: F.lit(None).cast(right.schema[c].dataType)))
    ronly = rh.where(F.col("__a") == 0).select(_output_columns(
        lcols, rcols, keys, common, lambda c: F.lit(None).cast(left.schema[c].dataType), col))

    matched = (F.col("__a") > 0) & (F.col("__b") > 0)
    n_salts = F.greatest(F.lit(1), F.ceil(
        F.greatest("__a", "__b") / F.lit(max(rows_per_task, 1)))).cast("int")
    every_salt = F.sequence(F.lit(0), F.col("__s") - 1)
    left_big = F.col("__a") >= F.col("__b")
    lm = (lh.where(matched).groupBy(*[col(c) for c in lcols], "__a", "__b")
          .agg(F.count(F.lit(1)).alias("__ml")).withColumn("__s", n_salts))
    rm = (rh.where(matched).groupBy(*[col(c) for c in rcols], "__a", "__b")
          .agg(F.count(F.lit(1)).alias("__mr")).withColumn("__s", n_salts))
    lsalt = F.pmod(F.xxhash64(*[col(c) for c in lcols]), F.col("__s")).cast("int")
    rsalt = F.pmod(F.xxhash64(*[col(c) for c in rcols]), F.col("__s")).cast("int")
    lm = lm.withColumn("__k", F.explode(F.when(left_big, F.array(lsalt)).otherwise(every_salt)))
    rm = rm.withColumn("__k", F.explode(F.when(left_big, every_salt).otherwise(F.array(rsalt))))
    l, r = lm.alias("__l"), rm.alias("__r")
    cond = reduce(lambda a, b: a & b, [_q("__l", k).eqNullSafe(_q("__r", k)) for k in keys]
                  + [_q("__l", "__k") == _q("__r", "__k")])
    # ml x mr copies of each pair of distinct rows: dealt out in blocks, then expanded
    pairs = l.join(r, cond, "inner").select(
        *_output_columns(lcols, rcols, keys, common, lambda c: _q("__l", c), lambda c: _q("__r", c)),
        (_q("__l", "__ml") * _q("__r", "__mr")).alias("__n"))
    names = [c for c in pairs.columns if c != "__n"]
    blocks = pairs.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES))))
    blocks = blocks.repartition("__block", F.xxhash64(*[col(c) for c in names]))
    here = F.least(F.lit(COPIES).cast("long"), F.col("__n") - F.col("__block") * COPIES)
    both = (blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
            .select(*[col(c) for c in names]))
    return lonly.unionByName(ronly).unionByName(both)


def natural_full_join(left: DataFrame, right: DataFrame,
                      keys: Sequence[str] | None = None, split_hot_keys: bool = True,
                      num_partitions: int | None = None,
                      hot_min_rows: int = HOT_FLOOR) -> DataFrame:
    """Full outer join on all common columns (or ``keys``), NULL matching NULL.

    Output columns: ``left``'s in order, then ``right``-only columns.  With an explicit
    ``keys`` list, common non-key columns come out as ``<name>_x`` / ``<name>_y``.

    Ordinary key tuples go through one sort-merge full outer join on the null-safe keys.
    AQE cannot split skew in a full outer join, so with ``split_hot_keys`` key tuples
    holding more rows than a balanced partition are found first (one aggregation) and
    joined by ``_hot_full_join`` instead.
    """
    _check_case([left, right])
    common = common_columns(left, right)
    keys = list(common if keys is None else keys)
    _check_keys(left, right, keys)
    lcols, rcols = list(left.columns), list(right.columns)
    if not split_hot_keys:
        return _plain_full_join(left, right, keys, common, lcols, rcols)
    n = num_partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_join_keys(left, right, keys, n, hot_min_rows)
    if hot is None:
        return _plain_full_join(left, right, keys, common, lcols, rcols)
    hk = F.broadcast(hot.select(*[F.col(f"`{k}`").alias(f"__h{i}") for i, k in enumerate(keys)]))
    cond = lambda: reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__h{i}"))
                                               for i, k in enumerate(keys)])
    lnorm = left.join(hk, cond(), "left_anti")
    rnorm = right.join(hk, cond(), "left_anti")
    total = hot.agg(F.sum(F.col("__a") + F.col("__b"))).first()[0] or 0
    rows_per_task = max(1, int(total // max(n, 1)))
    plain = _plain_full_join(lnorm, rnorm, keys, common, lcols, rcols)
    return plain.unionByName(_hot_full_join(left, right, hot, keys, common, lcols, rcols,
                                            rows_per_task))


def stack_waves(waves: Sequence[DataFrame]) -> DataFrame:
    """Stack waves by column name, filling absent columns with NULL (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), waves)


def waves_disjoint(waves: Sequence[DataFrame], column: str) -> bool:
    """True when no value of ``column`` (NULL counted as a value) occurs in two waves.

    Reads only ``column`` from each wave; the aggregation is partial/final, so its
    shuffle carries at most (#distinct values × #waves) rows.
    """
    if any(column not in w.columns for w in waves):
        return False
    waves = align_types([w.select(F.col(f"`{column}`")) for w in waves])
    tagged = [w.select(F.col(f"`{column}`").alias("v")).distinct().withColumn("w", F.lit(i))
              for i, w in enumerate(waves)]
    shared = (reduce(DataFrame.unionByName, tagged)
              .groupBy("v").agg(F.count("w").alias("k")).where("k > 1"))
    return shared.limit(1).count() == 0


def _tuple_hash(df: DataFrame, shared: Sequence[str]):
    """64-bit hash of the shared columns; a NULL is a value of its own."""
    return F.xxhash64(*[x for c in shared for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _met_again(waves: Sequence[DataFrame], shared: Sequence[str]) -> DataFrame:
    """(__t): hashes of shared tuples that occur in more than one wave.

    Only hashes are shuffled, one a wave and map task at most.  A chance collision only
    sends rows to the join that would also have been right in the stack."""
    tagged = reduce(DataFrame.unionByName, [
        w.select(_tuple_hash(w, shared).alias("__t"), F.lit(i).alias("__w")) for i, w in enumerate(waves)])
    return (tagged.groupBy("__t").agg(F.min("__w").alias("a"), F.max("__w").alias("b"))
            .where("a < b").select("__t"))


def fold_waves(waves: Sequence[DataFrame], keys: Sequence[str] | None = None,
               disjoint_on: str | None = None, split_hot_keys: bool = True,
               num_partitions: int | None = None, hot_min_rows: int = HOT_FLOOR) -> DataFrame:
    """``natural_full_join`` folded left to right over the waves.

    A column whose type differs between waves first gets its least common type over all of
    them (``wavetypes.align_types``); a pair of types that no type holds without loss is an
    error that names both.  Columns keep their attributes (``attributes``), of waves that
    differ the earlier one's.

    ``disjoint_on`` names a shared column whose values never repeat across waves; when
    the check confirms it, the fold is computed as a stack instead (same rows, no
    shuffle).

    Every step's key set contains the columns shared by all waves.  A row whose shared
    tuple occurs in its own wave only can match nowhere and goes straight to the stack; only
    the others are joined, step by step.  Which tuples occur again is found by one
    aggregation of their hashes, written to the shared checkpoint folder.  Of the rows that
    are joined, hot key tuples are split at each step (``natural_full_join``), and each
    intermediate result is written, so the next step reads it instead of recomputing every
    earlier join.  With an explicit ``keys`` list all rows are joined.
    """
    waves = list(waves)
    if len(waves) == 1:
        return waves[0]
    _check_case(waves)
    said, waves = merged_attributes(waves), align_types(waves)
    if disjoint_on is not None and keys is None and waves_disjoint(waves, disjoint_on):
        return with_metadata(stack_waves(waves), said)
    n = num_partitions or int(waves[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chained(parts: Sequence[DataFrame]) -> DataFrame:
        acc = parts[0]
        for i, wave in enumerate(parts[1:], start=1):
            acc = natural_full_join(acc, wave, keys, split_hot_keys=split_hot_keys,
                                    num_partitions=n, hot_min_rows=hot_min_rows)
            if split_hot_keys and i < len(parts) - 1:
                acc = cut_lineage(acc, "wave-fold")
        return acc

    shared = [c for c in waves[0].columns if all(c in w.columns for w in waves[1:])]
    if keys is not None or not shared:
        return with_metadata(chained(waves), said)
    again = cut_lineage(_met_again(waves, shared), "wave-tuples")
    some = bounded_broadcast(again, MAX_TUPLES)
    if again.isEmpty():
        return with_metadata(stack_waves(waves), said)
    split = lambda w, how: w.join(some, _tuple_hash(w, shared) == F.col("__t"), how)
    alone = stack_waves([split(w, "left_anti") for w in waves])
    return with_metadata(alone.unionByName(chained([split(w, "left_semi") for w in waves])), said)

