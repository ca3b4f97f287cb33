"""Mixing sources to target weights by Pareto order sampling.

Sources, ordered by code point (null last), weigh 1, 2, 3, repeating.  The mix has as many
words as the input; a source's target is its weight's share, at most ``CAP`` times its own
size, and what is cut off is shared again by weight until no target is above.

A document is expected ``e = target / source size`` times (times its relative weight, if a
weight column is given, at most ``CAP``).  ``floor(e)`` copies are certain.  For the
fraction ``p = e - floor(e)`` the documents are ranked by the Pareto key
``(u / (1 - u)) / (p / (1 - p))`` with ``u`` a hash of the row, and taken in that order
until the words of the sample fill what the certain copies leave of the target: a sample of
fixed size in words with unequal inclusion probabilities.  Near the end of the sample a
document that no longer fits is passed over for a later, shorter one.

The place where the sample ends is found by histograms of the key, refined only in the bin
that holds the end, so that no source is ever sorted or gathered; the last bin (some
thousand rows) is filled by one task per source.

Defined results: a null text has size 0; a null source is a source of its own; rows equal in
id, source and text share one decision; documents without words are taken with 0 words; an
empty table gives an empty mix.  Only the named columns are read, others are kept by
``mix`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.llm.common import Tables, row_hash, table, text_bytes, word_spans
from verbatim.operators.broadcast import bounded_broadcast

WEIGHTS = (1, 2, 3)
CAP = 3.0
BINS = 1024
LAST_ROWS = 2_000  # a bin of at most so many rows is filled by one task
MAX_SOURCES = 100_000  # a broadcast of one row a source up to here, a shuffle join beyond


@F.arrow_udf(T.LongType())
def words(text: pa.Array) -> pa.Array:
    """Words of each text; 0 for null."""
    return pa.array(word_spans(text_bytes(text))[3].astype(np.int64))


def source_targets(sizes: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum(F.col("size") * F.col("weight")).alias("weighted_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("share", F.element_at(F.array(*map(F.lit, WEIGHTS)),
                                               ((F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1)))
    # Water level: sources whose cap lies under it take their cap, the others weight x level.
    ratio = F.col("source_size") * cap / F.col("share")
    upto = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything)
            - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
    weight = F.sum("share").over(everything) - F.coalesce(F.sum("share").over(upto), F.lit(0))
    per = per.withColumn("level", left / weight).withColumn("ratio", ratio)
    # The first source whose cap is above its level has the right one; later ones are lower.
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    return per.select("source", "source_size", "weighted_size",
                      F.least(F.col("source_size") * cap, F.col("share") * level).alias("target"))


def _ranked(rows: DataFrame, targets: DataFrame, seed: int, cap: float) -> DataFrame:
    """Adds source_size, target, certain copies and the rank key z in (0, 1)."""
    t = targets.withColumnRenamed("source", "t_source")
    rows = rows.join(bounded_broadcast(t, MAX_SOURCES), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    e = F.when(F.col("weighted_size") > 0,
               F.least(F.lit(cap), F.col("target") * F.col("weight") / F.col("weighted_size"))).otherwise(0.0)
    e = F.when(F.abs(e - F.round(e)) < 1e-12, F.round(e)).otherwise(e)  # a whole number but for rounding
    p = F.col("expected") - F.col("whole")
    u = (F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    a, b = u * (1 - p), p * (1 - u)
    return (rows.withColumn("expected", e).withColumn("whole", F.floor("expected"))
            .withColumn("z", F.when(F.col("whole") >= cap, F.lit(1.0)).otherwise(a / (a + b))))


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Takes documents in rank order while they fit; one more if that comes nearer."""
    rows = rows.sort_values(["z", "key"], kind="stable").reset_index(drop=True)
    left, taken = float(rows["left"].iloc[0]), np.zeros(len(rows), bool)
    size, may = rows["item_size"].to_numpy(), rows["whole"].to_numpy() < CAP
    for i in np.flatnonzero(may & (size > 0)):
        if size[i] <= left:
            taken[i], left = True, left - size[i]
    rest = np.flatnonzero(may & ~taken & (size > 0))
    if len(rest):
        i = rest[np.argmin(size[rest])]
        if size[i] < 2 * left:
            taken[i] = True
    return pd.DataFrame({"source": rows["source"], "b_key": rows["key"], "extra": taken.astype(np.int64)})


def plan_mix(rows: DataFrame, tables: Tables, seed: int = 0, cap: float = CAP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From a table (source, size, weight, key): the targets, where each source's sample
    ends (``lo``, ``hi`` of the last bin) and which rows of that bin it takes."""
    targets = tables.put(source_targets(rows, cap), "targets")
    ranked = _ranked(rows, targets, seed, cap)
    ends = tables.put(
        ranked.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("left"),
                                     F.count("*").alias("rows"))
        .select("source", F.lit(0.0).alias("lo"), F.lit(1.0 + 2.0 ** -40).alias("hi"), "left", "rows"), "ends0")
    for level in range(1, 6):
        if ends.where((F.col("rows") > LAST_ROWS) & (F.col("left") > 0)).isEmpty():
            break
        e = bounded_broadcast(ends.withColumnRenamed("source", "e_source"), MAX_SOURCES)
        inside = (ranked.join(e, F.col("source").eqNullSafe(F.col("e_source")))
                  .where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi"))))
        bins = (inside.withColumn("bin", F.least(F.lit(BINS - 1), F.floor((F.col("z") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)))
                .groupBy("source", "bin").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("left").alias("left"),
                                              F.sum("size").alias("words"), F.count("*").alias("rows")))
        before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumn("left_here", F.col("left") - before)
        pick = F.max_by(F.struct(
            (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / BINS).alias("lo"),
            F.when(F.col("bin") == BINS - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / BINS).alias("hi"),
            F.col("left_here").alias("left"), "rows"), F.when(F.col("left_here") > 0, F.col("bin")).otherwise(-1 - F.col("bin")))
        ends = tables.put(bins.groupBy("source").agg(pick.alias("p")).select("source", "p.*"), f"ends{level}")
    e = bounded_broadcast(ends.withColumnRenamed("source", "e_source"), MAX_SOURCES)
    # sources whose certain copies reach the target, and rows without a fraction, have nothing to fill
    last = (ranked.join(e.where("left > 0"), F.col("source").eqNullSafe(F.col("e_source")))
            .where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi")))
            .where((F.col("whole") < cap) & (F.col("expected") > F.col("whole")) & (F.col("size") > 0))
            .groupBy("source", "key", "z", "whole", "left").agg(F.sum("size").alias("item_size")))
    chosen = tables.put(last.groupBy("source").applyInPandas(_fill, "source string, b_key long, extra long"), "chosen")
    return targets, ends, chosen


def apply_mix(rows: DataFrame, plan, seed: int = 0, cap: float = CAP) -> DataFrame:
    """Adds source_size, target and copies to rows with source, size, weight and key."""
    targets, ends, chosen = plan
    e = bounded_broadcast(ends.select(F.col("source").alias("e_source"), "lo", "hi"), MAX_SOURCES)
    c = chosen.where("extra > 0").select(F.col("source").alias("c_source"), "b_key", "extra")
    out = _ranked(rows, targets, seed, cap).join(e, F.col("source").eqNullSafe(F.col("e_source")))
    out = out.join(bounded_broadcast(c, MAX_SOURCES), (F.col("key") == F.col("b_key")) & F.col("source").eqNullSafe(F.col("c_source")), "left")
    extra = F.when(F.col("z") < F.col("lo"), 1).otherwise(F.coalesce(F.col("extra"), F.lit(0)))
    return (out.withColumn("copies", (F.col("whole") + extra).cast("long"))
            .drop("e_source", "lo", "hi", "c_source", "b_key", "extra", "weighted_size", "expected", "whole", "z"))


def sized(docs: DataFrame, weight: str | None = None) -> DataFrame:
    """(doc_id, source, size, weight, key) of each document."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    return docs.select("doc_id", "source", words("text").alias("size"), w.alias("weight"),
                       row_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    spark = docs.sparkSession
    tables = Tables(spark, "mix")
    plan = plan_mix(tables.put(sized(docs).drop("doc_id"), "sizes"), tables, seed)
    own = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col("source"), words("text").alias("size"),
                         F.lit(1.0).alias("weight"), row_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"))
    taken = apply_mix(packed, plan, seed).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    tables = Tables(spark, "op5")
    rows = tables.put(sized(docs), "sizes")
    out = apply_mix(rows, plan_mix(rows, tables))
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")
