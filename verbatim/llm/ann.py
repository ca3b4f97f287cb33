"""Approximate nearest neighbours by largest inner product: cross-polytope hashing.

Rows are split into bands of norms within a factor of the square root of 2.  In each band
vectors are scaled by its greatest norm and lifted by one coordinate to unit length, so that
the largest inner product with a query is the nearest unit vector.  For each of ``TABLES``
tables, three rounds of random signs and a fast Hadamard transform rotate them (padded with
zeros to a power of two, ``D``), and a vector belongs to the cell of its nearest signed axis,
one of ``2 D``.  A query looks into the ``PROBES`` nearest cells of every table and band, and
each candidate is ranked by the exact inner product of the original vectors in double
precision.  Every band is hashed, however few rows it has.

Every row is indexed; nothing is fitted but the bands' norms and the length.  A cell is dealt
out in blocks of at most about ``BLOCK`` rows and as many queries, so no cell has to fit
into one task.  Of equal vectors only the ``k + 1`` with the smallest ids are indexed: no
other can be among the ``k`` nearest of any query, as ties go to the smaller id.

Defined results: a vector that is null, zero or holds null or non-finite components takes no
part, neither does a row without id; shorter vectors count as filled up with zeros; rows
with the query's id are its own; rows equal in id and vector count once; fewer candidates
than ``k`` are all returned, as a query that found fewer than ``k`` rows in its cells is
compared with all rows, in the same blocks; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table

TABLES = 12
PROBES = 20
BLOCK = 4_000
NEAREST = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d, h = len(x), x.shape[1], 1
    while h < d:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def signs(tables: int, d: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (tables, 3, d))


def lifted(x: np.ndarray, norm: np.ndarray | float, d: int, query: bool) -> np.ndarray:
    """Unit vectors of length d whose inner products order like the originals' of one norm."""
    out = np.zeros((len(x), d))
    if query:
        out[:, :x.shape[1]] = x / np.linalg.norm(x, axis=1)[:, None]
    else:
        out[:, :x.shape[1]] = x / np.reshape(norm, (-1, 1))
        out[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (out * out).sum(axis=1)))
    return out


def axes(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Closeness of each row to each of the 2 D signed axes after one table's rotation."""
    for s in turn:
        x = hadamard(x * s)
    return np.concatenate([x, -x], axis=1)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    if not len(vectors):
        return np.zeros((0, size))
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size))
    out[np.arange(size)[None, :] < lengths[:, None]] = flat
    return out


def nearest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, id, score) of each query's k nearest; ties to the smaller id.

    A matrix product finds who can be among them; the score itself is summed row by row, so
    that equal vectors get equal scores wherever they stand."""
    out = []
    for i in range(0, len(q), 512):
        part = q[i:i + 512]
        rough = part @ x.T
        rough[q_ids[i:i + 512][:, None] == ids[None, :]] = -np.inf
        least = np.partition(rough, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
        room = 1e-9 * (np.linalg.norm(part, axis=1) * np.linalg.norm(x, axis=1).max())
        who, which = np.nonzero((rough >= (least - room)[:, None]) & np.isfinite(rough))
        score = (part[who] * x[which]).sum(axis=1)
        order = np.lexsort((ids[which], -score, who))
        who, which, score = who[order], which[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        good = place < k
        out.append((who[good] + i, ids[which[good]], score[good]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def valid(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) rows that take part, each once."""
    good = ("vector IS NOT NULL AND vec_id IS NOT NULL AND forall(vector, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')) "
            "AND exists(vector, v -> v <> 0)")
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(good).distinct()


def search(queries: DataFrame, rows: DataFrame, tables: Tables, k: int = NEAREST,
           hash_tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query.

    ``queries`` and ``rows`` are (vec_id, vector) as ``valid`` gives them."""
    same = Window.partitionBy("vector").orderBy("vec_id")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    band = F.coalesce(F.floor(2 * F.log2("norm") + 0.5), F.lit(-1 << 20)).cast("int")  # norm 1 is amid its band
    # the row number's limit is applied before the shuffle too, so copies don't gather
    rows = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    rows = tables.put(rows.withColumn("norm", norm).withColumn("band", band), "rows")
    # some thousand bands at most, whatever the data
    bands = rows.groupBy("band").agg(F.max("norm").alias("most"), F.max(F.size("vector")).alias("size")).collect()
    if not bands:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = max(r["size"] for r in bands)
    d = 1 << int(size).bit_length()
    hashed = sorted((r["band"], r["most"]) for r in bands)
    turns = signs(hash_tables, d)
    numbers, mosts = np.array([b for b, _ in hashed], np.int32), np.array([m for _, m in hashed])

    def batch(cell: np.ndarray, part: pa.RecordBatch, who: np.ndarray, band: np.ndarray | None) -> pa.RecordBatch:
        out = {"cell": pa.array(cell.astype(np.int32)), "vec_id": part.column(0).take(pa.array(who)), "vector": part.column(1).take(pa.array(who))}
        return pa.RecordBatch.from_pydict(out if band is None else {"band": pa.array(band), **out})

    def indexed_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                band, who = part.column(2).to_numpy(), np.arange(part.num_rows)
                unit = lifted(_matrix(part.column(1), size), mosts[np.searchsorted(numbers, band)], d, False)
                for t, turn in enumerate(turns):
                    yield batch(t * 2 * d + axes(unit, turn).argmax(axis=1), part, who, band)

    def probed_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                unit = lifted(_matrix(part.column(1), size), 1.0, d, True)
                n = min(probes, 2 * d)
                for t, turn in enumerate(turns):
                    best = np.argpartition(-axes(unit, turn), n - 1, axis=1)[:, :n]
                    yield batch((t * 2 * d + best).ravel(), part, np.repeat(np.arange(part.num_rows), n), None)

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"cell int, vec_id long, vector {kind}"
    indexed = tables.put(rows.select("vec_id", "vector", "band").mapInArrow(indexed_cells, f"band int, {schema}"), "index")
    rows = rows.select("vec_id", "vector")
    asked = tables.put(queries.mapInArrow(probed_cells, schema), "probes")
    # 2 D cells a table and band: numbers that don't grow with the data
    sizes = indexed.groupBy("band", "cell").agg(F.count("*").alias("n")).join(asked.groupBy("cell").agg(F.count("*").alias("m")), "cell")
    blocks = sizes.select("band", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("m") / block).cast("int").alias("parts"))
    blocks = F.broadcast(tables.put(blocks, "blocks"))
    pick = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = asked.join(blocks, "cell").withColumn("part", pick(F.col("parts"), 1)).withColumn("block", every(F.col("blocks"))).drop("blocks", "parts")
    right = indexed.join(blocks, ["band", "cell"]).withColumn("block", pick(F.col("blocks"), 2)).withColumn("part", every(F.col("parts"))).drop("blocks", "parts")

    def rank(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "q_key": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q_ids, ids = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
        q, x = _matrix(a["vector"].combine_chunks(), size), _matrix(b["vector"].combine_chunks(), size)
        who, found, score = nearest(q_ids, q, ids, x, k)
        return pa.table({"query": q_ids[who], "q_key": a["q_key"].to_numpy()[who], "vec_id": found, "score": score})

    key = ["band", "cell", "block", "part"]
    left = left.withColumn("q_key", F.xxhash64("vector"))
    ranked = "query long, q_key long, vec_id long, score double"

    def best(found: DataFrame) -> DataFrame:
        # a candidate found in several tables has the same score each time
        once = found.groupBy("query", "q_key", "vec_id", "score").agg(F.lit(1))
        order = Window.partitionBy("query", "q_key").orderBy(F.desc("score"), "vec_id")
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "q_key", "vec_id", "score", "rank")

    found = tables.put(best(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rank, ranked)), "found")
    # queries whose cells hold too few rows are compared with all rows
    full = found.groupBy("query", "q_key").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = queries.withColumn("q_key", F.xxhash64("vector"))
    short = tables.put(short.join(full, (F.col("vec_id") == F.col("query")) & (short["q_key"] == full["q_key"]), "left_anti"), "short")
    parts = -(-short.count() // block)
    if parts:
        key, blocks = ["block", "part"], -(-rows.count() // block)
        left = short.withColumn("part", pick(F.lit(parts), 1)).withColumn("block", every(F.lit(blocks)))
        right = rows.withColumn("block", pick(F.lit(blocks), 2)).withColumn("part", every(F.lit(parts)))
        exact = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rank, ranked)
        found = best(found.drop("rank").unionByName(exact))
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, "op7")
    rows = tables.put(valid(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "valid")
    return search(rows.where("vec_id % 20 = 0"), rows, tables)
