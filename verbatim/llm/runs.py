"""Positions and running values over rows in a global order, however long one key's run is.

Rows are dealt out by ranges of (keys, order), so that a key with a third of all rows lies in
many tasks.  Each task works through its sorted rows in batches, with values that count from
the start of its own first run, and writes them.  A run that began in an earlier task is then
completed by what that task's last row had reached: one number or value for each of the
written partitions, which are the only rows that reach the driver.

The order must tell all rows apart that are not interchangeable.  Keys are longs, not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.llm.common import Tables

ROWS = 1_000_000  # rows of a partition, unless there are fewer than the session's partitions
#: The bases of the two chains, both 5 modulo 8.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED05)


def partitions(rows: DataFrame) -> int:
    """Partitions for the rows of a written table."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, math.ceil(rows.count() / ROWS))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def power(base: int, at: np.ndarray) -> np.ndarray:
    """base^at modulo 2^64."""
    out, square, left = np.ones(len(at), np.uint64), np.uint64(base), at.astype(np.uint64)
    with np.errstate(over="ignore"):
        while left.any():
            out = np.where(left & np.uint64(1), out * square, out)
            square, left = square * square, left >> np.uint64(1)
    return out


@dataclass(frozen=True)
class Wanted:
    """What is sought of each row, besides ``nth``, its position in its run (from 1).

    sums: running sums up to and with the row (``name_sum``).
    chains: columns of 64 random bits x; polynomial hashes of the run's values up to the row
        (``name_chain``) and up to the one before (``name_before``).
    carry: the last value that isn't null at the row or before it in its run, in place.
    lag: the value of the row before in its run (``name_lag``).
    """

    sums: Sequence[str] = ()
    chains: Sequence[str] = ()
    carry: Sequence[str] = ()
    lag: Sequence[str] = ()
    keep: Sequence[str] = field(default=())


def _array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), valid


def _filled(column: pa.Array, starts: np.ndarray, before) -> pa.Array:
    """Last value in the run that isn't null; ``before``: what the first run brings along."""
    n = len(column)
    at = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1)
    at = np.maximum.accumulate(at)
    first = np.maximum.accumulate(np.where(starts, np.arange(n), 0 if n and not starts[0] else -1))
    out = column.take(pa.array(np.where(at >= first, at, -1), mask=at < first))
    if before is None or not n or starts[0]:
        return out
    open_ = (np.cumsum(starts) == 0) & ~out.is_valid().to_numpy(zero_copy_only=False)
    return pa.compute.if_else(pa.array(open_), pa.scalar(before, column.type), out) if open_.any() else out


def _local(keys: Sequence[str], want: Wanted):
    """Values within one task; ``run`` is 0 for rows of its first run, ``edge`` 1 for its first
    row, 2 for its last (3 for an only one)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401  (pa.compute)
        part = TaskContext.get().partitionId()
        last_key, nth, run = None, 0, -1
        sums, chains = dict.fromkeys(want.sums, 0), dict.fromkeys(want.chains, 0)
        carry, lag = dict.fromkeys(want.carry), dict.fromkeys(want.lag)
        held = None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in keys])
            new = np.empty(n, bool)
            new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            new[0] = last_key is None or bool((key[:, 0] != last_key).any())
            runs = run + np.cumsum(new)
            where = np.arange(n)
            start = np.maximum.accumulate(np.where(new, where, -1))
            mine = start < 0  # of the run that is open from the batch before
            at = np.where(mine, nth + where + 1, where - start + 1).astype(np.int64)
            cols, names = [b.column(k) for k in (*keys, *want.keep)], [*keys, *want.keep]
            for s in want.sums:
                total = np.cumsum(b.column(s).to_numpy(zero_copy_only=False).astype(np.int64))
                off = np.where(mine, -sums[s], np.where(start > 0, total[np.maximum(start - 1, 0)], 0))
                cols.append(pa.array(total - off))
                names.append(f"{s}_sum")
                sums[s] = int(total[-1] - off[-1])
            for i, c in enumerate(want.chains):
                with np.errstate(over="ignore"):
                    base = BASES[i % 2]
                    top = powers(base, n + 1)
                    x = b.column(c).to_numpy(zero_copy_only=False).view(np.uint64)
                    # of a later run, every position counts from its start: divided by the power there
                    rolled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * top[:n], dtype=np.uint64)])
                    from_ = np.maximum(start, 0)
                    back = powers(pow(base, -1, 1 << 64), n)[from_]
                    fresh = (rolled[1:] - rolled[from_]) * back * np.uint64(base)
                    early = (rolled[:-1] - rolled[from_]) * back * np.uint64(base)
                    lift = power(base, np.array([nth]))[0] * np.uint64(base)
                    value = np.where(mine, np.uint64(chains[c]) + rolled[1:] * lift, fresh)
                    before = np.where(mine, np.uint64(chains[c]) + rolled[:-1] * lift, early)
                cols += [pa.array(value.view(np.int64)), pa.array(before.view(np.int64))]
                names += [f"{c}_chain", f"{c}_before"]
                chains[c] = int(value[-1])
            for c in want.carry:
                filled = _filled(b.column(c), new, carry[c])
                cols.append(filled)
                names.append(c)
                carry[c] = filled[-1].as_py()
            for c in want.lag:
                col = b.column(c)
                shifted = pa.concat_arrays([pa.array([lag[c]], col.type), col.slice(0, n - 1)])
                cols.append(pa.compute.if_else(pa.array(new), pa.scalar(None, col.type), shifted))
                names.append(f"{c}_lag")
                lag[c] = col[-1].as_py()
            edge = np.zeros(n, np.int32)
            edge[0] = last_key is None
            cols += [pa.array(at), pa.array(np.full(n, part, np.int32)), pa.array(np.minimum(runs, 1).astype(np.int32)), pa.array(edge)]
            names += ["nth", "_part", "_run", "_edge"]
            for c in want.lag:  # what the task's last row hands on
                cols.append(b.column(c))
                names.append(f"{c}_own")
            nth, run, last_key = int(at[-1]), int(runs[-1]), key[:, -1]
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays(cols, names)
        if held is not None:
            edge = held.column("_edge").to_numpy(zero_copy_only=False).copy()
            edge[-1] += 2
            yield held.set_column(held.schema.names.index("_edge"), "_edge", pa.array(edge))
    return work


def in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], want: Wanted, tables: Tables, name: str) -> DataFrame:
    """The key columns, ``want.keep`` and the wanted values of each row of a written table."""
    parts, types = partitions(rows), {f.name: f.dataType for f in rows.schema}
    used = list(dict.fromkeys([*keys, *want.keep, *want.sums, *want.chains, *want.carry, *want.lag]))
    dealt = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order).select(*used)
    out = [(c, types[c]) for c in (*keys, *want.keep)] + [(f"{c}_sum", T.LongType()) for c in want.sums]
    out += [(f"{c}_{x}", T.LongType()) for c in want.chains for x in ("chain", "before")]
    out += [(c, types[c]) for c in want.carry] + [(f"{c}_lag", types[c]) for c in want.lag] + [("nth", T.LongType())]
    inner = [("_part", T.IntegerType()), ("_run", T.IntegerType()), ("_edge", T.IntegerType())] + [(f"{c}_own", types[c]) for c in want.lag]
    schema = lambda fields: T.StructType([T.StructField(n, t) for n, t in fields])
    found = tables.put(dealt.mapInArrow(_local(keys, want), schema(out + inner)), name)

    # what the first run of each partition continues: at most two rows a partition
    edges: dict[int, dict] = {}
    for r in found.where("_edge > 0").drop(*want.keep).collect():
        edges.setdefault(r["_part"], {})["first" if r["_edge"] == 1 else "last"] = r
        if r["_edge"] == 3:
            edges[r["_part"]]["first"] = r
    brought: dict[int, dict] = {}
    state, state_key = None, None
    for part in sorted(edges):
        first, last = edges[part]["first"], edges[part]["last"]
        key = tuple(first[k] for k in keys)
        into = state if key == state_key else None
        if into:
            brought[part] = into
        state_key = tuple(last[k] for k in keys)
        state = {"nth": last["nth"], **{f"{c}_sum": last[f"{c}_sum"] for c in want.sums}, **{f"{c}_chain": last[f"{c}_chain"] for c in want.chains},
                 **{c: last[c] for c in want.carry}, **{f"{c}_lag": last[f"{c}_own"] for c in want.lag}}
        if last["_run"] == 0 and into:  # the run goes through the whole partition
            for i, c in enumerate(want.chains):
                state[f"{c}_chain"] = _joined(i, into["nth"], into[f"{c}_chain"], np.array([last[f"{c}_chain"]]))[0].item()
            for c in ("nth", *(f"{c}_sum" for c in want.sums)):
                state[c] += into[c]
            for c in want.carry:
                state[c] = into[c] if last[c] is None else last[c]

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401
        for b in batches:
            part, run = b.column("_part").to_numpy(), b.column("_run").to_numpy()
            cols = {n: b.column(n) for n, _ in out}
            for p in np.unique(part):
                into = brought.get(int(p))
                if not into:
                    continue
                mine = (part == p) & (run == 0)
                if not mine.any():
                    continue
                for i, c in enumerate(want.chains):
                    for x in ("chain", "before"):
                        v = cols[f"{c}_{x}"].to_numpy().copy()
                        v[mine] = _joined(i, into["nth"], into[f"{c}_chain"], v[mine])
                        cols[f"{c}_{x}"] = pa.array(v)
                for c in want.lag:
                    head = mine & (cols["nth"].to_numpy() == 1)
                    if head.any():
                        kind = cols[f"{c}_lag"].type
                        cols[f"{c}_lag"] = pa.compute.if_else(pa.array(head), pa.scalar(into[f"{c}_lag"], kind), cols[f"{c}_lag"])
                for c in ("nth", *(f"{c}_sum" for c in want.sums)):
                    cols[c] = pa.array(cols[c].to_numpy() + np.where(mine, into[c], 0))
                for c in want.carry:
                    if into[c] is not None:
                        gap = mine & ~cols[c].is_valid().to_numpy(zero_copy_only=False)
                        cols[c] = pa.compute.if_else(pa.array(gap), pa.scalar(into[c], cols[c].type), cols[c])
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return found.mapInArrow(complete, schema(out))


def _joined(i: int, n: int, chain: int, values: np.ndarray) -> np.ndarray:
    """The chain of n values, then the values of a chain that began after it."""
    with np.errstate(over="ignore"):
        lift = power(BASES[i % 2], np.array([n]))[0]
        return (np.array([chain]).view(np.uint64) + values.view(np.uint64) * lift).view(np.int64)
