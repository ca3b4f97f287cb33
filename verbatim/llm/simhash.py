"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has bit b set if over half of the 64-bit hashes of the text's word shingles
have it set.  Two fingerprints are linked if at most ``MAX_BITS`` (4) bits differ.

Candidates: the 64 bits are three segments of 22, 21 and 21 bits, each a word of the perfect
(23, 12) Golay code's space with the rest zero.  A segment's keys are the indices of all
codewords within 4 bits of it: one index if the nearest codeword is at most 2 bits away,
otherwise six.  Segments that differ in at most two bits share an index.  With at most four
errors over three segments, by the pigeonhole principle either

* a segment has none, and one of the others has at most two: key = index of the one and the
  whole of the other (six ordered pairs of segments); or
* every segment has one and at most one of them two: key = index of that segment and, of
  both others, a half without error (three times four choices).

So every link has a shared key of at least 32 bits, and no pair of fingerprints is missed.
Rows of a key come sorted to a task, which verifies the bit distance and passes on a
spanning forest of the links, never all pairs of a group; memory is one key's fingerprints.
Components come from these links by ``components.stars``.

Defined results: a null or wordless text has fingerprint 0 and is linked like any other; a
text of fewer words than the shingle length is one shingle; repeated rows have one component; a
null doc_id is ignored when the smallest id of a component is sought; an empty table gives
an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table, text_bytes
from verbatim.llm.components import stars

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the (23, 12) Golay code
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
SMALL_RUN = 8


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """SimHash of the text's lower-case words in shingles of k."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        starts = np.concatenate([[0], spaces + 1])[:len(words) - k + 1].tolist()
        ends = np.concatenate([spaces, [len(line)]])[k - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends)]
    bits, n = np.zeros(64, np.int64), len(hashes)
    for i in range(0, n, 1 << 16):  # a very long text in pieces
        part = np.array(hashes[i:i + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp) of each document: the text's hash, and fp as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in text_bytes(b.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "h", "fp"])
    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, f"doc_id {ids}, h long, fp long")


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; by syndrome, the nearest error and, if
    that has weight 3, the five codewords of weight 7 that hold it (else zeros)."""
    def remainder(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GENERATOR << (i - 11)
        return x
    low = np.array([remainder(x) for x in range(1 << 12)], np.uint32)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], np.uint32)
    error, around = np.zeros(1 << 11, np.uint32), np.zeros((1 << 11, 5), np.uint32)
    top = np.arange(1 << 12, dtype=np.uint32) << 11
    words = top ^ np.array([remainder(int(x)) for x in top], np.uint32)
    sevens = words[np.bitwise_count(words) == 7]
    for weight in range(1, 4):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            s = remainder(e)
            error[s] = e
            if weight == 3:
                around[s] = sevens[(sevens & e) == e]
    return low, high, error, around


def indices(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words, six columns of 12-bit codeword indices and whether each is there."""
    low, high, error, around = golay()
    s = low[x & 0xFFF] ^ high[x >> 12]
    near = x ^ error[s]
    more = near[:, None] ^ around[s]
    there = np.repeat((around[s][:, :1] != 0), 5, axis=1)
    return (np.concatenate([near[:, None], more], axis=1) >> 11,
            np.concatenate([np.ones((len(x), 1), bool), there], axis=1))


def keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, fingerprint) rows of unsigned fingerprints, a table of keys at a time."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    halves = [(p & 0x7FF, p >> 11) for p in parts]
    exact = []  # of each index table: what must agree besides the index
    for g in range(3):
        a, b = (i for i in range(3) if i != g)
        exact += [(g, parts[a].astype(np.uint64)), (g, parts[b].astype(np.uint64))]
        exact += [(g, x.astype(np.uint64) << np.uint64(11) | y.astype(np.uint64)) for x in halves[a] for y in halves[b]]
    index = [indices(p) for p in parts]
    for number, (g, rest) in enumerate(exact):
        codes, there = index[g]
        key = (np.uint64(number) << np.uint64(40)) | (codes.astype(np.uint64) << np.uint64(24)) | rest[:, None]
        yield key[there], np.repeat(fps, there.sum(axis=1))


def forest(fps: np.ndarray, most: int = MAX_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among the distinct fingerprints of one key."""
    rest, out = fps, []
    while len(rest):
        wait, rest = [rest[0]], rest[1:]
        while wait and len(rest):
            x = wait.pop()
            near = np.bitwise_count(rest ^ x) <= most
            if near.any():
                found = rest[near]
                out.append((np.full(len(found), x), found))
                wait.extend(found)
                rest = rest[~near]
    return out


def _links_of_keys(key: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among rows sorted by key; all rows of a key are there."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    length = np.diff(np.concatenate([first, [len(key)]]))
    out = []
    for start, n in zip(first[length > SMALL_RUN].tolist(), length[length > SMALL_RUN].tolist()):
        out += forest(np.unique(fp[start:start + n]))
    small = np.repeat(length <= SMALL_RUN, length)
    for lag in range(1, SMALL_RUN):
        same = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:])
        if not len(same):
            break
        x, y = fp[same], fp[same + lag]
        near = (np.bitwise_count(x ^ y) <= MAX_BITS) & (x != y)
        out.append((x[near], y[near]))
    return out


def links(distinct_fps: DataFrame) -> DataFrame:
    """(u, v): links that connect exactly the fingerprints joined by chains of at most
    ``MAX_BITS`` differing bits."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, fp in keys(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["key", "fp"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        held = []

        def verified(k, f):
            pairs = _links_of_keys(k, f)
            u = np.concatenate([p[0] for p in pairs] or [fp[:0]]).view(np.int64)
            v = np.concatenate([p[1] for p in pairs] or [fp[:0]]).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1) if len(u) else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)))
            if held[0][0][0] == held[-1][0][-1] or sum(len(x[0]) for x in held) < 200_000:
                continue
            key, fp = (np.concatenate(x) for x in zip(*held))
            cut = np.searchsorted(key, key[-1])  # the last key may go on in the next batch
            yield verified(key[:cut], fp[:cut])
            held = [(key[cut:], fp[cut:])]
        if held:
            yield verified(*(np.concatenate(x) for x in zip(*held)))

    rows = distinct_fps.mapInArrow(make, "key long, fp long")
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(match, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, tables: Tables, k: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp, root, component_id) of each document; root is a fingerprint that names
    the component, also where no document of it has an id."""
    fps = tables.put(fingerprints(docs, k), "fps")
    # one row per fingerprint, whatever the number of its copies
    classes = tables.put(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = stars(links(classes.select("fp")), tables).withColumnRenamed("node", "fp")
    linked = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = tables.put(linked.join(least, "root").select("fp", "root", "component_id"), "named")
    return fps.join(named, "fp")


def keep_one(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One document of each component stays: the one with the smallest id (of several with
    that id, or of none with an id, the one with the smallest text hash).

    Of rows equal in id and text one stays."""
    tables = Tables(docs.sparkSession, "simhash")
    found = near_duplicates(docs, tables, k)
    rows = found.groupBy("root", "doc_id", "h").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "rows")).alias("f")
    kept = tables.put(rows.groupBy("root").agg(first).select("f.doc_id", "f.h", "f.rows"), "kept")
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    on = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64("d.text") == F.col("k.h"))
    once = docs.alias("d").join(kept.where("rows = 1").alias("k"), on, "left_semi").select(*own)
    more = kept.where("rows > 1")
    if more.isEmpty():
        return once
    return once.union(docs.alias("d").join(more.alias("k"), on, "left_semi").select(*own).dropDuplicates(["doc_id", "text"]))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), Tables(spark, "op3"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
