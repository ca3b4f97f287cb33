"""Language-model scoring by deleted interpolation of bigram, unigram and uniform estimates.

Tokens are lower-case words and one end per text.  The probability of ``w`` after ``v`` is

    l2 c(v w) / c(v)  +  l1 c(w) / N  +  l0 / (V + 1)

with counts from the training texts (the text's start is a context of its own).  The weights
(l2, l1, l0) depend on the bucket of the context's frequency, the binary logarithm of c(v).
They are learned by expectation-maximisation: one training text in ``KEPT_BACK`` is held out
of the counts, and its tokens' posteriors are summed by bucket over all of them, a Spark job
with one row per bucket each round.  The score then takes counts from all training texts.

How it runs: texts are gathered to blocks of some megabytes; a block's words and pairs are
its distinct 64-bit hashes with counts, so a frequent word costs one entry a block, not one
an occurrence.  Entries are dealt out by ranges of hashes, as many as the corpus needs for
about ``RANGE_ENTRIES`` a range at most, summed, and the sums sent back to the blocks, which
alone need them.  Blocks, and the sums with them, are tables in the shared folder; no
vocabulary or n-gram table is ever in one task or on the driver.  Hashes are taken as exact:
two words or pairs share one by chance in 2^64.

Defined results: a null text is empty and has its end only; without training texts all counts
are zero and the model is uniform; a null id counts as the empty text for the split; rows
with one id are scored each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, doc_crc, table

BLOCK_BYTES = 16 << 20
RANGE_ENTRIES = 2_000_000  # at most about so many words and pairs of all blocks in one range
KEPT_BACK = 10  # one training text in so many is for the mixture weights
ROUNDS = 12
BUCKETS = 40  # binary logarithm of the context's frequency; bucket 0: never seen
END, START = 0, 1  # words' codes in every block
SEED = {END: xxhash.xxh64_intdigest(b"", 1), START: xxhash.xxh64_intdigest(b"", 2)}
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

BLOCK = ("block long, kept_back boolean, doc_ids array<long>, nulls array<boolean>, parts array<int>, n_tokens array<long>, "
         "n_entries long, codes binary, words binary")
ENTRIES = "part int, block long, kind int, keys binary, fit binary, dev binary"
SUMS = "block long, part int, kind int, fit binary, dev binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encode_block(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text (words and an end), the codes of all tokens in order, and the
    hash of each code; codes 0 and 1 are the end and the start."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())))
    words = lists.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(full)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    coded = words.filter(pa.array(full)).dictionary_encode()
    hashes = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
    counts = np.diff(bounds) + 1
    codes = np.full(int(counts.sum()), END, np.uint32)
    last = np.cumsum(counts) - 1
    inside = np.ones(len(codes), bool)
    inside[last] = False
    codes[inside] = coded.indices.to_numpy().astype(np.uint32) + 2
    return counts, codes, np.array([SEED[END], SEED[START], *hashes], np.uint64)


def pair_hashes(codes: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context code and the hash of (context, token)."""
    before = np.concatenate([[START], codes[:-1]]).astype(np.uint32)
    before[np.cumsum(counts)[:-1]] = START
    return before, _mixed(_mixed(hashes[before] + GOLDEN) ^ hashes[codes])


def summed(keys: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with their number in the training texts that are counted
    (part 0) and kept back (part 1)."""
    order = np.argsort(keys, kind="stable")
    keys, parts = keys[order], parts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    add = lambda p: np.add.reduceat((parts == p).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return keys[first], add(0), add(1)


def pack(counts: np.ndarray) -> bytes:
    """Counts as 32-bit integers (two words if any is larger), which compress well."""
    return b"\0" + counts.astype("<u4").tobytes() if not len(counts) or counts.max() < 1 << 32 else b"\1" + counts.astype("<i8").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if raw[:1] == b"\0" else "<i8", offset=1).astype(np.int64)


def blocks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, part, text) to blocks; part 0 is counted, 1 kept back, 2 never learned.
    Each block is there twice: with all its texts, and with those kept back only.
    ``n_entries`` is at least its number of distinct words and pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def made() -> Iterator[pa.RecordBatch]:
            name = int(np.random.default_rng().integers(-1 << 63, 1 << 63))  # names the block once it is written
            for kept_back in (False, True):
                some = [r for r in rows if r[1] == 1] if kept_back else rows
                counts, codes, hashes = encode_block([t for _, _, t in some])
                yield pa.RecordBatch.from_pydict({
                    "block": [name], "kept_back": [kept_back], "doc_ids": [[i or 0 for i, _, _ in some]], "nulls": [[i is None for i, _, _ in some]],
                    "parts": [[p for _, p, _ in some]], "n_tokens": [counts.tolist()],
                    "n_entries": [int(counts.sum()) + len(hashes)], "codes": [codes.tobytes()], "words": [hashes.tobytes()]}, schema)

        schema = pa.schema([("block", pa.int64()), ("kept_back", pa.bool_()), ("doc_ids", pa.list_(pa.int64())), ("nulls", pa.list_(pa.bool_())), ("parts", pa.list_(pa.int32())),
                            ("n_tokens", pa.list_(pa.int64())), ("n_entries", pa.int64()), ("codes", pa.binary()), ("words", pa.binary())])
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows.append(row)
                size += len(row[2] or "")
                if size >= BLOCK_BYTES:
                    yield from made()
                    rows, size = [], 0
        if rows:
            yield from made()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "part", "text").mapInArrow(run, BLOCK)


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts = np.array(row["n_tokens"], np.int64)
    return counts, np.frombuffer(row["codes"], np.uint32), np.frombuffer(row["words"], np.uint64), np.array(row["parts"], np.int32)


def _distinct(row: dict) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, keys, parts of all occurrences) of a block's words (0) and pairs (1)."""
    counts, codes, hashes, parts = _read(row)
    of_token = np.repeat(parts, counts)
    before, pairs = pair_hashes(codes, counts, hashes)
    return [(0, hashes[codes], of_token), (1, pairs, of_token)]


def _split(keys: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` equal ranges of hashes begins among sorted keys, and the end."""
    marks = (np.arange(1, count, dtype=np.float64) * (2.0 ** 64 / count)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, marks), [len(keys)]])


def entries(table_of_blocks: DataFrame, count: int) -> DataFrame:
    """Each block's distinct keys and counts, a row for each range of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                for kind, keys, parts in _distinct(row):
                    keys, fit, dev = summed(keys, parts)
                    at = _split(keys, count)
                    some = [p for p in range(count) if at[p] < at[p + 1]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(some, pa.int32()), pa.array([row["block"]] * len(some), pa.int64()), pa.array([kind] * len(some), pa.int32()),
                        *(pa.array([f(x[at[p]:at[p + 1]]) for p in some], pa.binary()) for x, f in ((keys, np.ndarray.tobytes), (fit, pack), (dev, pack)))],
                        ["part", "block", "kind", "keys", "fit", "dev"])
    return table_of_blocks.where("NOT kept_back").select("block", "parts", "n_tokens", "codes", "words").mapInArrow(run, ENTRIES)


KEPT, TOTALS = 10, 20  # added to the kind: of the keys in texts kept back only; totals


def sums(rows: DataFrame) -> DataFrame:
    """For each entry row, the sums over all blocks of its keys' counts, in its order; again
    for its keys in texts kept back; and of the words, the range's totals and their number."""
    def run(group: pa.Table) -> pa.Table:
        out, part = [], group["part"][0].as_py()
        for kind in sorted(set(group["kind"].to_pylist())):
            some = group.filter(pc.equal(group["kind"], kind))
            keys = [np.frombuffer(k.as_py(), np.uint64) for k in some["keys"]]
            every, place = np.unique(np.concatenate(keys), return_inverse=True)
            ends = np.cumsum([0] + [len(k) for k in keys])
            fit, dev = (np.bincount(place, np.concatenate([unpack(x.as_py()) for x in some[c]]), len(every)).astype(np.int64) for c in ("fit", "dev"))
            if kind == 0:
                numbers = lambda x: pack(np.array([x.sum(), (x > 0).sum()]))
                out.append((0, part, TOTALS, numbers(fit), numbers(fit + dev)))
            for i, block in enumerate(some["block"].to_pylist()):
                at = place[ends[i]:ends[i + 1]]
                out.append((block, part, kind, pack(fit[at]), pack(dev[at])))
                at = at[unpack(some["dev"][i].as_py()) > 0]
                if len(at):
                    out.append((block, part, KEPT + kind, pack(fit[at]), pack(dev[at])))
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "part", "kind", "fit", "dev"), zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))})
    return rows.groupBy("part").applyInArrow(run, SUMS)


def _looked_up(row: dict, parts: list[dict], which: str) -> dict[str, np.ndarray]:
    """Per token of a block: counts of word, context and pair, in the texts that are counted
    ("fit") or in all training texts ("all")."""
    counts, codes, hashes, _ = _read(row)
    before, pairs = pair_hashes(codes, counts, hashes)

    def total(kind: int, distinct: int) -> np.ndarray:
        mine = sorted((p for p in parts if p["kind"] % KEPT == kind), key=lambda p: p["part"])
        out = np.concatenate([unpack(p["fit"]) + (unpack(p["dev"]) if which == "all" else 0) for p in mine] or [np.zeros(0, np.int64)])
        if len(out) != distinct:
            raise ValueError("a block's sums are not complete")
        return out

    present = np.flatnonzero(np.bincount(codes, minlength=len(hashes)))
    distinct, place = np.unique(hashes[present], return_inverse=True)
    by_code = np.zeros(len(hashes), np.int64)
    by_code[present] = total(0, len(distinct))[place]
    out = {"word": by_code[codes]}
    # the context's count: of its word, or at the start of the texts (their ends)
    by_code[START], by_code[END] = by_code[END], 0
    out["context"] = by_code[before]
    distinct, place = np.unique(pairs, return_inverse=True)
    out["pair"] = total(1, len(distinct))[place]
    return out


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.frexp(context.astype(np.float64))[1])


def estimates(found: dict, n: int, v: int) -> np.ndarray:
    """Three columns: bigram, unigram and uniform estimates of each token."""
    two = found["pair"] / np.maximum(found["context"], 1)
    one = found["word"] / max(n, 1)
    return np.stack([two, one, np.full(len(two), 1.0 / (v + 1))], axis=1)


def learn_weights(held_out: DataFrame) -> np.ndarray:
    """EM over rows (buckets binary, estimates binary): the weights of each bucket."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ROUNDS):
        now = weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((BUCKETS, 3))
            for b in batches:
                for raw_b, raw_p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    at, p = np.frombuffer(raw_b, np.uint8), np.frombuffer(raw_p, np.float32).reshape(-1, 3)
                    share = p * now[at]
                    share /= share.sum(axis=1, keepdims=True)
                    for k in range(3):
                        total[:, k] += np.bincount(at, share[:, k], BUCKETS)
            yield pa.RecordBatch.from_pydict({"b": np.arange(BUCKETS), **{f"s{k}": total[:, k] for k in range(3)}})

        rows = held_out.mapInArrow(run, "b long, s0 double, s1 double, s2 double").groupBy("b").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(3)]).collect()
        got = np.zeros((BUCKETS, 3))
        for r in rows:
            got[r["b"]] = [r["s0"], r["s1"], r["s2"]]
        everything = got.sum(axis=0)
        prior = (everything + 1) / (everything.sum() + 3)  # for buckets with few tokens
        weights = (got + prior) / (got.sum(axis=1, keepdims=True) + 1)
        weights[:, 2] = np.maximum(weights[:, 2], 1e-9)  # no token is impossible
        weights /= weights.sum(axis=1, keepdims=True)
        if np.abs(weights - now).max() < 1e-4:
            break
    return weights


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, part, tables: Tables) -> DataFrame:
    """Scores of all texts of ``docs``; ``part`` is a column that says of each row whether it
    is counted (0), kept back for the weights (1) or never learned from (2)."""
    spark = docs.sparkSession
    made = tables.put(blocks(docs.withColumn("part", part)), "blocks")
    most = made.where("NOT kept_back").agg(F.sum("n_entries")).first()[0] or 0
    count = max(2 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-most // RANGE_ENTRIES))
    found = tables.put(sums(entries(made, count)), "sums")

    # tokens and distinct words (N and V) of each range, one row a range
    totals = [(unpack(r["fit"]), unpack(r["dev"])) for r in found.where(F.col("kind") == TOTALS).select("fit", "dev").collect()]
    n_fit, v_fit = (int(sum(f[k] for f, _ in totals)) for k in range(2))
    n_all, v_all = (int(sum(a[k] for _, a in totals)) for k in range(2))

    def joined(kept_back: bool, use, schema):
        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            rows = a.to_pylist()
            return use(rows[0], _looked_up(rows[0], b.to_pylist(), "fit" if kept_back else "all"))
        kinds = F.col("kind").isin([KEPT, KEPT + 1] if kept_back else [0, 1])
        own = made.where("kept_back AND size(parts) > 0" if kept_back else "NOT kept_back")
        return own.groupBy("block").cogroup(found.where(kinds).groupBy("block")).applyInArrow(run, schema)

    def held_out(row: dict, looked: dict) -> pa.Table:
        p = estimates(looked, n_fit, v_fit).astype(np.float32)
        return pa.table({"buckets": [bucket(looked["context"]).astype(np.uint8).tobytes()], "estimates": [p.tobytes()]})

    weights = learn_weights(tables.put(joined(True, held_out, "buckets binary, estimates binary"), "held_out"))

    def final(row: dict, looked: dict) -> pa.Table:
        counts, _, _, parts = _read(row)
        mixed = weights[bucket(looked["context"])]
        mixed *= estimates(looked, n_all, v_all)
        p, c = mixed.sum(axis=1), looked["word"]
        base = np.log10((c + 0.1) / (n_all + 0.1 * (v_all + 1)))
        first = np.cumsum(counts) - counts
        ids = pa.array(row["doc_ids"], pa.int64(), mask=np.array(row["nulls"], bool))
        return pa.table({"doc_id": ids, "held_out": pa.array(parts == 2), "n_tokens": counts, "n_known": np.add.reduceat((c > 0).astype(np.int64), first),
                         "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(np.log10(p), first)})

    return joined(False, final, RESULT).withColumn("train_tokens", F.lit(n_all).cast("long"))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = doc_crc()
    part = F.when(crc % 10 == 0, 2).when(F.floor(crc / 10) % KEPT_BACK == 0, 1).otherwise(0)
    out = score(docs, part, Tables(spark, "op1"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
