"""Document fingerprints by improved consistent weighted sampling.

A text's terms are its lower-case words, weighted by their number.  For term ``t`` and
sample ``k``, hashes of (t, k) give ``r`` and ``c`` from Gamma(2, 1) and ``b`` from the unit
interval; with weight ``w``, ``q = floor(ln(w) / r + b)`` and
``ln a = ln c - r (q - b + 1)``.  The term of least ``a`` with its ``q`` is sample ``k``.
Two texts have the same sample with a probability equal to their generalised Jaccard
similarity (sum of least over sum of greatest weights); the share of equal samples estimates
it with a standard error of at most ``0.5 / sqrt(SAMPLES)``.  A sample is written as four
hex digits, so unequal ones look alike once in 65,536 times.

Defined results: a text without words (or null) has the fingerprint of zeros, like any other
such text; repeated rows have equal fingerprints; an empty table gives an empty result; a
single document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.llm.common import table
from verbatim.llm.ordered import deal, ranges

SAMPLES = 64
BLOCK_CHARS = 4_000_000  # texts whose terms are hashed together


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _log_units(x: np.ndarray) -> np.ndarray:
    """-ln(u v) with u and v uniform, from the halves of each hash: Gamma(2, 1)."""
    unit = 1.0 / (1 << 32)
    return -np.log(((x >> np.uint64(32)).astype(np.float64) + 0.5) * unit * (((x & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * unit))


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """One row of 16-bit samples for each text."""
    out = np.zeros((len(texts), samples), np.uint16)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    full = pc.not_equal(words, "")
    owner, words = owner[full.to_numpy(zero_copy_only=False)], words.filter(full)
    if not len(words):
        return out
    coded = words.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], np.uint64)
    pairs = np.sort(owner * len(hashes) + coded.indices.to_numpy())
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    count = np.diff(np.concatenate([first, [len(pairs)]]))
    owner, term = np.divmod(pairs[first], len(hashes))
    # A term's value depends on its weight only: each (term, weight) once.
    weighted, of_pair = np.unique(term * (count.max() + 1) + count, return_inverse=True)
    w_term, weight = np.divmod(weighted, count.max() + 1)
    log_weight, several = np.log(weight), np.flatnonzero(weight > 1)
    segment = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    length = np.diff(np.concatenate([segment, [len(owner)]]))
    for k in range(samples):
        seed = hashes + np.uint64((k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
        x1 = _mixed(seed)
        x2 = _mixed(x1 + np.uint64(0x9E3779B97F4A7C15))
        x3 = _mixed(x2 + np.uint64(0x9E3779B97F4A7C15))
        r, log_c = _log_units(x1), np.log(_log_units(x2))
        b = ((x3 >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        # weight 1: ln(w) = 0, so q = floor(b) = 0
        q = np.zeros(len(w_term))
        at = w_term[several]
        q[several] = np.floor(log_weight[several] / r[at] + b[at])
        log_a = (log_c[w_term] - r[w_term] * (q - b[w_term] + 1))[of_pair]
        least = np.flatnonzero(log_a == np.repeat(np.minimum.reduceat(log_a, segment), length))
        who = owner[least]
        least = least[np.concatenate([[True], who[1:] != who[:-1]])]
        chosen = of_pair[least]
        key = _mixed(x3[w_term[chosen]] ^ _mixed(q[chosen].astype(np.int64).view(np.uint64)))
        out[owner[segment], k] = (key >> np.uint64(48)).astype(np.uint16)
    return out


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= BLOCK_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fingerprints(docs: DataFrame, keep: list[str], samples: int = SAMPLES) -> DataFrame:
    """The columns ``keep`` of each row and the fingerprint of its ``text``."""
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            made = [written(s) for i, j in _blocks(texts) for s in signatures(texts[i:j], samples)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(made, pa.string())], ["kept", "fingerprint"])

    schema = T.StructType([rows.schema["kept"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(run, schema).select("kept.*", "fingerprint")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all texts but the last, which only follows the one before it."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own = signatures(texts)
    other = signatures(changed)
    return pa.RecordBatch.from_arrays([
        pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([written(s) for s in own[:n]], pa.string()), pa.array([written(s) for s in other], pa.string()),
        pa.array(likeness(own[:n], other)), pa.array(likeness(own[:n], own[1:]))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, chars, at, over = [], [], 0, None, False
        for b in batches:
            for place, guest, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if place != at:
                    at, ids, texts, chars, over = place, [], [], 0, False
                if over:
                    continue  # another row with the guest's id
                ids.append(doc_id)
                texts.append(text or "")
                chars += len(texts[-1])
                over = bool(guest)
                if len(texts) > 1 and (over or chars >= BLOCK_CHARS):
                    yield _compare(ids, texts)
                    ids, texts, chars = ids[-1:], texts[-1:], len(texts[-1])

    dealt = deal(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ranges(docs), successor=True)
    return dealt.select("range", "guest", "doc_id", "text").mapInArrow(run, NEIGHBOURS)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(table(spark, sf_dir, "documents"))
