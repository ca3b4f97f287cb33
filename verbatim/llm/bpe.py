"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece has exactly one last token in its BPE encoding.  An Aho-Corasick
automaton over the vocabulary yields, for each end position, the tokens that are a suffix of
the prefix.  Such a token is the prefix's last one if it is the whole prefix, or if it is
compatible with the last token of what stands before it: undoing the merges of both, from
the latest to the earliest, no merge across their border would have come first.  The last
tokens are stored for each prefix; following them back from the end gives the exact ids.

The vocabulary file is a parameter: its text is read once and sent to the tasks (its size
doesn't depend on the data).  Words repeat, so each worker keeps the ids of a bounded number
of short parts of texts; the whole of every text is encoded.

Defined results: a null text is empty and has no ids; a special token's text gives its id;
repeated rows get equal ids; ids that are no tokens are left out by ``decode``, bytes that
are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.llm.chunks import parts
from verbatim.llm.common import table

CACHED = 500_000  # stretches of text with their ids, some 100 MB a worker
COMPATIBLE = 1_000_000  # pairs of tokens, some 130 MB a worker
#: The same where other stages share the executor's memory: some 25 and 20 MB a worker.
CACHED_IN_STAGE, COMPATIBLE_IN_STAGE = 120_000, 200_000
LONGEST_CACHED = 48
#: Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = -1


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Encoder and decoder of one byte-level BPE vocabulary (a tokenizers JSON text)."""

    def __init__(self, spec: str, cached: int = CACHED, compatible: int = COMPATIBLE):
        self.most_known, self.most_fits = cached, compatible
        spec = json.loads(spec)
        model, letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        as_bytes = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes_of = as_bytes | {i: t.encode() for t, i in self.special.items()}
        size = max(self.bytes_of) + 1
        # How a token came about: the rank of its merge and the two tokens merged.
        self.rank, self.left, self.right, self.merged = [NO_RANK] * size, [0] * size, [0] * size, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made, a, b = vocab[a + b], vocab[a], vocab[b]
            self.merged[a, b] = rank
            if self.rank[made] == NO_RANK:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        # Tokens that no merge makes are never an encoding; single bytes always are.
        self.automaton = ahocorasick.Automaton()
        for i, raw in as_bytes.items():
            if len(raw) == 1 or self.rank[i] != NO_RANK:
                self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        self.pattern = regex.compile(PATTERN)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ids = list(range(size))  # shared integers for the cached tuples
        self.fits, self.known = {}, {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the BPE encoding of a's and b's bytes together is just (a, b)."""
        key = a << 32 | b
        found = self.fits.get(key)
        if found is not None:
            return found
        rank, merged = self.rank, self.merged
        before = len(merged)  # merges from this rank on come too late
        while True:
            across = merged.get((a, b))
            if across is not None and across < before:
                found = False
                break
            ra, rb = rank[a], rank[b]
            if ra == NO_RANK and rb == NO_RANK:
                found = True
                break
            if ra > rb:  # a's own merge came last; one of equal rank across would be later
                before, a = ra, self.right[a]
            else:  # of equal ranks the one further left comes first
                before, b = rb + 1, self.left[b]
        if len(self.fits) >= self.most_fits:
            self.fits.clear()
        self.fits[key] = found
        return found

    def piece(self, raw: str) -> list[int]:
        """Ids of one piece, given as one latin-1 character for each byte."""
        last = [0] * len(raw)  # the last token of the prefix that ends here
        width = [0] * len(raw)
        done = -1
        for end, (n, token) in self.automaton.iter(raw):
            if end == done:
                continue
            start = end - n
            if start < -1:
                continue
            if start == -1 or (width[start] and self.compatible(last[start], token)):
                last[end], width[end], done = token, n, end
        out, at = [], len(raw) - 1
        while at >= 0:
            out.append(last[at])
            at -= width[at]
        return out[::-1]

    def _encode_part(self, text: str) -> tuple[int, ...]:
        out = []
        for piece in self.pattern.findall(text):
            out += self.piece(piece.encode("utf-8").decode("latin-1"))
        return tuple([self.ids[i] for i in out])

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        out = []
        known = self.known
        for stretch in self.cut.split(text) if self.cut and self.cut.search(text) else (text,):
            if stretch in self.special:
                out.append(self.special[stretch])
                continue
            for part in parts(stretch):
                ids = known.get(part)
                if ids is None:
                    ids = self._encode_part(part)
                    if len(part) <= LONGEST_CACHED:
                        if len(known) >= self.most_known:
                            known.clear()
                        known[part] = ids
                out += ids
        return out

    def forget(self) -> None:
        """Give back the memory of what was found so far, to the system too: Python's lists of
        free tuples and Arrow's pool would hold on to most of it."""
        self.fits.clear()
        self.known.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()

    def decode(self, ids) -> str:
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(2)
def bpe(spec: str, cached: int = CACHED, compatible: int = COMPATIBLE) -> Bpe:
    """One encoder for each worker and vocabulary."""
    return Bpe(spec, cached, compatible)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return read_vocabulary(public_tokenizers.path(name))


def encode(docs: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row and the ids of its ``text``; a column ``ids`` of the
    documents gives way."""
    keep = [c for c in keep if c != "ids"]
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(spec.value, CACHED_IN_STAGE, COMPATIBLE_IN_STAGE)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = [coder.encode(t or "") for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(ids, pa.list_(pa.int32()))], ["kept", "ids"])
        coder.forget()  # the worker goes on to tasks of other stages

    schema = T.StructType([rows.schema["kept"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).select("kept.*", "ids")


def digests(docs: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_tokens, ids_sha256 and, of the text decoded from the ids,
    decoded_sha256; ids don't leave the task."""
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(spec.value)
        written = [str(i) for i in coder.ids]
        for b in batches:
            counts, of_ids, of_text = [], [], []
            for value in b.column(0):
                ids = coder.encode(value.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join([written[i] for i in ids]).encode()).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                                             ["kept", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([rows.schema["kept"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return rows.mapInArrow(run, schema).select("kept.*", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_vocabulary(), ["doc_id"])
