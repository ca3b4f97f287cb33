"""Token-id shards with a minimal perfect hash index.

Documents are written in ascending order of their id (then text) as raw little-endian ids,
16 bits wide if the vocabulary allows, else 32, each document's ids followed by an end id.
A shard file holds part of one range of ids.  Files have names of their own per attempt;
only those in the manifest, which Spark commits, belong to the data, so a lost executor or
a task run twice leaves at most files that nobody reads.

The index has one file for about ``PART_KEYS`` keys (document id, number among rows of that
id): a minimal perfect hash of bit levels with popcount ranks gives each key a slot of its
own; the slot holds a 32-bit fingerprint of the key (an absent key is refused, but for one
in 2^32), shard, offset and length.  A lookup is a few hashes and one read of the payload.

Defined results: a null text has only its end id; a null id comes first and is a key like
any other; rows of one id are told apart by their number; an empty table gives no shard and
an empty result.  Folders are on the shared file system that ``spark.checkpoint.dir`` names
(or the caller's path), reached by pyarrow's file systems.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.llm.bpe import public_vocabulary
from verbatim.llm.chunks import part_starts
from verbatim.llm.common import Tables, table
from verbatim.llm.ordered import deal, ranges

END_ID = 2
SHARD_IDS = 32_000_000
SHARD_DOCS = 1_000_000
PART_KEYS = 200_000
CACHED = 1_200_000
TOGETHER = 2_000
LONGEST_CACHED = 48
STRETCH = 4_000_000


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system and path that any executor can open."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class LibraryCoder:
    """The tokenizers library, asked once for each short part of a text.

    The texts of a stretch are cut and their parts numbered as arrays, so that only distinct
    parts are looked up one by one, and the ids are gathered by these numbers.

    New parts are given to the library many at a time: those that start with white space
    after another's last word are joined, as no token reaches across such a border, and the
    ids are told apart by the tokens' lengths in bytes."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "H" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        self.known: dict[bytes, bytes] = {}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(True)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a byte-level token has a letter for each byte
            self.lengths[i] = len(token.encode()) if token in special else len(token)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as raw bytes."""
        joined, starts, begins = part_starts(texts)
        if not len(starts):
            return [b""] * len(texts)
        offsets = np.append(starts, len(joined)).astype(np.int64)
        each = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        found = self._of_parts(each.dictionary.to_pylist())
        # the ids of the distinct parts, one after the other, then taken in the texts' order
        distinct = np.frombuffer(b"".join(found), f"<u{self.width}")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        which = each.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n)
        ids = distinct[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - n), n) + np.arange(ends[-1])].tobytes()
        at = (np.append(0, ends)[np.searchsorted(starts, begins)] * self.width).tolist()
        return [ids[x:y] for x, y in zip(at, at[1:])]

    def _of_parts(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct parts, known or new."""
        known = self.known
        if len(known) > CACHED:
            known.clear()
        new = [p for p in distinct if p not in known]
        long = {}
        for i in range(0, len(new), TOGETHER):
            some = new[i:i + TOGETHER]
            for p, ids in zip(some, self._ids([p.decode() for p in some])):
                (known if len(p) <= LONGEST_CACHED else long)[p] = ids
        return [known[p] if p in known else long[p] for p in distinct]

    def _ids(self, new: list[str]) -> list[bytes]:
        """The ids of each part as raw bytes."""
        free = [p[0] in " \n" and p[-1] not in " \n" and len(p) <= LONGEST_CACHED for p in new]
        joined = [p for p, f in zip(new, free) if f]
        kind = np.dtype(f"<u{self.width}")
        out = {}
        if joined:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(p.encode()) for p in joined])
            reached = np.cumsum(self.lengths[ids])
            at = np.searchsorted(reached, ends)
            if len(ids) and reached[-1] == ends[-1] and (reached[np.minimum(at, len(ids) - 1)] == ends).all():
                raw, at = ids.astype(kind).tobytes(), ((at + 1) * self.width).tolist()
                out = dict(zip(joined, (raw[a:b] for a, b in zip([0, *at], at))))
        rest = [p for p in new if p not in out]  # others, or all if a token crossed a border
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []):
            out[p] = array(self.kind, e.ids).tobytes()
        return [out[p] for p in new]


@lru_cache(2)
def coder(spec: str) -> LibraryCoder:
    return LibraryCoder(spec)


def _stretches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """From where to where as many texts go as are encoded together: some ``STRETCH`` characters."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STRETCH:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


MANIFEST = "at long, doc_id long, copy int, shard long, offset long, n long, file string"


def write_shards(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes the shards of ``docs(doc_id, text)``; the manifest, one row per document, says
    what was written and must be kept by the caller."""
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(spec.value)
        end = array(own.kind, [end_id]).tobytes()
        files, path = file_system(folder)
        files.create_dir(path, recursive=True)
        out = name = at_range = None
        number = written = docs_in = 0
        last, copy = None, 0
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(4)]
            texts = [t or "" for t in columns.pop()]
            for i, j in _stretches(texts):
                rows = []
                encoded = own.encode(texts[i:j])
                for place, at, doc_id, raw in zip(*(c[i:j] for c in columns), encoded):
                    if place != at_range or written >= SHARD_IDS or docs_in >= SHARD_DOCS:
                        if out:
                            out.close()
                        number = number + 1 if place == at_range else 0
                        at_range, written, docs_in = place, 0, 0
                        name = f"ids-{place:07d}-{number:05d}-{uuid.uuid4().hex}.bin"
                        out = files.open_output_stream(f"{path}/{name}")
                    last, copy = at, copy + 1 if at == last else 0
                    raw += end
                    n = len(raw) // own.width
                    out.write(raw)
                    rows.append((at, doc_id, copy, (place << 20) + number, written, n, name))
                    written, docs_in = written + n, docs_in + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                                 ["at", "doc_id", "copy", "shard", "offset", "n", "file"])
        if out:
            out.close()

    dealt = deal(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ranges(docs))
    return dealt.select("range", "at", "doc_id", "text").mapInArrow(run, MANIFEST)


def catalog(manifest: DataFrame) -> DataFrame:
    """(shard, file, base): one row per shard; base is the number of ids in all before it."""
    shards = manifest.groupBy("shard", "file").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).drop("ids")


# ------------------------------------------------------------- minimal perfect hash
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(at: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """Distinct for distinct (id, number) up to chance in 2^64; the index refuses to be
    built on a collision."""
    return _mixed(_mixed(at.astype(np.int64).view(np.uint64)) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (_mixed(keys + np.uint64((level + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1)) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """Keys to 0..n-1 without gaps: on each level a key that is alone on its bit stays there,
    the others go on to the next; a key's slot is the rank of its bit."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two keys of the index have the same hash")
        sizes, words = [], []
        while len(keys):
            bits = -(-2 * len(keys) // 64) * 64
            place = _place(keys, len(sizes), bits)
            alone = np.bincount(place, minlength=bits) == 1
            sizes.append(bits)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[place]]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if no level has it."""
        out, open_, first = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, bits in enumerate(self.sizes.tolist()):
            place = first + _place(keys[open_], level, bits)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            there = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[there]] = (self.ranks[word] + below)[there]
            open_, first = open_[~there], first + bits
        return out


ENTRY = np.dtype([("print", "<u4"), ("shard", "<i8"), ("offset", "<i8"), ("n", "<i8")])


def _print_of(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def pack_index(at, copy, shard, offset, n) -> bytes:
    keys = key_hash(at, copy)
    table = PerfectHash.build(keys)
    entries = np.zeros(len(keys), ENTRY)
    entries[table.slots(keys)] = np.array(list(zip(_print_of(keys), shard, offset, n)), ENTRY)
    head = np.array([len(table.sizes), len(table.words), len(keys)], "<i8")
    return b"".join(x.tobytes() for x in (head, table.sizes.astype("<i8"), table.words.astype("<u8"), entries))


class Index:
    """One index file's contents."""

    def __init__(self, raw: bytes):
        levels, words, keys = np.frombuffer(raw, "<i8", 3).tolist()
        at = 24 + 8 * levels
        self.table = PerfectHash(np.frombuffer(raw, "<i8", levels, 24), np.frombuffer(raw, "<u8", words, at))
        self.entries = np.frombuffer(raw, ENTRY, keys, at + 8 * words)

    def find(self, at: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its entry (any, if not)."""
        keys = key_hash(at, copy)
        if not len(self.entries):
            return np.zeros(len(keys), bool), np.zeros(len(keys), ENTRY)
        slot = self.table.slots(keys)
        entry = self.entries[np.maximum(slot, 0)]
        return (slot >= 0) & (entry["print"] == _print_of(keys)), entry


def _part(count: int):
    return F.pmod(F.xxhash64("at", "copy"), F.lit(count)).cast("int")


def write_index(manifest: DataFrame, folder: str, count: int) -> DataFrame:
    """(part, index_file): writes the index, one file per part of the keys."""
    def build(rows: pa.Table) -> pa.Table:
        files, path = file_system(folder)
        files.create_dir(path, recursive=True)
        part = rows["part"][0].as_py()
        name = f"index-{part:07d}-{uuid.uuid4().hex}.mph"
        with files.open_output_stream(f"{path}/{name}") as out:
            out.write(pack_index(*(rows[c].to_numpy() for c in ("at", "copy", "shard", "offset", "n"))))
        return pa.table({"part": pa.array([part], pa.int32()), "index_file": [name]})

    rows = manifest.select("at", "copy", "shard", "offset", "n", _part(count).alias("part"))
    return rows.groupBy("part").applyInArrow(build, "part int, index_file string")


def lookup(keys: DataFrame, index: DataFrame, folder: str, count: int) -> DataFrame:
    """Finds rows (at, copy) in the index; absent keys are left out."""
    def find(rows: pa.Table) -> pa.Table:
        files, path = file_system(folder)
        with files.open_input_file(f"{path}/{rows['index_file'][0].as_py()}") as f:
            there, entry = Index(f.read()).find(rows["at"].to_numpy(), rows["copy"].to_numpy())
        some = rows.select(["at", "copy"]).filter(pa.array(there))
        for c in ("shard", "offset", "n"):
            some = some.append_column(c, pa.array(entry[c][there]))
        return some

    rows = keys.select("at", "copy", _part(count).alias("part")).join(index, "part")
    return rows.groupBy("part").applyInArrow(find, "at long, copy int, shard long, offset long, n long")


def read_documents(found: DataFrame, shards: DataFrame, folder: str, width: int) -> DataFrame:
    """(at, copy, start, n, ids_crc32): reads the documents' ids, a shard at a time."""
    kind = "<u2" if width == 2 else "<u4"

    def read(rows: pa.Table) -> pa.Table:
        files, path = file_system(folder)
        rows = rows.sort_by("offset")
        crc = []
        with files.open_input_file(f"{path}/{rows['file'][0].as_py()}") as f:
            for offset, n in zip(rows["offset"].to_pylist(), rows["n"].to_pylist()):
                ids = np.frombuffer(f.read_at(n * width, offset * width), kind)
                if len(ids) != n:
                    raise ValueError("a shard file is shorter than its index says")
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        start = pa.array(rows["base"].to_numpy() + rows["offset"].to_numpy())
        return pa.table({"at": rows["at"], "copy": rows["copy"], "start": start, "n": rows["n"], "ids_crc32": pa.array(crc, pa.int64())})

    return (found.join(shards, "shard").groupBy("shard")
            .applyInArrow(read, "at long, copy int, start long, n long, ids_crc32 long"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, vocabulary = Tables(spark, "op6"), public_vocabulary()
    folder = tables.path("shards")
    manifest = tables.put(write_shards(table(spark, sf_dir, "documents"), vocabulary, folder), "manifest")
    shards = tables.put(catalog(manifest), "catalog")
    count = max(1, -(-manifest.count() // PART_KEYS))
    index = tables.put(write_index(manifest, folder, count), "index")
    # every document is found again through the index and read from its shard
    keys = manifest.select("at", "copy")
    read = read_documents(lookup(keys, index, folder, count), shards, folder, coder(vocabulary).width)
    ids = F.when(F.col("at") != F.lit(-(1 << 63)), F.col("at"))
    return read.select(ids.alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32")
