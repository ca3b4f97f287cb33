"""Substring dedup by recompression: words in a passage that occurs earlier go.

A window is ``WINDOW`` consecutive words of one document.  A word is removed if it lies in a
window whose words also start earlier: in a document before it in order of (doc_id, text
hash), or earlier in the same document.

* Rounds.  A round names each maximal run of a symbol, then each pair of an adjacent left and
  right symbol; a symbol's side is a bit of its name's hash.  Names are 128-bit hashes of
  what they stand for, so all documents get the same ones without a dictionary having to be
  shuffled: equal passages have equal symbols but for some at their ends, whatever is around them.
* High-level symbols.  A unit is a symbol of the last round with the symbols behind it that its
  windows reach into.  Of equal units all but the first are repeats: their windows start
  earlier.  One aggregation, partial before the shuffle, finds the first of each, so
  copies, however many, cost a row a unit and never meet.
* Low-level symbols.  Among the first units, windows that are equal share the symbols that
  are determined by words inside the window: each symbol carries the span of words that its
  rounds looked at.  A window's anchor is, of the highest of some rounds that has any such
  symbol, the least by hash, leftmost, and is known by the words of its span.  It depends on the
  window's words alone, so equal windows have equal anchors.
* Neighbouring windows share an anchor and form a mark, known by its anchor and all its words;
  a unit has the windows of the marks that begin in its first symbol.
  Of equal marks, in global order of (anchor, words, document, start), all but the first are
  repeats.  If an anchor has one such text only, nothing else can hold its windows; if it has
  several, as at the ends of a passage, their windows are compared one by one, by a 128-bit hash,
  in global order of (hash, document, start) (``runs.in_order``).

Texts are shuffled twice, to the starts sought in them and to their decisions.  The
shuffle files of each step go when its table is written.

Defined results: a null text has no words; a document of fewer words than a window keeps all;
a null doc_id is before all others (as the least long); of rows equal in id and text one is the
first and the others are repeats of it; an empty table gives an empty result.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, mixed, table
from verbatim.llm.ordered import order_key
from verbatim.llm.runs import BASES, Wanted, in_order, partitions, powers

WINDOW = 20
ROUNDS = 12  # about 30 words a symbol
ANCHOR_ROUNDS = 1
LONG = 64
BLOCK_CHARS = 4_000_000  # texts whose words are named together
EXPAND = 100_000  # copies of one row that are made in one step
M64 = (1 << 64) - 1


def _name(lane: int, step: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    salt = np.uint64((step * 0x9E3779B97F4A7C15 + (lane + 1) * 0xC2B2AE3D27D4EB4F) & M64)
    return mixed(mixed(a + salt) + b)


class Level:
    """Symbols of a round in order: start and end word, both name lanes, document, and the span
    [low, high) of words that determine the symbol in any surroundings; a span that reaches
    out of its document lies in no window."""

    def __init__(self, start, end, names, doc, low, high):
        self.start, self.end, self.names, self.doc, self.low, self.high = start, end, names, doc, low, high

    def next(self, step: int, first_word: np.ndarray, end_word: np.ndarray, spans: bool = True) -> Level:
        """The next round; the documents' first words and the words after their last.  Without
        ``spans`` the symbols' spans are left as they are of their first parts."""
        n, (a, b) = len(self.start), self.names
        if not n:
            return self
        equal = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (self.doc[1:] == self.doc[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~equal]))
        last = np.append(first[1:], n) - 1
        long, count = last > first, (last - first + 1).astype(np.uint64)
        names = []
        for lane, x in enumerate((a, b)):
            x = x[first]
            x[long] = _name(lane, 2 * step, x[long], count[long])
            names.append(x)
        doc, start, end = self.doc[first], self.start[first], self.end[last]
        same = np.zeros(len(first) + 1, bool)  # is there a symbol before this one in its document?
        same[1:-1] = doc[1:] == doc[:-1]
        inner_l, inner_r = same[:-1], same[1:]
        # pairs of a left and a right symbol
        left = _name(0, 2 * step + 1, names[0], names[1]) >> np.uint64(63) == 1
        head = np.zeros(len(first) + 1, bool)
        head[:-2] = left[:-1] & ~left[1:] & inner_r[:-1]
        second, head = np.concatenate([[False], head[:-2]]), head[:-1]
        at, keep = np.flatnonzero(head), ~second
        end[at] = end[at + 1]
        for lane in (0, 1):
            names[lane][at] = _name(lane, 2 * step + 1, names[lane][at], names[lane][at + 1])
        low, high = self.low[first], self.high[last]
        if spans:
            # a run is known by the symbols on both sides, a symbol that finds no partner by the one there
            low = np.where(inner_l, self.low[np.maximum(first - 1, 0)], first_word[doc] - 1)
            high = np.where(inner_r, self.high[np.minimum(last + 1, n - 1)], end_word[doc] + 1)
            alone_l, alone_r = np.flatnonzero(left & ~head), np.flatnonzero(~left & ~second)
            new_low, new_high = low.copy(), high.copy()
            new_high[alone_l] = np.where(inner_r[alone_l], high[np.minimum(alone_l + 1, len(first) - 1)], end_word[doc[alone_l]] + 1)
            new_low[alone_r] = np.where(inner_l[alone_r], low[np.maximum(alone_r - 1, 0)], first_word[doc[alone_r]] - 1)
            new_high[at] = high[at + 1]
            low, high = new_low, new_high
        return Level(start[keep], end[keep], [x[keep] for x in names], doc[keep], low[keep], high[keep])


def named_words(texts: list) -> tuple[list[np.ndarray], np.ndarray, pa.Array]:
    """Both name lanes of all words, each text's number of words, and the words.

    A word of at most ``LONG`` bytes is named by polynomials of its bytes, all words at once; of longer
    ones, where such polynomials have known collisions, by its own 128-bit hash."""
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    words = lists.flatten()
    full = pc.not_equal(words, "").fill_null(False)
    bounds = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    words = words.filter(full)
    if not len(words):
        return [np.zeros(0, np.uint64)] * 2, np.diff(bounds), words
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    text = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    size, lanes = np.diff(ends), []
    for base in BASES:
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text + np.uint64(1)) * powers(base, len(text)), out=sums[1:])
        value = (sums[ends[1:]] - sums[ends[:-1]]) * powers(pow(base, -1, 1 << 64), len(text))[ends[:-1]]
        lanes.append(mixed(value + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    for i in np.flatnonzero(size > LONG):
        digest = xxhash.xxh3_128_digest(text[ends[i]:ends[i + 1]].tobytes())
        lanes[0][i], lanes[1][i] = np.frombuffer(digest, "<u8")
    return lanes, np.diff(bounds), words


def levels(names: list[np.ndarray], counts: np.ndarray, rounds: int = ROUNDS, spans: int = ANCHOR_ROUNDS) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Words and the symbols of each round, with the documents' first words and their ends;
    spans are kept for the first rounds only."""
    ends = np.cumsum(counts)
    at = np.arange(len(names[0]))
    out = [Level(at, at + 1, names, np.repeat(np.arange(len(counts)), counts), at, at + 1)]
    for step in range(rounds):
        out.append(out[-1].next(step, ends - counts, ends, step < spans))
    return out, ends - counts, ends


def rolled(names: list[np.ndarray], first: np.ndarray, last: np.ndarray, lanes: tuple = (0, 1)) -> list[np.ndarray]:
    """Hashes of the names in each [first, last), one for each lane."""
    out = []
    for lane in lanes:
        base, x = BASES[lane], names[lane]
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * powers(base, len(x)), out=sums[1:])
        out.append(mixed((sums[last] - sums[first]) * powers(pow(base, -1, 1 << 64), len(x) + 1)[first]))
    return out


def _least(rank: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the least rank in each [first, last], leftmost."""
    width = int((last - first).max()) + 1 if len(first) else 1
    best, span, at = [np.arange(len(rank))], 1, np.zeros(len(first), np.int64)
    size = np.maximum(last - first + 1, 1)
    while span <= width:
        mine = (size >= span) & (size < 2 * span)
        a, b = best[0][first[mine]], best[0][last[mine] - span + 1]
        at[mine] = np.where(rank[b] < rank[a], b, a)
        a, b = best[0][:-span], best[0][span:]
        best[0] = np.where(rank[b] < rank[a], b, a) if len(b) else best[0]
        span *= 2
    return at


def anchors(found: list[Level], windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window (its first word) the hash of its anchor, and a number for its occurrence."""
    name, place = np.zeros(len(windows), np.uint64), np.zeros(len(windows), np.int64)
    open_ = np.arange(len(windows))
    for r in range(len(found) - 1, -1, -1):
        lv, s = found[r], windows[open_]
        first = np.searchsorted(lv.low, s, "left")
        last = np.searchsorted(lv.high, s + width, "right") - 1
        has = first <= last
        at = _least(mixed(lv.names[0]), first[has], last[has])
        used = np.unique(at)
        spans = np.zeros(len(lv.start), np.uint64)
        spans[used] = _name(0, r, rolled(found[0].names, lv.low[used], lv.high[used], (0,))[0], (lv.high - lv.low)[used].astype(np.uint64))
        name[open_[has]] = spans[at]
        place[open_[has]] = at * len(found) + r
        open_ = open_[~has]
    return name, place


UNITS = "k1 long, k2 long, at long, th long, start int, size int, marks binary"
#: An anchor, how many windows in a row have it, and the hash of all their words.
MARK = np.dtype([("name", "<i8"), ("words", "<i8"), ("size", "u1")])


def _units(ids: list[np.ndarray], texts: list, width: int, rounds: int, anchor_rounds: int) -> pa.RecordBatch:
    with np.errstate(over="ignore"):
        names, counts, _ = named_words(texts)
        found, begins, ends = levels(names, counts, rounds, anchor_rounds)
        each = np.maximum(counts - width + 1, 0)
        doc = np.repeat(np.arange(len(counts)), each)
        windows = np.repeat(begins - (np.cumsum(each) - each), each) + np.arange(each.sum())
        name, place = anchors(found[:anchor_rounds + 1], windows, width)
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])) if len(windows) else np.zeros(0, np.int64)
        many = np.diff(np.append(new, len(windows)))
        # a unit has the windows of the marks that begin in its first symbol
        top, begin = found[-1], windows[new]
        unit = np.searchsorted(top.start, begin, "right") - 1
        use, lead = np.unique(unit, return_index=True)
        size = np.add.reduceat(many, lead) if len(use) else np.zeros(0, np.int64)
        start = begin[lead]
        far = np.searchsorted(top.end, start + size + width - 1, "left")
        shape = _name(0, 7, (start - top.start[use]).astype(np.uint64), size.astype(np.uint64))
        key = [_name(lane, 8, k, shape) for lane, k in enumerate(rolled(top.names, use, far + 1))]
        pieces = -(-many // 255)  # a mark counts up to 255 windows
        marks = np.zeros(int(pieces.sum()), MARK)
        marks["name"], marks["size"] = np.repeat(name[new].view(np.int64), pieces), 255
        marks["size"][np.cumsum(pieces) - 1] = many - 255 * (pieces - 1)
        count = marks["size"].astype(np.int64)
        begin = windows[np.cumsum(count) - count]
        marks["words"] = rolled(names, begin, begin + count + width - 1, (1,))[0].view(np.int64)
    held = np.add.reduceat(pieces, lead) if len(use) else pieces
    cut = np.concatenate([[0], np.cumsum(held)])
    blobs = pa.Array.from_buffers(pa.binary(), len(use), [None, pa.py_buffer((cut * MARK.itemsize).astype(np.int32)), pa.py_buffer(marks.tobytes())])
    doc = top.doc[use]
    return pa.RecordBatch.from_arrays([
        *[pa.array(k.view(np.int64)) for k in key], *[pa.array(i[doc]) for i in ids], pa.array((start - begins[doc]).astype(np.int32)),
        pa.array(size.astype(np.int32)), blobs], [f.split()[0] for f in UNITS.split(", ")])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, words, at, th, s, size) of the marks of units (at, th, start, marks)."""
    for b in batches:
        at, th, start = (b.column(i).to_numpy() for i in range(3))
        blobs = b.column(3).to_pylist()
        marks, each = np.frombuffer(b"".join(blobs), MARK), np.array([len(x) // MARK.itemsize for x in blobs], np.int64)
        size = marks["size"].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(size)])
        first = np.cumsum(each) - each
        s = before[:-1] - np.repeat(before[first], each) + np.repeat(start, each)
        yield pa.RecordBatch.from_arrays([pa.array(marks["name"].copy()), pa.array(marks["words"].copy()), pa.array(np.repeat(at, each)), pa.array(np.repeat(th, each)),
                                          pa.array(s.astype(np.int32)), pa.array(size.astype(np.int32))], ["name", "words", "at", "th", "s", "size"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted marks those that are repeats (``open`` false), and the first of each text of an
    anchor that has several (``open`` true).

    What lies at an edge of a batch may go on beyond it, so its anchor counts as having several."""
    before = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        name, words = b.column(0).to_numpy(), b.column(1).to_numpy()
        other = np.concatenate([[True], name[1:] != name[:-1]])
        new = other | np.concatenate([[True], words[1:] != words[:-1]])
        new[0] = before != (name[0], words[0])
        before = (name[-1], words[-1])
        runs = np.cumsum(other) - 1
        texts = np.bincount(runs, new)
        several = texts > 1
        several[[0, -1]] = True
        keep = ~new | several[runs]
        yield pa.RecordBatch.from_arrays([*[b.column(i).filter(pa.array(keep)) for i in range(2, 6)], pa.array(new[keep])], ["at", "th", "s", "size", "open"])


def compared_marks(firsts: DataFrame) -> DataFrame:
    """(at, th, s, size, open) of the marks of units that are repeats, or whose windows have to be compared."""
    marks = firsts.select("at", "th", "start", "marks").mapInArrow(_marks, "name long, words long, at long, th long, s int, size int")
    # a hot anchor lies in several ranges, as a range ends at any place
    order = ["name", "words", "at", "th", "s"]
    dealt = marks.repartitionByRange(partitions(firsts), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_compared, "at long, th long, s int, size int, open boolean")


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Rows whose texts are worked on together."""
    first, chars = 0, 0
    for i, size in enumerate(sizes):
        if chars and chars + size > BLOCK_CHARS:
            yield first, i
            first, chars = i, 0
        chars += size
    if first < len(sizes):
        yield first, len(sizes)


def units(docs: DataFrame, width: int = WINDOW, rounds: int = ROUNDS, anchor_rounds: int = ANCHOR_ROUNDS) -> DataFrame:
    """The units of all documents (at, th, text) that windows start in, with their windows' anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = [b.column(i).to_numpy() for i in (0, 1)], b.column(2).to_pylist()
            for first, last in _blocks([len(t or "") for t in texts]):
                yield _units([i[first:last] for i in ids], texts[first:last], width, rounds, anchor_rounds)
    return docs.select("at", "th", "text").mapInArrow(run, UNITS)


def _windows(width: int):
    """(w1, w2, at, th, s) of the windows sought in each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = [b.column(i).to_numpy() for i in (0, 1)], b.column(2).to_pylist()
            starts, sizes = b.column(3).to_pylist(), b.column(4).to_pylist()
            for first, last in _blocks([len(t or "") for t in texts]):
                with np.errstate(over="ignore"):
                    names, counts, _ = named_words(texts[first:last])
                    begins = np.cumsum(counts) - counts
                    each = np.array([len(x) for x in starts[first:last]])
                    s0 = np.concatenate([np.asarray(x, np.int64) for x in starts[first:last]])
                    size = np.concatenate([np.asarray(x, np.int64) for x in sizes[first:last]])
                    doc = np.repeat(np.repeat(np.arange(last - first), each), size)
                    s = np.repeat(s0 - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    at = s + begins[doc]
                    key = rolled(names, at, at + width)
                yield pa.RecordBatch.from_arrays([*[pa.array(k.view(np.int64)) for k in key], *[pa.array(i[first:last][doc]) for i in ids], pa.array(s.astype(np.int32))],
                                                 ["w1", "w2", "at", "th", "s"])
    return run


def _flags(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    return np.cumsum(change[:n]) > 0


def _cut_block(b: pa.RecordBatch, width: int) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(pc.fill_null(b.column(2).cast(pa.large_string()), ""))
    words = lists.flatten()
    full = pc.not_equal(words, "")
    bounds = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    words, begins, counts, n = words.filter(full), bounds[:-1], np.diff(bounds), int(bounds[-1])
    named = np.repeat(begins, pc.fill_null(pc.list_value_length(b.column(3)), 0).to_numpy(zero_copy_only=False))
    start, size = named + b.column(3).flatten().to_numpy(), b.column(4).flatten().to_numpy()
    # windows go unless they are named to stay, and after all if they are named to go
    windows = _flags(n, begins, np.maximum(counts - width + 1, 0))
    stay, gone = size > 0, size < 0
    repeat = windows & (~_flags(n, start[stay], size[stay]) | _flags(n, start[gone], -size[gone]))
    at = np.flatnonzero(repeat)
    cut = _flags(n, at, np.full(len(at), width))
    total = np.concatenate([[0], np.cumsum(cut)])
    n_removed = total[bounds[1:]] - total[bounds[:-1]]
    # spans of removed words, cut at the ends of documents
    inside = np.zeros(n, bool)
    inside[begins[counts > 0]] = True
    first = np.flatnonzero(cut & (inside | ~np.concatenate([[False], cut[:-1]]))) if n else at
    ends = np.append(inside[1:], True) if n else inside
    last = np.flatnonzero(cut & (ends | ~np.append(cut[1:], False))) if n else at
    doc = np.searchsorted(bounds, first, "right") - 1
    spans: dict[int, list[str]] = {}
    for d, x, y in zip(doc.tolist(), (first - begins[doc]).tolist(), (last + 1 - begins[doc]).tolist()):
        spans.setdefault(d, []).append(f"{x}:{y}")
    kept = pa.LargeListArray.from_arrays(pa.array(bounds - total[bounds]), words.filter(pa.array(~cut)))
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts.astype(np.int64)), pa.array(n_removed.astype(np.int64)),
                                       pa.array([",".join(spans.get(d, ())) for d in range(b.num_rows)], pa.string()), pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())],
                                      ["at", "th", "n_words", "n_removed", "spans", "kept"])


def _cut(width: int):
    """n_words, n_removed, spans and kept of each text; starts and sizes are of windows that stay
    (sizes above 0) or go after all (below 0) among those that go unless named."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_pylist()
            for first, last in _blocks(sizes):
                yield _cut_block(b.slice(first, last - first), width)
    return run


def drop_repeats(docs: DataFrame, tables: Tables, width: int = WINDOW, rounds: int = ROUNDS, anchor_rounds: int = ANCHOR_ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, ``first:end`` from 0, comma-joined) and
    kept (the other words, joined by spaces) of each row."""
    kind = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", order_key().alias("at"), F.xxhash64("text").alias("th"), "text")
    first = F.min(F.struct("at", "th", "start", "size", "marks")).alias("u")
    firsts = tables.put(units(docs, width, rounds, anchor_rounds).groupBy("k1", "k2").agg(first).select("u.*"), "firsts")

    marks = tables.put(compared_marks(firsts), "marks")
    sought = marks.where("open").groupBy("at", "th").agg(F.collect_list("s").alias("starts"), F.collect_list("size").alias("sizes"))
    rows = docs.select("at", "th", "text").join(sought, ["at", "th"]).select("at", "th", "text", "starts", "sizes")
    rows = tables.put(rows.mapInArrow(_windows(width), "w1 long, w2 long, at long, th long, s int"), "windows")
    copies = docs.groupBy("doc_id", "at", "th").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    copies = tables.put(copies, "copies")
    many = not copies.isEmpty()
    if many:  # rows equal in id and text gave their windows several times
        on = copies.select("at", "th").distinct()
        rows = tables.put(rows.join(on, ["at", "th"], "left_anti").unionByName(rows.join(on, ["at", "th"], "left_semi").distinct()), "single")
    order = [F.col("at"), F.col("th"), F.col("s")]
    later = in_order(rows, ["w1", "w2"], order, Wanted(keep=("at", "th", "s")), tables, "ordered")
    tables.drop("windows")
    gone = later.where("nth > 1").select("at", "th", "s", F.lit(-1).alias("size"))
    gone = gone.unionByName(marks.where("NOT open").select("at", "th", "s", (-F.col("size")).alias("size")))

    known = firsts.select("at", "th", F.col("start").alias("s"), "size").unionByName(gone)
    known = known.groupBy("at", "th").agg(F.collect_list("s").alias("starts"), F.collect_list("size").alias("sizes"))
    rows = docs.select("at", "th", "text").join(known, ["at", "th"], "left").select("at", "th", "text", "starts", "sizes")
    out = rows.mapInArrow(_cut(width), "at long, th long, n_words long, n_removed long, spans string, kept string")
    own = F.when(F.col("at") != F.lit(-(1 << 63)), F.col("at")).cast(kind).alias("doc_id")
    found = ["n_words", "n_removed", "spans", "kept"]
    if not many:
        return out.select(own, *found)
    out = tables.put(out, "cut")
    on = copies.groupBy("at", "th").agg(F.sum("n_rows").alias("n_rows"))
    single = out.join(on, ["at", "th"], "left_anti").select(own, *found)
    more = out.join(on, ["at", "th"]).dropDuplicates(["at", "th"])
    # the first row as found; the others, if they are long enough to be repeats, without words
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1, F.lit(EXPAND).cast("long"))).alias("block")
    more = more.select("*", block).select("*", F.explode(F.sequence(F.col("block"), F.least(F.col("block") + EXPAND, F.col("n_rows")) - 1)).alias("copy"))
    gone = (F.col("copy") > 0) & (F.col("n_words") >= width)
    more = more.select(own, "n_words", F.when(gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
                       F.when(gone, F.concat(F.lit("0:"), "n_words")).otherwise(F.col("spans")).alias("spans"), F.when(gone, "").otherwise(F.col("kept")).alias("kept"))
    return single.unionByName(more)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeats(docs, Tables(spark, "op11", tidy=True))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


#: All windows by their words (doc_id unique).
ORACLE = r"""
WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM docs WHERE len(ws) >= 20),
windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS w FROM starts),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, s) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
words AS (SELECT d.doc_id, d.ws, coalesce(l.gone, []) AS gone FROM docs d LEFT JOIN lists l ON d.doc_id = l.doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_filter(ws, lambda w, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM words
"""
