"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its lower-case words.  A line is removed if an earlier line, in order of
(doc_id, text hash, line number), has a Jaccard similarity of at least ``SIMILARITY`` to it;
lines without words stay.  Lines equal but for case are one text, named by two 64-bit hashes
(words by one; equal hashes of different texts are left to chance in 2^64).

* Words are ordered by rarity: their frequency among all lines, counted in
  ``1 << RARITY_BITS`` hash bins (a table of fixed size), then their hash.
* Prefix filter: similar sets share a word among the first ``n - ceil(t n) + 1`` of each.
* Length filter: the shorter set has at least ``t`` times the words of the longer.  Lengths fall
  into classes, each up to ``SPREAD`` times as long; a prefix word is compared within one class only.
* Positional filter: the words after the shared one must still allow the overlap needed.
* Parity bits: a word flips one of 64 bits of its line, so the bits in which two lines differ
  are a lower bound of the words that only one of them has.  Lines of more than ``LONG`` words
  fill these bits, so they have ``WIDE`` times as many.
* Verification: the words of the lines left are intersected.

A family of many near copies would make pairs with the square of its size.  So one semi-join,
whose rows are lines and never pairs, first leaves only the lines that may be similar to another.
Of these, each is compared to the earliest and the one before it among those that share one of
its ``RARE`` rarest words; whoever has a match there is decided.  Undecided lines are then held
against all others by semi-joins too: one earlier match decides a line, so it is enough to know
that there is one.

Texts are not shuffled: each line's few features are, and the lines of candidates are
looked up again in their documents.

Defined results: a null text has no lines and stays null; an empty text has one line without
words; rows equal in id and text are copies of which all lines but the first's go; a null id
is before all others; an empty table gives an empty result; extra columns, whatever their
names, are kept by ``drop_lines``.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table
from verbatim.operators.broadcast import bounded_broadcast

SIMILARITY = 0.8
RARITY_BITS = 16
RARE = 8
WIDE = 4  # times 64 parity bits for long lines, a power of two
LONG = 64  # words; longer lines fill 64 bits
SPREAD = 4
PARTS = [f"bits{i}" for i in range(1, WIDE)]
BOUNDS = [i * (1 << 64) // WIDE - (1 << 63) for i in range(1, WIDE)]  # words fall to parts by ranges of their hash
MAX_ROWS = 500_000  # rows of a few numbers that are broadcast; beyond, a shuffle join
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def text_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, no, line, k1, k2, words): every line that has words, in lower case."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(F.split(F.lower("text"), "\n", -1)).alias("no", "line"))
    line = F.col("line")
    return rows.where(F.ltrim(line, F.lit(SPACES)) != "").withColumns({"k1": F.xxhash64(line), "k2": F.xxhash64(line, F.lit(1)), "words": words(line)})


def _split(line: Column) -> Column:
    """A line's words and some empty strings: splitting at single spaces is several times
    faster than at a pattern."""
    other = line.contains("\t") | line.contains("\x0b") | line.contains("\x0c") | line.contains("\r")
    return F.split(F.when(other, F.regexp_replace(line, SPACE, " ")).otherwise(line), " ")


def words(line: Column) -> Column:
    """Hashes of the distinct words of a lower-case line."""
    return F.array_distinct(F.array_remove(F.transform(_split(line), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def _bin(word: Column) -> Column:
    return word.bitwiseAND((1 << RARITY_BITS) - 1).cast("int")


def rarities(lines: DataFrame) -> Column:
    """Array of the frequency class of each hash bin (four for each doubling) in the upper 32 bits of
    a number, as a literal: ``1 << RARITY_BITS`` numbers, however large the table.  A word counts
    once in a line."""
    counts = lines.select(F.explode("words").alias("w")).groupBy(_bin(F.col("w")).alias("bin")).agg(F.count("*").alias("n"))
    classes = ["0"] * (1 << RARITY_BITS)
    for b, c in counts.select("bin", F.floor(4 * F.log2(F.col("n") + 1.0))).collect():
        classes[b] = str(c << 32)
    return F.split(F.lit(",".join(classes)), ",").cast("array<long>")  # folded to one literal


def _prefix(n: Column, t: float) -> Column:
    """Rarest words of a set of n, of which any set similar enough shares one."""
    return (n - F.ceil(n * t - 1e-9) + 1).cast("int")


def _in_parts(words: Column) -> Column:
    """The words in order with the ``WIDE - 1`` numbers between the parts' ranges, a word equal to
    one of these after it."""
    return F.sort_array(F.concat(words, F.array(*[F.lit(b).cast("long") for b in BOUNDS])))


def _part(ordered: Column, part: int) -> Column:
    """One of ``WIDE`` parts of a set of words, as sorted by ``_in_parts``."""
    at = lambda i: F.array_position(ordered, F.lit(BOUNDS[i]).cast("long")).cast("int")
    start = at(part - 1) if part else F.lit(0)
    return F.slice(ordered, start + 1, (at(part) - 1 if part < WIDE - 1 else F.size(ordered)) - start)


def _parity(words: Column, part: int | None = None) -> Column:
    """64 parity bits of a set of words, or of those that fall to one of ``WIDE`` parts of it."""
    # a shift goes by the last six bits
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(w, 40).cast("int"))
    if part is not None:
        words = _part(_in_parts(words), part)
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(bit(w)))


def features(lines: DataFrame, tables: Tables, t: float) -> DataFrame:
    """(k1, n, bits, bits1, .., prefix): each text's number of words, parity bits, those of all
    parts but the first if it is long, and rarest words in order, as their hashes' upper 32 bits
    below their rarities."""
    rarity = rarities(lines)
    # rarity above, 32 bits of the hash below: one number to sort by, and never null, so that plain numbers are sorted
    rank = lambda w: F.coalesce(F.get(rarity, _bin(w)), F.lit(0).cast("long")).bitwiseOR(F.shiftrightunsigned(w, 32))
    long = F.col("n") > LONG
    rows = lines.select("k1", "words", F.size("words").alias("n"))
    rows = rows.select("*", F.when(long, _in_parts(F.col("words"))).alias("in_parts"), F.slice(F.sort_array(F.transform("words", rank)), F.lit(1), _prefix(F.col("n"), t)).alias("prefix"))
    # each word is in one part; a short line is all in the first.  Steps of their own keep slices and sorting in generated code
    parts = F.when(long, F.array(*[_part(F.col("in_parts"), i) for i in range(WIDE)])).otherwise(F.array("words"))
    rows = rows.select("k1", "n", "prefix", parts.alias("parts"))
    rows = rows.select("k1", "n", "prefix", *[F.coalesce(_parity(F.get("parts", F.lit(i))), F.lit(0).cast("long")).alias(c) for i, c in enumerate(["bits0", *PARTS])])
    rows = rows.withColumn("bits", reduce(Column.bitwiseXOR, [F.col(c) for c in PARTS], F.col("bits0")))
    kept = ["n", "bits", *PARTS, "prefix"]
    return tables.put(rows.groupBy("k1").agg(F.min(F.struct(*kept)).alias("f")).select("k1", *[f"f.{c}" for c in kept]), "features")


def _few_bits(n1: Column, n2: Column, differ: Column, t: float) -> Column:
    """Parity bits: at most (1 - t) / (1 + t) of all words are in one line only."""
    return differ <= (n1 + n2) * ((1 - t) / (1 + t)) + 1e-9


def _may_match(x: str, y: str, t: float) -> Column:
    n1, n2 = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits")))
    return (F.least(n1, n2) + 1e-9 >= t * F.greatest(n1, n2)) & _few_bits(n1, n2, differ, t)


def _may_match_wide(x: str, y: str, t: float) -> Column:
    """By the parity bits of all parts: those of the first are ``bits`` without the others'."""
    all_bits, *parts = [F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")) for c in ("bits", *PARTS)]
    parts.append(reduce(Column.bitwiseXOR, parts, all_bits))
    return _few_bits(F.col(f"{x}.n"), F.col(f"{y}.n"), reduce(Column.__add__, [F.bit_count(p) for p in parts]), t)


def _words_of(ids: DataFrame, sets: DataFrame, docs: DataFrame, tables: Tables, name: str) -> DataFrame:
    """(k1, k2, first, words): the words of the texts named by ``ids``, a table (k1)."""
    wanted = tables.put(sets.join(bounded_broadcast(ids, MAX_ROWS), "k1", "left_semi").select("k1", "k2", "first.*"), f"{name}-wanted")
    # back to the documents: only those with a wanted line, and of their lines only these
    of = wanted.select(F.col("doc_id").alias("w_id"), F.col("h").alias("w_h")).distinct()
    some = docs.select("doc_id", "text").join(bounded_broadcast(of, MAX_ROWS), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.xxhash64("text") == F.col("w_h")), "left_semi")
    lines = text_lines(some).join(bounded_broadcast(wanted.select("k1", "k2"), MAX_ROWS), ["k1", "k2"], "left_semi")
    lines = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "h", "no", "line")).alias("f"))
    return tables.put(lines.select("k1", "k2", F.struct("f.doc_id", "f.h", "f.no").alias("first"), words(F.col("f.line")).alias("words")), f"{name}-words")


def _similar(x: Column, y: Column, t: float) -> Column:
    common = F.size(F.array_intersect(x, y))
    return common + 1e-9 >= t * (F.size(x) + F.size(y) - common)


def _may_share(x: str, y: str, t: float) -> Column:
    """Two texts, each in one row for each of its prefix words, may be similar and share this word."""
    c = lambda side, name: F.col(f"{side}.{name}")
    needed = F.ceil((c(x, "n") + c(y, "n")) * (t / (1 + t)) - 1e-9)
    possible = F.least(c(x, "n") - c(x, "at"), c(y, "n") - c(y, "at"))
    short = F.least(c(x, "n"), c(y, "n")) <= LONG
    return (c(x, "w") == c(y, "w")) & _may_match(x, y, t) & (short | _may_match_wide(x, y, t)) & (possible >= needed) & (c(x, "k1") != c(y, "k1"))


def _classes(n: Column, t: float) -> Column:
    """Classes of length of a set of n words: its own and that of the longest similar to it.  Of
    two similar sets the longer's own class is one of the shorter's."""
    own = lambda x: F.floor(F.log(x.cast("double")) / log(SPREAD) + 1e-9)
    return F.sequence(own(n), own(F.floor(n / t + 1e-6)))


def candidates(lines: DataFrame, tables: Tables, t: float) -> DataFrame:
    """(k1, n, bits, bits1, .., at, w): of each text's prefix words, each with a class of length, those
    at which another text may be similar.  A semi-join gives the rows of both texts, and never pairs.

    In a class that is not its own a text meets longer ones only, which need to share one of fewer
    words: of n those before ``n - ceil(2 t / (1 + t) n) + 1``."""
    of = ["k1", "n", "bits", *PARTS]
    rows = lines.select(*of, "prefix", F.posexplode(_classes(F.col("n"), t)).alias("other", "class"))
    prefix = F.when(F.col("other") == 0, F.col("prefix")).otherwise(F.slice("prefix", F.lit(1), _prefix(F.col("n"), 2 * t / (1 + t))))
    rows = rows.select(*of, "class", F.posexplode(prefix).alias("at", "word"))
    # a word and a class are one number to sort by
    word = F.col("word").bitwiseAND((1 << 32) - 1)
    rows = rows.select(*of, "at", (F.call_function("shiftleft", F.col("class"), F.lit(32)) + word).alias("w"))
    # both sides are the same rows with the same columns, so they are shuffled once
    return tables.put(rows.alias("x").join(rows.alias("y"), _may_share("x", "y", t), "left_semi"), "candidates")


def _near_matches(rows: DataFrame, found: DataFrame, tables: Tables, t: float) -> DataFrame:
    """(k1, k2) of the texts similar to the earliest or the previous one of those that share one
    of their ``RARE`` rarest words."""
    own = F.struct("k1", "n", "at", "w", "bits", *PARTS)
    in_order = Window.partitionBy("w").orderBy("first", "k1")
    near = rows.where(F.col("at") < RARE).select(own.alias("x"), F.first(own).over(in_order).alias("first"), F.lag(own).over(in_order).alias("last"))
    near = near.select("x", F.explode(F.array("first", "last")).alias("y")).where(F.col("y").isNotNull() & _may_share("x", "y", t))
    pairs = tables.put(near.select(F.col("x.k1").alias("a"), F.col("y.k1").alias("b")).distinct(), "near-pairs")
    one = lambda x: found.select(F.col("k1").alias(x), F.struct("k1", "k2").alias(f"key_{x}"), F.col("first").alias(f"first_{x}"), F.col("words").alias(f"words_{x}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b")
    similar = (F.col("first_b") < F.col("first_a")) & _similar(F.col("words_a"), F.col("words_b"), t)
    return tables.put(both.where(similar).select("key_a.*").distinct(), "near")


def _rest_matches(rows: DataFrame, decided: DataFrame, found: DataFrame, tables: Tables, t: float) -> DataFrame:
    """(k1, k2) of the texts with an earlier match that are not decided yet.

    Semi-joins only: each gives a row of its left side once however many rows match it, so
    no step makes the pairs of a group.  First the undecided texts with an earlier candidate at
    some word, then those candidates, and with both sides' words the undecided that have a match."""
    may = _may_share("x", "y", t) & (F.col("y.first") < F.col("x.first"))
    open_ = rows.join(bounded_broadcast(decided, MAX_ROWS), ["k1", "k2"], "left_anti")
    later = tables.put(open_.alias("x").join(rows.alias("y"), may, "left_semi"), "rest-later")
    earlier = tables.put(rows.alias("y").join(bounded_broadcast(later, MAX_ROWS).alias("x"), may, "left_semi"), "rest-earlier")
    sent = found.select("k1", "k2", "words")
    x, y = later.join(sent, ["k1", "k2"]).alias("x"), earlier.join(sent, ["k1", "k2"]).alias("y")
    match = may & _similar(F.col("x.words"), F.col("y.words"), t)
    return tables.put(x.join(y, match, "left_semi").select("k1", "k2").distinct(), "rest")


def later_matches(docs: DataFrame, found: DataFrame, sets: DataFrame, tables: Tables, t: float = SIMILARITY) -> DataFrame:
    """(k1, k2): the texts with an earlier line of Jaccard similarity t or more, by their features."""
    some = candidates(found, tables, t)
    found = _words_of(some.select("k1").distinct(), sets, docs, tables, "candidates")
    rows = tables.put(some.join(found.select("k1", "k2", "first"), "k1"), "ordered")
    decided = _near_matches(rows, found, tables, t)
    return decided.union(_rest_matches(rows, decided, found, tables, t)).distinct()


def line_decisions(docs: DataFrame, tables: Tables, t: float = SIMILARITY) -> DataFrame:
    """(doc_id, h, n_lines, n_rows, removed): for each distinct (id, text), the numbers of its
    removed lines in the first row of that id and text."""
    parsed = text_lines(docs).drop("line").persist(StorageLevel.DISK_ONLY)
    try:  # lines are cut and their words hashed once; the words go when the features are written
        lines = tables.put(parsed.drop("words"), "lines")
        found = features(parsed, tables, t)
    finally:
        parsed.unpersist(True)
    # each text once, with its first line
    sets = tables.put(lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "h", "no")).alias("first")), "sets")
    gone = later_matches(docs, found, sets, tables, t)
    # a line stays if it is its text's first and the text has no earlier match
    stays = sets.join(gone, ["k1", "k2"], "left_anti").select("first.*").withColumn("stays", F.lit(True))
    once = lines.select("doc_id", "h", "no").distinct()
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("doc_id", "h", "no")]
    removed = (once.alias("l").join(stays.alias("s"), on, "left_anti").groupBy("doc_id", "h")
               .agg(F.sort_array(F.collect_list("no")).alias("removed")))
    texts = docs.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(
        F.max(F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0))).alias("n_lines"), F.count("*").alias("n_rows"))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "h")]
    return texts.alias("d").join(removed.alias("r"), on, "left").select(
        "d.doc_id", "d.h", F.greatest("n_lines", F.lit(0)).alias("n_lines"), "n_rows",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def drop_lines(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """The documents without their removed lines.  One that had words and has none left is
    dropped, as is every further row of the same id and text that had words."""
    tables = Tables(docs.sparkSession, "lines", tidy=True)
    found = tables.put(line_decisions(docs, tables, t), "decisions")
    changed = found.where((F.size("removed") > 0) | (F.col("n_rows") > 1)).select(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "n_rows", "removed")
    own = docs.columns
    # the split text goes through the join in place of the text
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in own if c != "text"])
    rows = docs.select(others.alias("row"), F.split("text", "\n", -1).alias("lines"), F.xxhash64("text").alias("h"))
    rows = rows.join(changed, F.col("row.doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
    if not found.where("n_rows > 1").isEmpty():  # of rows equal in id and text one goes on
        single = rows.where(F.coalesce(F.col("n_rows"), F.lit(1)) == 1)
        many = rows.where("n_rows > 1").withColumn("copy", F.row_number().over(Window.partitionBy("row.doc_id", "h").orderBy(F.lit(0))))
        has_words = F.exists("lines", lambda x: F.regexp_extract(x, r"[^\x20\x09-\x0D]", 0) != "")
        rows = single.unionByName(many.where((F.col("copy") == 1) | ~F.coalesce(has_words, F.lit(False))).drop("copy"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    text = F.when(F.size("removed") > 0, F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")).otherwise(F.array_join("lines", "\n"))
    rows = rows.withColumn("kept_text", F.when(F.col("lines").isNotNull(), text))
    left = (F.coalesce(F.size("removed"), F.lit(0)) <= 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    return rows.where(left).select(*[(F.col("kept_text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in own])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_decisions(docs, Tables(spark, "op9", tidy=True))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"))


#: Removed lines by comparing all pairs of lines that share a word.
ORACLE = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, text IS NULL AS none FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS no, lower(unnest(parts)) AS line FROM docs),
ws AS (SELECT doc_id, no, unnest(regexp_split_to_array(line, '[\x20\x09-\x0D]+')) AS w FROM lines),
sets AS (SELECT doc_id, no, list_sort(list(DISTINCT w)) AS ws FROM ws WHERE w <> '' GROUP BY doc_id, no),
firsts AS (SELECT ws, len(ws) AS n, min((doc_id, no)) AS f FROM sets WHERE len(ws) > 0 GROUP BY ws),
tokens AS (SELECT f, n, unnest(ws) AS w FROM firsts),
later AS (SELECT DISTINCT b.f AS f FROM tokens a JOIN tokens b ON a.w = b.w AND a.f < b.f AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9
  GROUP BY a.f, b.f, a.n, b.n HAVING count(*) + 1e-9 >= 0.8 * (a.n + b.n - count(*))),
removed AS (SELECT s.doc_id, s.no FROM sets s WHERE len(s.ws) > 0 AND (s.doc_id, s.no) NOT IN
  (SELECT f FROM firsts WHERE f NOT IN (SELECT f FROM later)))
SELECT d.doc_id, CAST(CASE WHEN d.none THEN 0 ELSE len(d.parts) END AS BIGINT) AS n_lines, CAST(count(r.no) AS BIGINT) AS n_removed,
  coalesce(string_agg(CAST(r.no AS VARCHAR), ',' ORDER BY r.no), '') AS removed
FROM docs d LEFT JOIN removed r ON d.doc_id = r.doc_id GROUP BY d.doc_id, d.none, d.parts
"""
