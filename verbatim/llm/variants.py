"""Spelling variants by finite-state composition.

Two words are near if one edit (a code point inserted, deleted or replaced) makes one of the
other.  All near pairs are what the composition of the vocabulary's acceptor, a transducer
of exactly one edit and the acceptor again accepts.  It is enumerated for each initial state
apart, without ever building one machine of the whole vocabulary:

* The edit of a pair lies in one half of the shorter word, so the words agree in the other.
  A word goes to the states that its first and its last half lead to, as the shorter
  word of a pair (or one of equal length) and as the longer one.  What is left of the words of
  a state is a small language.
* A state that more than ``STATE`` words reach is split in the same way by the halves
  of what is left of them, as often as needed: halves shrink to one letter, of which there
  are 90.  No state is cut, and none stays large.
* For each state a task builds the minimal acceptor of the words left and walks through the
  composition: on equal letters, over each possible edit, and on through what both states
  after the edit accept.  It passes on, per word, the number of its near words and the best.
* A pair is accepted at one state only: if an insertion can be seen in both halves, the
  first halves agree, and the last half's state leaves the pair to the other.

Forms point to words at least twice as frequent, so roots are found from the top down in as
many rounds as forms follow each other; a round joins on words that are near to the key, never
on a root that a third of the words may share.

Defined results: a null or empty text has no words; a null doc_id counts as the empty text in
``<doc_id>:<run>``; repeated rows count again; ties in n go to the word first in code-point order;
an empty table has no words.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table, text_bytes

RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # [a-zÀ-ÿ]+ in UTF-8
MIN_LENGTH, MIN_COUNT = 5, 3
ONE_IN = 97  # runs of which op13 deletes a code point
RATIO = 2
STATE = 10_000  # words of one initial state
FLUSH = 300_000  # words that a task counts before it passes them on


def run_counts(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """(word, n): the words of all texts; every so many runs, by a hash, lose a code point."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return rows

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUN.findall(text.lower())).items():
                    h = zlib.crc32(word, seed)
                    if not h % one_in:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1:]).encode()
                    if len(word) >= MIN_LENGTH:
                        counts[word] += n
                if len(counts) > FLUSH:
                    yield out()
        if counts:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    counts = run_counts(docs).where(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _states(rows: DataFrame) -> DataFrame:
    """Each word (state, path, short, rest) at the states that halves of its rest lead to.

    ``short`` is the length of the shorter word's rest; ``path`` names the halves so far."""
    k = F.floor(F.col("short") / 2).cast("int")
    n = F.char_length("rest")
    first = F.struct(F.concat("state", F.lit("/"), "short", F.lit("<"), F.substring("rest", F.lit(1), k)).alias("state"), F.concat("path", F.lit("<")).alias("path"),
                     (F.col("short") - k).alias("short"), F.substring("rest", k + 1, n).alias("rest"))
    last = F.struct(F.concat("state", F.lit("/"), "short", F.lit(">"), F.substring("rest", n - F.col("short") + k + 1, n)).alias("state"), F.concat("path", F.lit(">")).alias("path"),
                    k.alias("short"), F.substring("rest", F.lit(1), n - F.col("short") + k).alias("rest"))
    return rows.select("word", "n", F.inline(F.array(first, last)))


def acceptor(words: Iterable[str]) -> tuple[list[dict[str, int]], list[bool], int]:
    """Arcs and finality of the states of the minimal acyclic acceptor; state 0 is initial."""
    arcs: list[dict[str, int]] = [{}]
    final, register, path, before = [False], {}, [0], ""

    def close(down: int) -> None:  # states below that depth are complete: merge equal ones
        for depth in range(len(path) - 1, down, -1):
            s = path.pop()
            same = register.setdefault((final[s], tuple(arcs[s].items())), s)
            if same != s:
                arcs[path[-1]][before[depth - 1]] = same

    for word in sorted(words):
        shared = 0
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        close(shared)
        for letter in word[shared:]:
            arcs[path[-1]][letter] = len(arcs)
            path.append(len(arcs))
            arcs.append({})
            final.append(False)
        final[path[-1]] = True
        before = word
    close(0)
    return arcs, final, 0


def composed(words: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Every pair of words that differ by one edit, once, by composing their acceptor with one
    edit and itself.  Of the places where a run's letter can be inserted it takes the last."""
    arcs, final, start = acceptor(words)
    known: dict[tuple[int, int, str], list[str]] = {}

    def common(p: int, q: int, but: str = "") -> list[str]:
        """What both states accept, not starting with the letter ``but``."""
        if (p, q, but) not in known:
            out, todo = [], [(p, q, "")]
            while todo:
                a, b, read = todo.pop()
                if final[a] and final[b]:
                    out.append(read)
                near, far = arcs[a], arcs[b]
                for letter, to in near.items():
                    if letter in far and (read or letter != but):
                        todo.append((to, far[letter], read + letter))
            known[p, q, but] = out
        return known[p, q, but]

    todo = [(start, "")]
    while todo:
        state, read = todo.pop()
        follow = list(arcs[state].items())
        for i, (a, p) in enumerate(follow):
            for b, q in follow[:i]:
                for rest in common(p, q):
                    yield read + a + rest, read + b + rest
            for rest in common(state, p, a):
                yield read + rest, read + a + rest
            todo.append((p, read + a))


def leads(path: str, short: str, long: str) -> bool:
    """Is ``path`` the way by which this pair is found: through the first half wherever it can?"""
    for step in path:
        k = len(short) // 2
        agree = short[:k] == long[:k]
        if agree != (step == "<"):
            return False
        cut = len(long) - len(short) + k
        short, long = (short[k:], long[k:]) if agree else (short[:k], long[:cut])
    return True


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) per word of each state; rows come sorted by state."""
    out: list[tuple] = []

    def done(path: str, short: int, rests: dict[str, tuple[str, int]]) -> None:
        best: dict[str, list] = {}
        for u, v in composed(rests):
            (a, a_n), (b, b_n) = rests[u], rests[v]
            if len(u) == len(v):
                if len(u) > short:  # found at a state where they are the shorter ones
                    continue
            elif not (leads(path, a, b) if len(a) < len(b) else leads(path, b, a)):
                continue
            for x, y, n in ((a, b, b_n), (b, a, a_n)):
                seen = best.setdefault(x, [0, 0, ""])
                seen[0] += 1
                if n > seen[1] or n == seen[1] and y < seen[2]:
                    seen[1:] = n, y
        out.extend((w, *x) for w, x in best.items())

    state, path, short, rests = None, "", 0, {}
    for b in batches:
        for s, p, m, word, n, rest in zip(*(c.to_pylist() for c in b.columns)):
            if s != state:
                if len(rests) > 1:
                    done(path, short, rests)
                state, path, short, rests = s, p, m, {}
            rests[rest] = (word, n)
        if out:
            yield _rows(out)
            out.clear()
    if len(rests) > 1:
        done(path, short, rests)
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    word, near, n, best = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(word), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best)], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, tables: Tables, most: int = STATE) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have a near word: how many, and the
    most frequent of them."""
    lengths = F.char_length("word")
    # as the shorter word or one of equal length, and as the longer one
    rows = words.select("word", "n", F.lit("").alias("state"), F.lit("").alias("path"), F.explode(F.array(lengths, lengths - 1)).alias("short"), F.col("word").alias("rest"))
    found = None
    for level in range(64):
        rows = tables.put(_states(rows.where("short > 0")), f"states{level}")
        # at most one in ``most`` rows is a large state's key
        large = tables.put(rows.where("short > 1").groupBy("state").count().where(F.col("count") > most).select("state"), f"large{level}")
        many = not large.isEmpty()
        small = rows.join(F.broadcast(large), "state", "left_anti") if many else rows
        dealt = small.repartition("state").sortWithinPartitions("state").select("state", "path", "short", "word", "n", "rest")
        part = tables.put(dealt.mapInArrow(_compose, "word string, n_near long, best_n long, best string"), f"near{level}")
        found = part if found is None else found.unionByName(part)
        if not many:
            break
        rows = rows.join(F.broadcast(large), "state", "left_semi")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("x")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("x.n")).alias("best_n"), F.col("x.best").alias("best"))


def roots(links: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) of the words that have a form (word, form)."""
    links = tables.put(links, "links")
    top = tables.put(links.join(links.select(F.col("word").alias("form")), "form", "left_anti").select("word", F.col("form").alias("root")), "roots0")
    found, left, step = top, links.join(top, "word", "left_anti"), 0
    while not top.isEmpty():
        step += 1
        top = tables.put(left.join(top.select(F.col("word").alias("form"), "root"), "form").select("word", "root"), f"roots{step}")
        found, left = found.unionByName(top), tables.put(left.join(top, "word", "left_anti"), f"left{step}")
    return found


def spelling_variants(words: DataFrame, tables: Tables, most: int = STATE) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word (word, n)."""
    words = tables.put(words, "words")
    near = tables.put(words.join(near_words(words, tables, most), "word", "left"), "near")
    formed = F.col("best_n") >= RATIO * F.col("n")
    links = near.where(formed).select("word", F.col("best").alias("form"))
    return near.join(roots(links, tables), "word", "left").select(
        "word", F.when(formed, F.col("best")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, "op13")
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents")), tables)


#: crc32 bit by bit; near words by deleting one letter of each.
ORACLE = r"""
WITH runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
bytes AS (SELECT run, n, list_transform(string_split(concat(coalesce(doc_id::VARCHAR, ''), ':', run), ''), lambda x: unicode(x)::BIGINT) AS cs FROM counted),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    flatten(list_transform(cs, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) AS h FROM bytes),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS best_n, min(near) FILTER (n = top) AS best
    FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * w.n THEN b.best END AS form, CASE WHEN b.best_n >= 2 * w.n THEN b.best_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word),
down AS (WITH RECURSIVE down(word, root) AS (SELECT word, word FROM forms WHERE form IS NULL
    UNION ALL SELECT f.word, d.root FROM forms f JOIN down d ON f.form = d.word) SELECT * FROM down)
SELECT f.word, f.form, d.root, f.n, f.n_near, f.form_n FROM forms f JOIN down d ON f.word = d.word
"""
