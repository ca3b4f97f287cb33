"""Conversation prefix trie by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text) of the conversations; the textless
root is the sequence of none.  Every node has an enter and an exit arc; the tour through all
of them, children in order of their smallest member, is a linked list.  Its prefix sums give
each subtree's leaves and savings: the sum at a node's exit less the sum before its enter.

* Turns are put in order and prefixes named by two 64-bit polynomial hashes of their turns
  (``runs.in_order``: a conversation with a third of all rows lies in many tasks).
* Nodes are the groups of equal prefixes, aggregated before the shuffle; a node is known
  after that by its smallest member and its depth.  The nodes of one smallest member follow
  each other down the trie: a path.  As a path's next node is always the first child, a
  path's enter arcs follow each other in the tour, and so do the exit arcs between two nodes
  at which other paths hang.  These stretches are the list's elements, at most two for
  each path, linked by one pass over the paths in the order of the tour.
* List ranking: in each round an element whose coin shows head takes in the next one if
  that shows tail (a quarter of all), until at most ``LAST`` are left, which are summed
  on the driver; then the rounds are undone, last first.
* A last pass over nodes and elements, by path and descending depth, gives every node its
  places in the tour and the sums there.

Nothing is joined on a key that many rows share: joins are of unique keys, and a hot parent's
children get its name in a sorted pass.

Defined results: a null role or text is empty; turns are ordered by (turn, role, text), a null
turn first, so ties are in order of role and text and repeated rows are turns of their own;
rows without a conv_id belong to no conversation; a conversation without turns is a member of the
root alone; an empty table has no nodes, not even a root.  Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table
from verbatim.llm.runs import Wanted, in_order, partitions

LAST = 1_000  # elements of the contracted list that are summed on the driver
PATH = -1  # the depth that names a path's first element

# what the contract of op12 fixes
GROUP, HEADS = 5, 9


def ordered_turns(conversations: DataFrame, tables: Tables) -> DataFrame:
    """(conv_id, nth, x1, x2, n_bytes): each turn's position in its conversation, two hashes of
    its role and text, and the text's UTF-8 bytes."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text"))
    rows = rows.withColumns({"x1": F.xxhash64("role", "text"), "x2": F.xxhash64(F.lit(1), "text", "role"), "n_bytes": F.octet_length("text").cast("long")})
    # the order of equal turns needs role and text; nothing after the sort does
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return in_order(rows, ["conv_id"], order, Wanted(keep=("x1", "x2", "n_bytes")), tables, "turns")


def _ends(rows: DataFrame, tables: Tables) -> DataFrame:
    """(p1, p2, ends_sha256) of the conversations (conv_id, p1, p2) that end at a node.

    Each task joins the ids of its range; of a node that many conversations end at, only these
    pieces, in order, go through one hash."""
    rows = tables.put(rows, "last")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, ids, out = TaskContext.get().partitionId(), None, [], []
        for b in batches:
            for a1, a2, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (a1, a2) != key:
                    if key is not None:
                        out.append((*key, part, ",".join(ids)))
                    key, ids = (a1, a2), []
                ids.append(str(c))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["p1", "p2", "part", "ids"])
                out = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, part, ",".join(ids))], ["p1", "p2", "part", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            out = []
            for a1, a2, ids in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (a1, a2) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (a1, a2), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["p1", "p2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], ["p1", "p2", "ends_sha256"])

    parts = partitions(rows)
    dealt = rows.select("p1", "p2", "conv_id").repartitionByRange(parts, "p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    found = tables.put(dealt.mapInArrow(pieces, "p1 long, p2 long, part long, ids string"), "pieces")
    dealt = found.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "part").select("p1", "p2", "ids")
    return dealt.mapInArrow(hashes, "p1 long, p2 long, ends_sha256 string")


SUMS = ("arcs", "leaves", "saved")


def list_rank(elements: DataFrame, tables: Tables, last: int = LAST) -> DataFrame:
    """(c, d, at_arcs, at_leaves, at_saved): the sums of all elements before each one.

    ``elements``: (c, d, next_c, next_d, arcs, leaves, saved); the last one's next is null, and
    no element's next is the first.
    """
    spark, cur, undo = elements.sparkSession, elements, []
    while cur.count() > last:
        r = len(undo)
        head = F.xxhash64("c", "d", F.lit(r)).bitwiseAND(1) == 1
        a = cur.where(head).select(*[F.col(x).alias(f"a_{x}") for x in cur.columns])
        b = cur.where(~head).select(*[F.col(x).alias(f"b_{x}") for x in cur.columns])
        # an element that shows tail is the next one of at most one that shows head
        both = a.join(b, (F.col("a_next_c") == F.col("b_c")) & (F.col("a_next_d") == F.col("b_d")), "full_outer")
        both = tables.put(both, f"round{r}")
        taken = F.col("a_c").isNotNull() & F.col("b_c").isNotNull()
        one = F.coalesce(F.col("a_c"), F.col("b_c")).alias("c"), F.coalesce(F.col("a_d"), F.col("b_d")).alias("d")
        follow = [F.when(taken | F.col("a_c").isNull(), F.col(f"b_next_{x}")).otherwise(F.col(f"a_next_{x}")).alias(f"next_{x}") for x in ("c", "d")]
        sums = [(F.coalesce(F.col(f"a_{x}"), F.lit(0)) + F.coalesce(F.col(f"b_{x}"), F.lit(0))).alias(x) for x in SUMS]
        undo.append(both.where(taken).select(F.col("b_c").alias("c"), F.col("b_d").alias("d"), F.col("a_c").alias("by_c"), F.col("a_d").alias("by_d"), *[F.col(f"a_{x}").alias(x) for x in SUMS]))
        cur = both.select(*one, *follow, *sums)
    rows = {(r["c"], r["d"]): r for r in cur.collect()}
    nexts = {(r["next_c"], r["next_d"]) for r in rows.values()}
    at, so_far, ranked = next((k for k in rows if k not in nexts), None), [0, 0, 0], []
    while at in rows:
        ranked.append((*at, *so_far))
        so_far = [s + rows[at][x] for s, x in zip(so_far, SUMS)]
        at = (rows[at]["next_c"], rows[at]["next_d"])
    found = spark.createDataFrame(ranked, "c long, d long, at_arcs long, at_leaves long, at_saved long")
    for r, gone in reversed(list(enumerate(undo))):
        by = found.select(F.col("c").alias("by_c"), F.col("d").alias("by_d"), *[f"at_{x}" for x in SUMS])
        more = gone.join(by, ["by_c", "by_d"]).select("c", "d", *[(F.col(f"at_{x}") + F.col(x)).alias(f"at_{x}") for x in SUMS])
        found = tables.put(found.unionByName(more), f"ranked{r}")
        tables.drop(f"ranked{r + 1}")
    return found


def prefix_trie(turns: DataFrame, convs: DataFrame, tables: Tables, last: int = LAST) -> DataFrame:
    """The trie of conversations whose turns are (conv_id, seg, at, x1, x2, n_bytes), in order
    of (seg, at); ``convs``: every conv_id once.

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and its arcs' places in the tour, enter and exit."""
    rows = tables.put(turns, "rebuilt")
    rows = in_order(rows, ["conv_id"], [F.col("seg"), F.col("at")], Wanted(chains=("x1", "x2"), keep=("n_bytes",)), tables, "prefixes")
    rows = rows.select("conv_id", F.col("nth").alias("depth"), F.col("x1_chain").alias("p1"), F.col("x2_chain").alias("p2"), F.col("x1_before").alias("q1"), F.col("x2_before").alias("q2"), "n_bytes")

    convs = tables.put(convs, "convs")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"), "n_convs", zero.alias("saved"))
    nodes = rows.groupBy("depth", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("n_bytes").alias("n_bytes"), F.count("*").alias("n_convs"))
    nodes = nodes.select("conv_id", "depth", "p1", "p2", "q1", "q2", "n_convs", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    nodes = tables.put(nodes.unionByName(root), "nodes")

    ends = rows.groupBy("conv_id").agg(F.max_by("p1", "depth").alias("p1"), F.max_by("p2", "depth").alias("p2"))
    ends = convs.join(ends, "conv_id", "left").select("conv_id", F.coalesce("p1", zero).alias("p1"), F.coalesce("p2", zero).alias("p2"))
    ends = _ends(ends, tables)

    # paths: the nodes of one smallest member, from depth a to b, and where they hang (pc, pd)
    paths = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.min("depth").alias("a"), F.max("depth").alias("b"), F.sum("saved").alias("saved"),
                                                          F.min_by("q1", "depth").alias("q1"), F.min_by("q2", "depth").alias("q2"))
    paths = tables.put(paths, "paths")
    hang = paths.where("a > 0").select("q1", "q2").distinct()
    parents = hang.join(nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("pc")), ["q1", "q2"])
    known = ["a", "b", "saved"]
    both = parents.select("q1", "q2", F.lit(None).cast("long").alias("c"), "pc", *[zero.alias(x) for x in known]).unionByName(
        paths.where("a > 0").select("q1", "q2", "c", F.lit(None).cast("long").alias("pc"), *known))
    named = in_order(tables.put(both, "hang"), ["q1", "q2"], [F.col("c").asc_nulls_first()], Wanted(carry=("pc",), keep=("c", *known)), tables, "named")
    named = tables.put(named.where(F.col("c").isNotNull()).select("c", *known, "pc", (F.col("a") - 1).alias("pd")), "hanging")

    # backwards along the tour: the row before is what the tour comes to next
    tour = in_order(named, ["pc"], [F.col("pd"), F.col("c").desc()], Wanted(keep=("c", "a", "b", "saved", "pd"), lag=("pd", "c")), tables, "tour")
    branches = named.groupBy("pc", "pd").agg(F.count("*").alias("n"), F.min("c").alias("first"))
    branches = tables.put(branches, "branches")
    deepest = branches.groupBy(F.col("pc").alias("c")).agg(F.max("pd").alias("d1"), F.max_by("first", "pd").alias("first"))
    sibling = F.col("pd_lag") == F.col("pd")
    after = tour.select("c", F.when(sibling, F.col("c_lag")).otherwise(F.col("pc")).alias("after_c"), F.when(sibling, F.lit(PATH)).otherwise(F.col("pd")).cast("long").alias("after_d"), "pc", "pd")
    every = paths.select("c", "a", "b", "saved").join(after, "c", "left").join(deepest, "c", "left")
    every = tables.put(every, "every")
    path = F.lit(PATH).cast("long")
    e = every.select("c", path.alias("d"), F.coalesce("first", "after_c").alias("next_c"), F.when(F.col("d1").isNull(), F.col("after_d")).otherwise(path).alias("next_d"),
                     (2 * F.col("b") - F.col("a") + 1 - F.coalesce(F.col("d1"), F.col("a") - 1)).alias("arcs"),
                     F.when(F.coalesce(F.col("d1") < F.col("b"), F.lit(True)), 1).otherwise(0).cast("long").alias("leaves"), "saved")
    x = tour.where(F.coalesce(~sibling, F.lit(True))).select("pc", "pd", F.col("pd_lag").alias("lower"), F.col("c_lag").alias("next"))
    inner = x.where(F.col("next").isNotNull()).select(F.col("pc").alias("c"), F.col("pd").alias("d"), F.col("next").alias("next_c"), path.alias("next_d"), (F.col("pd") - F.col("lower")).alias("arcs"))
    outer = x.where(F.col("next").isNull()).join(every.select(F.col("c").alias("pc"), "a", "after_c", "after_d"), "pc")
    outer = outer.select(F.col("pc").alias("c"), F.col("pd").alias("d"), F.col("after_c").alias("next_c"), F.col("after_d").alias("next_d"), (F.col("pd") - F.col("a") + 1).alias("arcs"))
    x = inner.unionByName(outer).withColumns({"leaves": zero, "saved": zero})
    ranks = list_rank(tables.put(e.unionByName(x), "elements"), tables, last)

    # nodes between the elements of their path, deepest first
    none = F.lit(None).cast("long")
    start = ["e_arcs", "e_leaves", "e_saved", "a", "b", "total", "leaf", "pc"]
    stop = ["x_depth", "x_n", "x_arcs", "x_leaves", "x_saved"]
    own = ["p1", "p2", "n_convs"]
    at_path = ranks.where(F.col("d") == PATH).join(every, "c").select(
        "c", F.lit((1 << 62)).alias("depth"), F.lit(0).alias("kind"), zero.alias("saved"), F.col("at_arcs").alias("e_arcs"), F.col("at_leaves").alias("e_leaves"), F.col("at_saved").alias("e_saved"),
        "a", "b", F.col("saved").alias("total"), F.when(F.coalesce(F.col("d1") < F.col("b"), F.lit(True)), 1).otherwise(0).cast("long").alias("leaf"), "pc", *[none.alias(y) for y in stop + own])
    at_branch = ranks.where(F.col("d") != PATH).join(branches.select(F.col("pc").alias("c"), F.col("pd").alias("d"), "n"), ["c", "d"]).select(
        "c", F.col("d").alias("depth"), F.lit(1).alias("kind"), zero.alias("saved"), *[none.alias(y) for y in start],
        F.col("d").alias("x_depth"), F.col("n").alias("x_n"), F.col("at_arcs").alias("x_arcs"), F.col("at_leaves").alias("x_leaves"), F.col("at_saved").alias("x_saved"), *[none.alias(y) for y in own])
    at_node = nodes.select(F.col("conv_id").alias("c"), "depth", F.lit(2).alias("kind"), "saved", *[none.alias(y) for y in start + stop], *own)
    merged = tables.put(at_path.unionByName(at_branch).unionByName(at_node), "merged")
    merged = in_order(merged, ["c"], [F.col("depth").desc(), F.col("kind")], Wanted(sums=("saved",), carry=(*start, *stop), keep=("depth", "kind", *own)), tables, "subtrees").where("kind = 2")

    col, seen = F.col, F.col("x_depth").isNotNull()
    begin = col("e_saved") + col("total") - col("saved_sum")
    end = F.when(seen, col("x_saved")).otherwise(col("e_saved") + col("total"))
    out = merged.select(
        col("c").alias("conv_id"), "depth", F.when(col("depth") > col("a"), col("c")).otherwise(col("pc")).alias("parent_conv_id"), "n_convs",
        (F.when(col("x_depth") == col("depth"), col("x_n")).otherwise(0) + F.when(col("depth") < col("b"), 1).otherwise(0)).cast("long").alias("n_children"),
        (F.when(seen, col("x_leaves")).otherwise(col("e_leaves") + col("leaf")) - col("e_leaves")).alias("n_leaves"),
        (end - begin).alias("saved_tokens"), "p1", "p2",
        (col("e_arcs") + col("depth") - col("a")).alias("enter"),
        F.when(seen, col("x_arcs") + col("x_depth") - col("depth")).otherwise(col("e_arcs") + col("b") - col("a") + 1 + col("b") - col("depth")).alias("exit"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return out.join(ends, ["p1", "p2"], "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                                     F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "enter", "exit")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the conversations as op12 rebuilds them, and their ids."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.select("conv_id").distinct()
    own = turns.where(F.col("nth") > h).select("conv_id", F.lit(1).alias("seg"), F.col("nth").alias("at"), "x1", "x2", "n_bytes")
    heads = turns.where((F.col("nth") < HEADS) & (F.col("conv_id") % GROUP == 0)).select(F.col("conv_id").alias("base"), "nth", "x1", "x2", "n_bytes")
    given = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), h.alias("h")).join(heads, "base").where(F.col("nth") <= F.col("h"))
    given = given.select("conv_id", F.lit(0).alias("seg"), F.col("nth").alias("at"), "x1", "x2", "n_bytes")
    return given.unionByName(own), convs


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, "op12")
    turns, convs = rebuilt(ordered_turns(table(spark, sf_dir, "conversations"), tables))
    return prefix_trie(turns, convs, tables).drop("enter", "exit")


#: crc32 of the decimal id bit by bit; nodes are lists of turns.
ORACLE = """
WITH turns AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (SELECT conv_id, ts, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h FROM turns),
built AS (SELECT a.conv_id, list_concat(CASE WHEN a.h > 0 THEN b.ts[1:a.h] ELSE [] END, a.ts[a.h + 1:]) AS ts FROM crc a LEFT JOIN turns b ON b.conv_id = a.base),
depths AS (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM built),
members AS (SELECT conv_id, CASE WHEN d > 0 THEN ts[1:d] ELSE [] END AS node, d, d = len(ts) AS last FROM depths),
nodes AS (SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends,
    CASE WHEN d > 0 THEN (count(*) - 1) * strlen(node[d].text) ELSE 0 END AS saved FROM members GROUP BY node, d),
kids AS (SELECT CASE WHEN depth > 1 THEN node[1:depth - 1] ELSE [] END AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.node = k.node AND n.depth = k.depth),
above AS (SELECT node, saved, n_children, unnest(range(depth + 1)) AS d FROM full_),
sums AS (SELECT CASE WHEN d > 0 THEN node[1:d] ELSE [] END AS node, d AS depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM above GROUP BY ALL)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN sums s ON f.node = s.node AND f.depth = s.depth
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.node = CASE WHEN f.depth > 1 THEN f.node[1:f.depth - 1] ELSE [] END
"""
