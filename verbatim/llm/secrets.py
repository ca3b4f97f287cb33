"""Secret scans with DataFrame functions only.

Base rules are patterns (``RULES``), each matched leftmost and without overlap; matches that
are too short are dropped.  The method adds candidates, tokens of 20 or more characters with
letters and digits, that a first-order Markov model of characters of random strings explains
better than one of ordinary identifiers: the log-likelihood ratio exceeds ``LEAST_RATIO``.
A candidate that overlaps a base match is left to it.

The models are trained from labelled samples (text, label 1 random or 0 ordinary), smoothed
by the characters' own frequencies.  ``labelled`` makes them from documents: of at most ``SAMPLE`` documents, the
smallest by a hash of their id, the base rules' secrets are random and all tokens that are
neither secrets nor candidates are ordinary; ``RANDOM`` digests of numbers, in hexadecimal and base 64, are random too, so that
a corpus without matches still has a model.

Offsets are code points.  Where the pattern splits a text, gaps and matches alternate, so a
match starts at the sum of the lengths before it; sums are taken by a window over one text's
matches, not by repeated scans of the text.

Defined results: a null or empty text has no span; each row has its own result, repeated or
not; an empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.llm.common import Tables, table

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group that is the secret, its least length
RULES = (("assign", ASSIGN, 2, 12), ("access", r"(AKIA[A-Z0-9]+)", 1, 18), ("hex", r"([0-9a-f]+)", 1, 16))
#: The same with the least length written into the pattern: what isn't ordinary text.
LONG = (ASSIGN[:-2] + "{12,})", r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}")
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])([A-Za-z0-9+/_=-]{20,})"
ANY_TOKEN = r"[A-Za-z0-9+/_.=-]{8,}"
KINDS = tuple(r[0] for r in RULES) + ("model",)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
BEGIN = len(ALPHABET) + 1  # 0: any other character
SMOOTHING = 0.5
BACKOFF = 5.0  # weight of a character's own frequency in its context's counts
LEAST_RATIO = 7.0
SAMPLE = 2_000
RANDOM = 2_000


def _matches(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one pattern in order: number of the kind, place, length of the gap before
    it, its own length, whether it is long enough, and the secret."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    secret = lambda m: m if group == 1 else F.regexp_extract(m, pattern, group)
    found = F.transform(F.filter(pairs, lambda p: p["m"].isNotNull()), lambda p, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), F.char_length(p["g"]).alias("gap"), F.char_length(p["m"]).alias("len"),
        (F.char_length(secret(p["m"])) >= least).alias("ok"), secret(p["m"]).alias("secret")))
    return F.when(text.rlike(pattern), found)


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): all matches of every rule and all candidates of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rules = [(i, p, g, n) for i, (_, p, g, n) in enumerate(RULES)] + [(len(RULES), TOKEN, 1, 20)]
    # a short hexadecimal run ends at the next other character: only long ones matter,
    # and what comes before a long one is gap
    rules[2] = (2, r"((?<![0-9a-f])[0-9a-f]{16,})", 1, 16)
    none = "array<struct<kind:int,i:int,gap:int,len:int,ok:boolean,secret:string>>"
    parts = [F.coalesce(_matches(text, *r).cast(none), F.array().cast(none)) for r in rules]
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*parts).alias("found"))


def bigrams(rows: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep``, prev and cur: the neighbouring characters of each text, the first after BEGIN."""
    rows = rows.where(F.char_length(text) > 0).select(*keep, text, F.explode(F.sequence(F.lit(1), F.char_length(text))).alias("at"))
    code = lambda at: F.expr(f"locate(substring({text}, {at}, 1), '{ALPHABET}')")
    return rows.select(*keep, F.when(F.col("at") == 1, F.lit(BEGIN)).otherwise(code("at - 1")).alias("prev"), code("at").alias("cur"))


def labelled(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, label) samples from at most ``most`` documents, and digests of numbers."""
    spark = docs.sparkSession
    ranked = docs.select("text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(11)).alias("rank"))
    last = ranked.select("rank").orderBy("rank").limit(most).agg(F.max("rank")).first()[0]
    some = ranked.where(F.col("rank") <= F.lit(last)).withColumn("text", F.coalesce("text", F.lit("")))
    secrets = some.select(F.explode(F.concat(*[
        F.filter(F.regexp_extract_all("text", F.lit(p), F.lit(g)), lambda s, n=n: F.char_length(s) >= n) for _, p, g, n in RULES])).alias("text"))
    rest = F.col("text")
    for p in (*LONG, TOKEN):  # what is to be judged has no label
        rest = F.regexp_replace(rest, p, " ")
    ordinary = some.select(F.explode(F.regexp_extract_all(rest, F.lit(ANY_TOKEN), F.lit(0))).alias("text"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(RANDOM).select(F.explode(F.array(F.substring(digest, 1, 40), F.substring(F.base64(F.unhex(digest)), 1, 40))).alias("text"))
    return secrets.union(made).select("text", F.lit(1).alias("label")).union(ordinary.select("text", F.lit(0).alias("label")))


def train(samples: DataFrame) -> DataFrame:
    """(prev, cur, weight): log-likelihood ratio of each pair of characters, random against
    ordinary; one row for each pair of codes, whatever the samples."""
    pairs = bigrams(samples, ["label"], "text").groupBy("prev", "cur").agg(
        F.sum("label").alias("random"), F.sum(1 - F.col("label")).alias("ordinary"))
    codes = F.explode(F.sequence(F.lit(0), F.lit(BEGIN)))
    grid = samples.sparkSession.range(1).select(codes.alias("prev")).select("prev", codes.alias("cur")).where(F.col("cur") < BEGIN)
    grid = grid.join(F.broadcast(pairs), ["prev", "cur"], "left").fillna(0, ["random", "ordinary"])
    after, same, every = Window.partitionBy("prev"), Window.partitionBy("cur"), Window.partitionBy()

    def share(c: str) -> Column:  # a rare context falls back on the character's own frequency
        alone = (F.sum(c).over(same) + SMOOTHING) / (F.sum(c).over(every) + SMOOTHING * BEGIN)
        return F.log((F.col(c) + BACKOFF * alone) / (F.sum(c).over(after) + BACKOFF))

    return grid.select("prev", "cur", (share("random") - share("ordinary")).alias("weight"))


def scan(docs: DataFrame, samples: DataFrame, tables: Tables) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans, arrays of (start, kind, end)
    structs in order; spans has the method's too."""
    found = tables.put(matches(docs), "matches")
    model = F.broadcast(tables.put(train(samples), "model"))  # (BEGIN + 1) x BEGIN rows
    rows = found.select("row", F.inline("found"))
    until = Window.partitionBy("row", "kind").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(until)).where("ok")
    rows = tables.put(rows.select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "secret"), "spans")
    last = len(RULES)
    ratio = (bigrams(rows.where(F.col("kind") == last), ["row", "start"], "secret").join(model, ["prev", "cur"])
             .groupBy("row", "start").agg(F.sum("weight").alias("ratio")).where(F.col("ratio") > LEAST_RATIO)
             .select("row", "start", F.lit(last).alias("kind")))
    base = rows.where(F.col("kind") < last).drop("secret")
    added = rows.where(F.col("kind") == last).drop("secret").join(ratio, ["row", "start", "kind"], "left_semi")
    both = base.union(added.select(*base.columns))
    order = Window.partitionBy("row").orderBy("start", "kind")
    is_base = F.col("kind") < last
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    both = both.withColumn("apart", F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True)))
    span = F.struct("start", "kind", "end")
    spans = both.where(is_base | F.col("apart")).groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(is_base, span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))
    return found.select("row", "doc_id").join(spans, "row", "left").drop("row")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ","), F.lit(""))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, labelled(docs), Tables(spark, "op4"))
    count = lambda k: F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == k)), F.lit(0)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])],
                        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
