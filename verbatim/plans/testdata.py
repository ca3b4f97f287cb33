"""Queries over the given test tables, one per operator group.

Stand-ins
---------
* responses: ``documents`` with ``question = source``, ``response = text``.
* panel ``sv``: ``documents ⟕ labels``; respondent ``doc_id % 100``, wave
  ``doc_id div 100`` (key derivations, every row kept); language from ``lang``;
  coded demographics ``quality`` and ``toxic``; the consent gate is a moderation flag
  (``toxic = 1`` → not consenting), so the gate drops real rows of the data.
* events: fill-forward at volume (``user_id`` by ``ts, event_id``).
* orders: yearly wave files; customer/orders: zip lookup with duplicate zips.

Every query reads whole tables; nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.functions.keys import code_number
from verbatim.functions.recode import child_flag, first_true, recode_map
from verbatim.functions.words import unicode_word_counts as count_unicode_words
from verbatim.functions.zipcodes import normalize_zip
from verbatim.operators.attributes import decode_labelled, question_texts, with_attributes
from verbatim.operators.audit import catalog_audit, number_questions, question_index
from verbatim.operators.bigrams import bigram_occurrences, sort_counts
from verbatim.operators.decode import decode_values
from verbatim.operators.fill import fill_forward
from verbatim.operators.graph import bigram_network
from verbatim.operators.harmonize import fold_waves, natural_full_join
from verbatim.operators.lookup import gazetteer_states, lookup_left, lookup_state
from verbatim.operators.reshape import select_prefix, unpivot_responses
from verbatim.operators.views import questions_matching, response_view
from verbatim.operators.audit import question_dimension
from verbatim.plans.panels import PROVIDER_RULES
from verbatim.plans.publish import Published
from verbatim.plans.reports import attach_questions
from verbatim.plans.text_index import TextIndex
from verbatim.plans.wave_counts import WaveCounts
from verbatim.session import checkpoint_dir
from verbatim.sources.gazetteer import read_gazetteer_checked
from verbatim.sources.menu import menu_questions, read_menu
from verbatim.sources.stopwords import ENGLISH_STOP_WORDS, stop_words
from verbatim.sources.waves import read_waves

# Fixed values of the stand-in panel configuration.
SV_QUESTIONS = tuple(f"src{i}" for i in range(20))
SV_LANGUAGE = {"en": "English", "es": "Spanish"}
SV_LABELS = {"quality": {0: "low", 1: "high"}, "toxic": {0: "no", 1: "yes"}}
PARTIAL_LABELS = {"quality": {1: "high"}, "toxic": {0: "clean", 1: "toxic"}}
ROLES = ("assistant", "system", "user")
YEARS = tuple(range(1995, 2002))
FLAG_NUMBERS = (1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13)
QUESTION_PATTERN = "^src1[0-9]?$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor sees, for queries that write and read back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/verbatim-tables/{name}-{uuid.uuid4().hex}"


def responses(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("question"), F.col("text").alias("response"))


def few_splits(scan: DataFrame) -> int | None:
    """Partitions to deal a scan out to before tokenising, or None if the scan itself has as
    many splits as there are cores (the case for any large table)."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return 2 * cores if scan.rdd.getNumPartitions() < cores else None


def _network(spark, d, **options):
    answers = responses(spark, d)
    return bigram_network(answers, partitions=few_splits(answers), **options)


# ---------------------------------------------------------------- bigram network
def bigram_network_edges(spark, d):
    return _network(spark, d).edges


def bigram_network_vertices(spark, d):
    return _network(spark, d).vertices


def bigram_counts(spark, d):
    return _network(spark, d).counts


def bigram_edges_by_wave(spark, d):
    """A1/A2 from mergeable counts: one wave a language, one of them corrected later."""
    answers = table(spark, d, "documents").select("lang", F.col("source").alias("question"), F.col("text").alias("response"))
    store, rest = WaveCounts(spark, shared_folder(spark, "wave-counts")), F.lit(True)
    store.add("en", answers.where("lang = 'de'"))
    for lang in ("de", "en", "fr"):
        store.add(lang, answers.where(F.col("lang") == lang))
        rest = rest & ~F.col("lang").eqNullSafe(lang)
    store.add("others", answers.where(rest))
    return store.network().edges


def bigram_sorted_counts(spark, d):
    """O2: counts in output order, each with its place among its question's."""
    place = Window.partitionBy("question").orderBy(F.desc("n"), "word1", "word2")
    return sort_counts(_network(spark, d).counts.withColumn("place", F.row_number().over(place)))


def bigram_thresholds(spark, d):
    return _network(spark, d).cuts


def bigram_counts_stop_table(spark, d):
    """Stop words given as a table: two broadcast left-anti joins instead of ``InSet``."""
    table_words = stop_words(spark, ENGLISH_STOP_WORDS)
    return _network(spark, d, stop=table_words).counts


def bigram_tokens(spark, d):
    answers = responses(spark, d)
    return bigram_occurrences(answers, keep=["doc_id"], partitions=few_splits(answers))


def unicode_word_counts(spark, d):
    """Words by the Unicode rules, counted by question."""
    return count_unicode_words(responses(spark, d), "question", "response")


# ---------------------------------------------------------------- panel stand-in
def sv_panel(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(
        (F.col("doc_id") % 100).alias("respondent_id"),
        F.expr("doc_id div 100").alias("wave"),
        "doc_id",
        F.col("source").alias("question"),
        F.col("text").alias("response"),
        recode_map(F.col("lang"), SV_LANGUAGE).alias("language"),
        "quality", "toxic",
        F.when(F.col("toxic") == 1, 0).otherwise(1).alias("consent"))


def panel_fill_forward(spark, d):
    sv = sv_panel(spark, d).where(F.col("consent") == 1)
    sv = decode_values(sv, SV_LABELS, exclude=["respondent_id"])
    out = fill_forward(sv, "respondent_id", "wave", ["language", "quality", "toxic"],
                       tiebreak="doc_id")
    return out.select("respondent_id", "wave", "doc_id", "question", "response",
                      "language", "quality", "toxic")


def panel_language_filter(spark, d):
    """keep English-coded rows before the gate and the fill (earlier drivers)."""
    docs = table(spark, d, "documents").where(F.col("lang").isin("en"))
    labels = table(spark, d, "labels")
    sv = docs.join(labels, "doc_id", "left").select(
        (F.col("doc_id") % 100).alias("respondent_id"), F.expr("doc_id div 100").alias("wave"),
        "doc_id", F.col("source").alias("question"), F.col("text").alias("response"),
        "quality", "toxic", F.when(F.col("toxic") == 1, 0).otherwise(1).alias("consent"))
    sv = decode_values(sv.where(F.col("consent") == 1), SV_LABELS, exclude=["respondent_id"])
    out = fill_forward(sv, "respondent_id", "wave", ["quality", "toxic"], tiebreak="doc_id")
    return out.select("respondent_id", "wave", "doc_id", "question", "quality", "toxic")


def _known(df: DataFrame, column: str, values) -> DataFrame:
    """``df``, after a check that no row has another value: a wide layout would lose it."""
    stray = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values))).limit(1).collect()
    if stray:
        raise ValueError(f"{column} {stray[0][column]!r} is not among the configured values")
    return df


def sv_wide(spark, d) -> DataFrame:
    """One row per (respondent, wave) with one text column per question."""
    sv = _known(sv_panel(spark, d), "question", SV_QUESTIONS)
    qcols = [F.when(F.col("question") == q, F.col("response")).alias(q) for q in SV_QUESTIONS]
    return sv.select("respondent_id", "wave", "consent", "language", "quality", "toxic", *qcols)


def panel_response_table(spark, d):
    """Entry 1 on the wide stand-in: gate → decode → fill → unpivot → non-empty."""
    wide = sv_wide(spark, d).where(F.col("consent") == 1)
    wide = decode_values(wide, SV_LABELS, exclude=["respondent_id"])
    # (respondent_id, wave) is unique here (a bijection of doc_id): no tie-break needed
    wide = fill_forward(wide, "respondent_id", "wave", ["language", "quality", "toxic"],
                        tiebreak=())
    return unpivot_responses(wide.drop("consent"),
                             ["respondent_id", "wave", "language", "quality", "toxic"],
                             list(SV_QUESTIONS))


def panel_bigram_edges(spark, d):
    """Entry 1 then Entry 2: the bigram network of every question of the long table.

    The network needs no demographics, so the gated answers are taken without the fill."""
    long = sv_panel(spark, d).where(F.col("consent") == 1).select("question", "response")
    return bigram_network(long, partitions=few_splits(table(spark, d, "documents"))).edges


def event_fill_forward(spark, d):
    ev = table(spark, d, "events").select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"),
        F.when(F.col("event_type") == "signup", F.col("event_id")).alias("last_signup_event"))
    out = fill_forward(ev, "user_id", "ts", ["last_purchase", "last_signup_event"],
                       tiebreak="event_id")
    return out.select("event_id", "user_id", "event_type", "last_purchase", "last_signup_event")


def event_fill_forward_skewed(spark, d):
    """Same fill, but every page view is booked to one catch-all user (id -1), so a
    single key holds about a fifth of all rows: exercises the hot-key split."""
    ev = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit(-1).cast("bigint"))
         .otherwise(F.col("user_id")).alias("user_id"),
        "ts", "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"),
        F.when(F.col("event_type") == "signup", F.col("event_id")).alias("last_signup_event"))
    out = fill_forward(ev, "user_id", "ts", ["last_purchase", "last_signup_event"],
                       tiebreak="event_id", hot_min_rows=0)
    return out.select("event_id", "user_id", "event_type", "last_purchase", "last_signup_event")


# ---------------------------------------------------------------- reshape
def unpivot_codes(spark, d):
    return unpivot_responses(table(spark, d, "labels"), ["doc_id"], ["quality", "toxic"])


def unpivot_text(spark, d):
    conv = table(spark, d, "conversations")
    roles = list(ROLES)
    wide = _known(conv, "role", roles).select("conv_id", "turn",
                       *[F.when(F.col("role") == r, F.col("text")).alias(r) for r in roles])
    return unpivot_responses(wide, ["conv_id", "turn"], roles)


# ---------------------------------------------------------------- waves
def _orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def wave_full_join(spark, d):
    o = _orders(spark, d)
    base = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    a = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("date")).select(*base, "o_orderstatus")
    b = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")).select(*base, "o_orderpriority")
    return natural_full_join(a, b)


def _yearly_waves(spark, d) -> list[DataFrame]:
    """One wave a year, each a date range that reaches the scan; together all rows.  Rows
    without a date are in the first and belong to no year, so they have no year's column."""
    o = table(spark, d, "orders")
    when, kind = F.col("o_orderdate"), o.schema["o_orderdate"].dataType
    base = ["o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"]
    waves = []
    for y in YEARS:
        after = when >= F.lit(f"{y}-01-01 00:00:00").cast(kind) if y > YEARS[0] else F.lit(True)
        before = when < F.lit(f"{y + 1}-01-01 00:00:00").cast(kind) if y < YEARS[-1] else F.lit(True)
        own = F.col("o_orderstatus" if y % 2 else "o_orderpriority")
        if y == YEARS[0]:
            before, own = before | when.isNull(), F.when(when.isNotNull(), own).alias("o_orderstatus" if y % 2 else "o_orderpriority")
        waves.append(o.where(after & before).select(*base, own))
    return waves


def wave_fold(spark, d):
    return fold_waves(_yearly_waves(spark, d))


def wave_stack(spark, d):
    return fold_waves(_yearly_waves(spark, d), disjoint_on="o_orderdate")


def wave_files(spark, d):
    """The yearly waves as files with dotted column names, read back and folded."""
    folder, paths = shared_folder(spark, "waves"), {}
    for i, wave in enumerate(_yearly_waves(spark, d)):
        paths[f"wave{i}"] = f"{folder}/orders_{YEARS[i]}.parquet"
        wave.toDF(*[c.replace("_", ".", 1) for c in wave.columns]).write.parquet(paths[f"wave{i}"])
    return fold_waves(list(read_waves(spark, paths).values()))


def _mixed_waves(spark, d) -> list[DataFrame]:
    """Orders of three periods counted by customer, urgency and priority; the customer is an
    int, a double and a text, urgency a boolean, an int and a double.  Rows without a date are
    in the first."""
    o = table(spark, d, "orders")
    year, urgent = F.year("o_orderdate"), F.col("o_orderpriority").startswith("1")
    periods = [("early", (year < 1995) | year.isNull(), "int", "boolean"), ("middle", (year >= 1995) & (year < 1998), "double", "int"),
               ("late", year >= 1998, "string", "double")]
    return [o.where(when).groupBy(F.col("o_custkey").cast(id_type).alias("customer"), urgent.cast("int").cast(flag_type).alias("urgent"),
                                  F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias(f"n_{name}")) for name, when, id_type, flag_type in periods]


def wave_mixed_types(spark, d):
    """J1/J2 where a shared key changes type from wave to wave."""
    return fold_waves(_mixed_waves(spark, d))


# ---------------------------------------------------------------- enrich
def zip_normalise(spark, d):
    c = table(spark, d, "customer")
    raw = F.col("c_custkey").cast("string")
    return c.select("c_custkey", raw.alias("zip_raw"), normalize_zip(raw).alias("zip"))


def _customer_zips(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(
        "c_custkey", normalize_zip(F.col("c_custkey").cast("string")).alias("zip"))


def _order_gazetteer(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("zip"),
                                            F.col("o_orderpriority").alias("State"))


def zip_lookup(spark, d):
    gazetteer = _order_gazetteer(spark, d)
    return lookup_state(_customer_zips(spark, d), gazetteer_states(gazetteer), gazetteer=gazetteer)


def zip_lookup_parity(spark, d):
    return lookup_state(_customer_zips(spark, d),
                        gazetteer_states(_order_gazetteer(spark, d), dedupe=False))


def lookup_left_supplier(spark, d):
    """Customers and the supplier with their number; there are fewer suppliers."""
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return lookup_left(c, supplier, "c_custkey", max_broadcast_rows=100_000)


def _flags(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    flags = {f"f_{k}": F.when(F.col("p_size") <= k, F.lit(None).cast("int"))
             .otherwise(((F.col("p_partkey") + k) % 3 == 0).cast("int")) for k in FLAG_NUMBERS}
    return p.select("p_partkey", "p_size", *[v.alias(k) for k, v in flags.items()])


def flag_priority(spark, d):
    p = _flags(spark, d)
    rules = [(label, [F.col(f"f_{k}") for k in ks]) for label, ks in PROVIDER_RULES]
    count = F.when(F.col("p_size") > 45, F.lit(None).cast("int")).otherwise(F.col("p_size") - 25)
    return p.select("p_partkey", first_true(rules).alias("provider_type"),
                    child_flag(count).alias("child_0_3"))


def label_decode(spark, d):
    return decode_values(table(spark, d, "labels"), PARTIAL_LABELS, exclude=["doc_id"])


def label_decode_double(spark, d):
    """Codes held as doubles, some fractional, against a codebook table."""
    doc = table(spark, d, "labels").select("doc_id", (F.col("quality") + F.col("toxic") / 2).alias("quality"),
                                           F.col("toxic").cast("double").alias("toxic"))
    rows = [(v, str(c), l) for v, m in SV_LABELS.items() for c, l in m.items()]
    book = spark.createDataFrame(rows, "variable string, code string, label string")
    return decode_values(doc, book, exclude=["doc_id"])


def label_decode_schema(spark, d):
    """Value labels attached to the columns, written, read back, renamed and decoded
    without a codebook."""
    path = f"{shared_folder(spark, 'labelled')}/labels.parquet"
    with_attributes(table(spark, d, "labels"), {"quality": "How good is it?"}, PARTIAL_LABELS).write.parquet(path)
    read = spark.read.parquet(path).withColumnsRenamed({"quality": "rating", "toxic": "harmful"}).select("harmful", "doc_id", "rating")
    return decode_labelled(read.where(F.col("doc_id").isNotNull()))


def question_texts_schema(spark, d):
    """Question texts read off the wide table's columns, beside each question's answers."""
    wide = with_attributes(sv_wide(spark, d).select(*SV_QUESTIONS), {q: f"What about {q}?" for q in SV_QUESTIONS})
    texts = {q: t for q, t in question_texts(wide).items()}
    answers = unpivot_responses(wide, [], list(SV_QUESTIONS)).groupBy("question").agg(F.count("*").alias("n"))
    return attach_questions(answers, question_dimension(spark, "sv", list(SV_QUESTIONS), texts)).select("question", "question_num", "question_text", "n")


def gazetteer_quarantine(spark, d):
    """Customers as a gazetteer file in which some lines lack a field, have one more or hold a
    text for a number: the good rows, and the bad ones counted."""
    c, path = table(spark, d, "customer"), shared_folder(spark, "gazetteer")
    key, kind = F.col("c_custkey"), F.col("c_custkey") % 10
    columns = [F.lit("US"), key, "c_name", "c_mktsegment", "c_mktsegment", F.lit(""), F.lit(""), F.lit(""), F.lit(""),
               F.when(kind == 7, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")), "c_acctbal"]
    line = F.concat_ws("\t", *columns)
    line = F.when(kind == 3, line).when(kind == 5, F.concat(line, F.lit("\t4\t"))).otherwise(F.concat(line, F.lit("\t"), "c_nationkey"))
    c.select(line.alias("value")).write.text(path)
    read = read_gazetteer_checked(spark, path)
    good = read.good.select(F.lit("good").alias("kind"), "zip", "PlaceName", "State", "longitude", "accuracy", F.lit(1).cast("long").alias("n"))
    none = [F.lit(None).cast(t) for t in ("string", "string", "string", "double", "int")]
    return good.union(read.counts().groupBy("reason").agg(F.sum("n").alias("n")).select("reason", *none, "n"))


def prefix_projection(spark, d):
    c = select_prefix(table(spark, d, "customer"), "C_")
    return c.drop("c_acctbal").withColumnsRenamed({"c_name": "customer_name"})


def restricted_enrich(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return lookup_left(docs, table(spark, d, "labels"), "doc_id")


# ---------------------------------------------------------------- views and catalog
def question_regex(spark, d):
    return questions_matching(responses(spark, d), QUESTION_PATTERN).select("doc_id", "question")


def response_view_page(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("question"), "lang", "n_chars",
        F.col("text").alias("response"))
    return response_view(docs, question="src3",
                         filters={"lang": ("in", ["en", "es"]), "n_chars": ("range", 100, None)},
                         search="the", order_by=[("n_chars", False), ("doc_id", True)],
                         page=1, page_size=10)


def response_view_contains(spark, d):
    """the case-insensitive text filter, all pages."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.col("source").alias("question"), F.col("text").alias("response"))
    return response_view(docs, question="src3", filters={"response": ("contains", "Ing"), "lang": ("in", ["en", "de"])},
                         order_by=[("doc_id", True)], page_size=None)


def response_search_indexed(spark, d):
    """All answers that contain a string, by the index of n-grams."""
    index = TextIndex(spark, shared_folder(spark, "text-index"))
    docs = table(spark, d, "documents").select("doc_id", "lang", F.col("source").alias("question"), F.col("text").alias("response"))
    index.build(docs, cluster_by=["lang", "doc_id"], rows_per_file=20)
    return index.search("PassWord").select("doc_id", "question", "response")


def wave_full_join_keys(spark, d):
    """J1 on few values, so that key tuples repeat on both sides and NULLs meet NULLs."""
    c = table(spark, d, "customer")
    none = F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    side = c.select(none.alias("segment"), "c_nationkey", F.floor(F.col("c_custkey") / 50).alias("block"))
    a = side.where("c_nationkey < 15").groupBy("segment", "c_nationkey").agg(F.count("*").alias("left_rows"), F.max("block").alias("left_block"))
    b = side.where("c_nationkey >= 5").select("segment", "c_nationkey", F.col("block").alias("right_block"))
    return natural_full_join(a, b, hot_min_rows=0)


def _doc_questions(spark, d) -> DataFrame:
    return number_questions(table(spark, d, "documents").select(F.col("source").alias("code")),
                            "docs")


def question_index_docs(spark, d):
    q = _doc_questions(spark, d).withColumn("text", F.lit(None).cast("string"))
    return question_index(q)


def responses_by_question(spark, d):
    """Responses keyed by the configured question list (page number by code)."""
    docs = table(spark, d, "documents")
    texts = docs.groupBy(F.col("source").alias("variable")).agg(
        F.concat(F.lit("Answers since "), F.min("doc_id")).alias("label")).withColumn("panel", F.lit("docs"))
    q = question_dimension(spark, "docs", list(SV_QUESTIONS), texts)
    return attach_questions(responses(spark, d), q).select(
        "doc_id", "question", "panel", "question_num", "question_text", "title")


def published_page(spark, d):
    """K1/K2: edges and responses published twice; one question's page read back."""
    docs = responses(spark, d)
    q = question_dimension(spark, "docs", list(SV_QUESTIONS))
    pages = Published(spark, shared_folder(spark, "pages"))
    for long in (docs.where("question <> 'src3'"), docs):  # the second takes the first one's place
        with pages.refresh("docs") as new:
            new.write("responses", attach_questions(long, q))
            net = bigram_network(new.read("responses").select("question", "response"), questions=list(SV_QUESTIONS), partitions=few_splits(docs))
            new.write("edges", attach_questions(net.edges, q))
    number = SV_QUESTIONS.index("src3") + 1
    none = F.lit(None)
    edges = pages.page("edges", "docs", number).select("title", "word1", "word2", "n", none.cast("long").alias("doc_id"))
    answers = pages.page("responses", "docs", number).select("title", none.cast("string"), none.cast("string"), none.cast("long"), "doc_id")
    return edges.union(answers)


def question_code_numbers(spark, d):
    """The number inside each question code."""
    codes = table(spark, d, "documents").select(F.col("source").alias("question")).distinct()
    return codes.select("question", code_number(F.col("question")).alias("code_num"))


def derived_menu(questions: DataFrame) -> DataFrame:
    """A menu built from the question list with one drift of each kind."""
    m = questions.select("panel", "num", "code",
                         F.explode(F.array(F.lit("bigram"), F.lit("responses"))).alias("section_view"))
    m = m.where(F.col("num") != 3)
    num, view = F.col("num"), F.col("section_view")
    return m.select(
        "panel", "section_view",
        F.when(num == 5, F.concat(F.col("code"), F.lit(".1"))).otherwise(F.col("code")).alias("code"),
        F.when((num == 9) & (view == "responses"), F.lit("bigram")).otherwise(view).alias("href_view"),
        F.when((num == 7) & (view == "bigram"), num + 1)
         .when((num == 1) & (view == "responses"), F.lit(0))
         .when((num == 13) & (view == "responses"), F.lit(None)).otherwise(num).alias("page_num"),
        F.when((num == 11) & (view == "bigram"), F.lit("other"))
         .when((num == 12) & (view == "bigram"), F.lit(None)).otherwise(F.col("panel")).alias("href_panel"))


def catalog_audit_docs(spark, d):
    q = _doc_questions(spark, d)
    return catalog_audit(derived_menu(q), q)


def nested_menu_audit(spark, d):
    """The menu as one nested document (section, module, entry), read and audited.

    A menu has an entry for each question and view, so gathering it is no matter of scale."""
    q = _doc_questions(spark, d)
    flat = derived_menu(q)
    page = F.concat_ws("_", F.coalesce("href_panel", F.lit("")), "href_view", F.coalesce(F.col("page_num").cast("string"), F.lit("")))
    entry = F.struct(F.concat("code", F.lit(": What?")).alias("text"), F.concat(page, F.lit(".html")).alias("href"))
    module = flat.groupBy("section_view", (F.length("code") > 4).alias("long")).agg(F.collect_list(entry).alias("menu"))
    item = F.struct(F.when(F.col("long"), "Long codes").otherwise("Short codes").alias("text"), "menu")
    sections = module.groupBy("section_view").agg(F.collect_list(item).alias("menu"))
    left = sections.agg(F.collect_list(F.struct(F.concat(F.lit("Docs "), "section_view").alias("text"), "menu")).alias("left"))
    path = shared_folder(spark, "menu")
    left.select(F.struct("left").alias("navbar")).write.json(path)
    return catalog_audit(menu_questions(read_menu(spark, path, panels={"Docs": "docs"})), q)


QUERIES = {
    "bigram_network_edges": bigram_network_edges,
    "bigram_network_vertices": bigram_network_vertices,
    "bigram_counts": bigram_counts,
    "bigram_edges_by_wave": bigram_edges_by_wave,
    "bigram_sorted_counts": bigram_sorted_counts,
    "bigram_thresholds": bigram_thresholds,
    "bigram_tokens": bigram_tokens,
    "unicode_word_counts": unicode_word_counts,
    "bigram_counts_stop_table": bigram_counts_stop_table,
    "panel_fill_forward": panel_fill_forward,
    "panel_response_table": panel_response_table,
    "panel_language_filter": panel_language_filter,
    "panel_bigram_edges": panel_bigram_edges,
    "event_fill_forward": event_fill_forward,
    "event_fill_forward_skewed": event_fill_forward_skewed,
    "unpivot_codes": unpivot_codes,
    "unpivot_text": unpivot_text,
    "wave_full_join": wave_full_join,
    "wave_full_join_keys": wave_full_join_keys,
    "wave_fold": wave_fold,
    "wave_stack": wave_stack,
    "wave_mixed_types": wave_mixed_types,
    "wave_files": wave_files,
    "zip_normalise": zip_normalise,
    "zip_lookup": zip_lookup,
    "zip_lookup_parity": zip_lookup_parity,
    "lookup_left": lookup_left_supplier,
    "flag_priority": flag_priority,
    "label_decode": label_decode,
    "label_decode_double": label_decode_double,
    "label_decode_schema": label_decode_schema,
    "question_texts_schema": question_texts_schema,
    "gazetteer_quarantine": gazetteer_quarantine,
    "prefix_projection": prefix_projection,
    "restricted_enrich": restricted_enrich,
    "question_regex": question_regex,
    "response_view": response_view_page,
    "response_view_contains": response_view_contains,
    "response_search_indexed": response_search_indexed,
    "question_index": question_index_docs,
    "catalog_audit": catalog_audit_docs,
    "nested_menu_audit": nested_menu_audit,
    "responses_by_question": responses_by_question,
    "question_code_numbers": question_code_numbers,
    "published_page": published_page,
}
