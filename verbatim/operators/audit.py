"""Question dimension and catalog reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.functions.keys import index_line, page_key, page_title
from verbatim.operators.broadcast import bounded_broadcast
from verbatim.session import cut_lineage

MAX_VARIABLES = 200_000

VIEWS = ("bigram", "responses")


def question_dimension(spark: SparkSession, panel: str, codes: Sequence[str],
                       texts: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """``questions(panel, num, code, text)``; ``num`` is the position in ``codes``.

    Q2: codes must be unique — numbering is derived, never typed in separately.
    ``texts`` may be the ``variable_labels`` table (joined on code).
    """
    if len(set(codes)) != len(codes):
        dup = sorted({c for c in codes if list(codes).count(c) > 1})
        raise ValueError(f"duplicate question codes: {dup}")
    rows = [(panel, i + 1, c) for i, c in enumerate(codes)]
    q = spark.createDataFrame(rows, "panel string, num int, code string")
    if texts is None:
        return q.withColumn("text", F.lit(None).cast("string"))
    if isinstance(texts, DataFrame):
        t = (texts.where(F.col("panel") == panel)
             .select(F.col("variable").alias("code"), F.col("label").alias("text")))
        t = bounded_broadcast(t.dropDuplicates(["code"]), MAX_VARIABLES)
        return q.join(t, "code", "left").select("panel", "num", "code", "text")
    return q.withColumn("text", F.create_map(*[x for k, v in texts.items()
                                               for x in (F.lit(k), F.lit(v))])[F.col("code")])


def number_questions(codes: DataFrame, panel: str, code_col: str = "code", num_partitions: int | None = None) -> DataFrame:
    """Number distinct codes 1..N in code order (for question sets read from data), a NULL first.

    The codes are dealt out by ranges and sorted there; a code's number is its place in its range
    plus the rows of the ranges before, of which one count a range reaches the driver."""
    spark = codes.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = codes.select(F.col(code_col).alias("code")).distinct()
    placed = distinct.repartitionByRange(n, "code").sortWithinPartitions("code")
    # partition number above 33 bits, place in the partition below; written, so that it is one for all steps
    placed = cut_lineage(placed.withColumn("__at", F.monotonically_increasing_id()), "question-numbers")
    part = F.shiftright("__at", 33).alias("__part")
    counts = sorted((r["__part"], r["count"]) for r in placed.groupBy(part).count().collect())  # a row for each range
    offsets = list(zip([p for p, _ in counts], accumulate([c for _, c in counts], initial=0)))
    offsets = spark.createDataFrame(offsets, "__part long, __before long")
    rows = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    num = F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__before") + 1
    return rows.select(F.lit(panel).alias("panel"), num.cast("int").alias("num"), "code")


def question_index(questions: DataFrame) -> DataFrame:
    """K3/K4: the numbered index line and both page keys for every question."""
    return questions.select(
        "panel", "num", "code",
        index_line(F.col("num"), F.coalesce(F.col("text"), F.col("code"))).alias("index_line"),
        page_title(F.col("num")).alias("title"),
        page_key(F.col("panel"), F.lit("bigram"), F.col("num")).alias("bigram_page"),
        page_key(F.col("panel"), F.lit("responses"), F.col("num")).alias("responses_page"))


def catalog_audit(catalog: DataFrame, questions: DataFrame) -> DataFrame:
    """Q1: reconcile menu entries with the question list.

    ``catalog``: ``panel, section_view, code, href_view, page_num`` (one row per entry) and
    ``href_panel`` where the link names one.
    ``questions``: ``panel, num, code``.
    Result: ``panel, view, code, num, page_num, status`` with status one of
    ``ok / missing_in_menu / unknown_code / wrong_panel / wrong_page / wrong_view /
    page_out_of_range`` (first that applies, in that order of checks: unknown code, panel,
    range, view, page).  A link without a page number is out of range, one without a panel
    or view points to the wrong one.
    """
    expected = questions.select("panel", "num", "code",
                                F.explode(F.array(*[F.lit(v) for v in VIEWS])).alias("view"),
                                F.lit(True).alias("__e"))
    sizes = questions.groupBy("panel").agg(F.count(F.lit(1)).alias("n_questions"))
    menu = catalog.select("panel", F.col("section_view").alias("view"), "code",
                          "href_view", "page_num", F.lit(True).alias("__m"),
                          (F.col("href_panel") if "href_panel" in catalog.columns
                           else F.col("panel")).alias("href_panel"))
    j = menu.alias("m").join(expected.alias("e"), ["panel", "code", "view"], "full")
    j = j.join(sizes, "panel", "left")
    status = (F.when(F.col("__m").isNull(), "missing_in_menu")
              .when(F.col("__e").isNull(), "unknown_code")
              .when(~F.col("href_panel").eqNullSafe(F.col("panel")), "wrong_panel")
              .when(F.col("page_num").isNull() | (F.col("page_num") < 1) | (F.col("page_num") > F.col("n_questions")),
                    "page_out_of_range")
              .when(~F.col("href_view").eqNullSafe(F.col("view")), "wrong_view")
              .when(~F.col("page_num").eqNullSafe(F.col("num")), "wrong_page")
              .otherwise("ok"))
    return j.select("panel", "view", "code", "num", "page_num",
                    status.alias("status"))
