"""Hot keys: the skew-safe paths must equal the plain plans exactly."""

from collections import Counter

from pyspark.sql import functions as F

from verbatim.operators.bigrams import bigram_occurrences, count_bigrams
from verbatim.operators.harmonize import hot_join_keys, natural_full_join


def _frames(spark):
    left = ([("k1", 1, "a")] * 300 + [("k1", 1, f"x{i}") for i in range(200)]
            + [("k2", 2, "b"), (None, 3, "n"), ("k3", 4, "only-left")]
            + [("k4", 5, "hot-left-only")] * 400)
    right = ([("k1", 1, "r1"), ("k1", 1, "r2"), ("k1", 1, "r2"), ("k2", 2, "c"), (None, 3, "m"),
              ("k5", 6, "only-right")] + [("k6", 7, f"hr{i}") for i in range(350)])
    return (spark.createDataFrame(left, "id string, week int, lv string"),
            spark.createDataFrame(right, "id string, week int, rv string"))


def test_hot_keys_found(spark):
    l, r = _frames(spark)
    hot = hot_join_keys(l, r, ["id", "week"], 8)
    assert sorted(x.id for x in hot.collect()) == ["k1", "k4", "k6"]


def test_natural_join_hot_equals_plain(spark):
    l, r = _frames(spark)
    for kw in ({}, {"keys": ["id"]}):
        a = natural_full_join(l, r, num_partitions=8, hot_min_rows=0, **kw)
        b = natural_full_join(l, r, split_hot_keys=False, **kw)
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    # 500 k1 rows on the left × 3 on the right
    assert natural_full_join(l, r, num_partitions=8, hot_min_rows=0).where(F.col("id") == "k1").count() == 1500


def test_hot_question_counts(spark):
    # one question with most of the text: partial aggregation keeps the counts exact
    rows = [("q1", "red fox jumps high")] * 500 + [("q2", "blue fox")]
    df = spark.createDataFrame(rows, "question string, response string")
    counts = {(r.question, r.word1, r.word2): r.n
              for r in count_bigrams(bigram_occurrences(df)).collect()}
    assert counts[("q1", "red", "fox")] == 500 and counts[("q2", "blue", "fox")] == 1


def test_fill_fallback_for_string_order(spark):
    from verbatim.operators.fill import fill_forward
    rows = [("a", f"w{i:04d}", i, ("v%d" % i) if i % 13 == 0 else None) for i in range(300)]
    rows += [("b", "w0001", 900, "b"), ("b", None, 901, None)]
    df = spark.createDataFrame(rows, "id string, wk string, tb int, v string")
    split = fill_forward(df, "id", "wk", ["v"], tiebreak="tb", num_partitions=8, hot_min_rows=0)
    plain = fill_forward(df, "id", "wk", ["v"], tiebreak="tb", split_hot_keys=False)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_fill_chunked_with_null_orders_and_keys(spark):
    from verbatim.operators.fill import fill_forward
    rows = [(None if i % 50 == 0 else "h", None if i % 7 == 0 else i // 4, i,
             ("x%d" % i) if i % 11 == 0 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, week int, tb int, v string")
    split = fill_forward(df, "id", "week", ["v"], tiebreak="tb", num_partitions=8, hot_min_rows=0)
    plain = fill_forward(df, "id", "week", ["v"], tiebreak="tb", split_hot_keys=False)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_fill_unique_order_without_tiebreak(spark):
    from verbatim.operators.fill import fill_forward
    rows = [("h" if i % 3 else f"k{i}", i, ("v%d" % i) if i % 5 == 0 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, week int, v string")
    for split in (True, False):
        a = fill_forward(df, "id", "week", ["v"], tiebreak=(), split_hot_keys=split, num_partitions=8, hot_min_rows=0)
        b = fill_forward(df, "id", "week", ["v"], split_hot_keys=False)
        assert a.columns == b.columns == ["id", "week", "v"]
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_fold_with_hot_tuple_equals_plain(spark):
    from verbatim.operators.harmonize import fold_waves
    w1 = spark.createDataFrame([("h", 1, "a")] * 200 + [("x", 1, "b")], "id string, week int, s1 string")
    w2 = spark.createDataFrame([("h", 1, "c")] * 3 + [("y", 2, "d")], "id string, week int, s2 string")
    w3 = spark.createDataFrame([("h", 1, "a", "c")] * 2 + [("z", 3, "e", "f")],
                               "id string, week int, s1 string, s2 string")
    a = fold_waves([w1, w2, w3], num_partitions=4, hot_min_rows=0)
    b = fold_waves([w1, w2, w3], split_hot_keys=False)
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where("id = 'h'").count() == 200 * 3 * 2


def test_fold_joins_only_tuples_met_again(spark):
    from verbatim.operators.harmonize import _met_again, fold_waves
    filler = [(f"u{i}", i, "p") for i in range(400)] + [(None, None, "q")]
    w1 = spark.createDataFrame([("h", 1, "a")] * 12 + filler, "id string, week int, s1 string")
    w2 = spark.createDataFrame([("h", 1, "b")] * 12 + [(None, None, "r")], "id string, week int, s2 string")
    assert _met_again([w1, w2], ["id", "week"]).count() == 2
    for floor in (0, 10**6):
        a = fold_waves([w1, w2], num_partitions=4, hot_min_rows=floor)
        b = natural_full_join(w1, w2, split_hot_keys=False)
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where("id = 'h'").count() == 144


def test_hot_duplicates_expand_in_blocks(spark):
    # 60,000 x 60,000 equal rows: more copies than one array can hold
    w1 = spark.range(60_000).selectExpr("'h' AS id", "1 AS week", "'a' AS s1")
    w2 = spark.range(60_000).selectExpr("'h' AS id", "1 AS week", "'b' AS s2")
    out = natural_full_join(w1, w2, num_partitions=8, hot_min_rows=0)
    assert out.limit(200_000).count() == 200_000


def test_columns_differing_in_case(spark):
    import pytest
    from verbatim.operators.harmonize import fold_waves
    a = spark.createDataFrame([("x", 1)], "id string, `FPL_Curr` int")
    b = spark.createDataFrame([("x", 1)], "id string, `FPL_CURR` int")
    with pytest.raises(ValueError, match="differ only in case"):
        fold_waves([a, b])


def test_fill_coarse_order_is_cut_by_the_tie_break(spark):
    from verbatim.operators.fill import _dealt, _hot_keys, fill_forward
    # a catch-all respondent with most rows and three weeks
    df = spark.range(64_000).selectExpr(
        "CASE WHEN id % 5 < 4 THEN 'h' ELSE concat('k', id) END AS id", "int(id % 3) AS week", "id AS tb",
        "CASE WHEN id % 17 = 0 THEN concat('v', id) END AS v")
    hot, parts = _hot_keys(df, ["id"], 64, 0)
    assert [r[0] for r in hot.collect()] == ["h"] and parts >= 32
    dealt = _dealt(df.where("id = 'h'"), ["id"], [F.col("week").asc_nulls_last(), F.col("tb").asc_nulls_last()], parts)
    rows = sorted((r.week, r.tb, r["__c"]) for r in dealt.collect())
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)  # ranges of the full order
    assert max(Counter(r[2] for r in rows).values()) <= 3 * 64_000 // 64
    split = fill_forward(df, "id", "week", ["v"], tiebreak="tb", num_partitions=64, hot_min_rows=0)
    plain = fill_forward(df, "id", "week", ["v"], tiebreak="tb", split_hot_keys=False)
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_fill_over_2000_ranges(spark):
    """The skewed query dealt out to 2,000 ranges: same rows as one window, and no row meets a list of boundaries."""
    from verbatim.operators.fill import fill_forward
    from verbatim.plans.testdata import event_fill_forward_skewed
    from oracle_harness import compare, duck
    from paths import SF_SMALL
    from verbatim.plans.oracle import ORACLE_SQL
    df = spark.range(12_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(-1)).alias("id"), F.pmod(F.xxhash64("id"), F.lit(9)).alias("week"), F.col("id").alias("tb"),
        F.when(F.col("id") % 11 == 3, F.col("id")).alias("v"), F.when(F.col("id") % 5003 == 9, F.lit("rare")).alias("w"))
    split = fill_forward(df, "id", "week", ["v", "w"], tiebreak="tb", num_partitions=2000, hot_min_rows=0)
    plain = fill_forward(df, "id", "week", ["v", "w"], tiebreak="tb", split_hot_keys=False)
    assert split.exceptAll(plain).isEmpty() and split.count() == 12_000
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "lambda" not in plan
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        r = compare(spark, event_fill_forward_skewed, ORACLE_SQL["event_fill_forward_skewed"], SF_SMALL, duck(SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert r["ok"], r
