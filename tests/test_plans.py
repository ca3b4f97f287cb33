"""Plan shape: pushdown, no Python evaluation, shuffle counts."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF_SMALL
from verbatim.operators.fill import fill_forward
from verbatim.plans.testdata import responses
from verbatim.operators.bigrams import bigram_occurrences, count_bigrams


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_query(spark):
    for name, q in E.queries().items():
        if name in E.LLM_QUERIES:
            continue
        p = _plan(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_bigram_scan_prunes_and_tokenises_once(spark):
    counts = count_bigrams(bigram_occurrences(responses(spark, SF_SMALL)))
    p = _plan(counts)
    assert "ReadSchema: struct<text:string,source:string>" in p or "struct<text:string,source:string>" in p
    assert p.count("split(lower(") == 1
    assert "BroadcastHashJoin" not in p          # stop words are an InSet filter
    assert p.count("Exchange hashpartitioning") == 1


def test_fill_plain_path_single_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = fill_forward(ev, "user_id", "ts", ["value"], tiebreak="event_id", split_hot_keys=False)
    p = _plan(out)
    assert p.count("Exchange hashpartitioning") == 1
    assert "Window" in p


def test_gate_pushed_to_scan(spark, tmpdir_fresh):
    """The gate of build_response_table reaches the scan of the wave file."""
    from verbatim.plans.panels import CC
    from verbatim.plans.response_table import build_response_table
    flags = ", ".join(f"CC_DEMO_013_{k} int" for k in range(1, 14))
    schema = (f"ProviderID string, Week int, UserLanguage string, CC_DEMO_001 string, {flags}, "
              "CC_OPEN_007 int, FPL_2019_150 int, RaceGroup int, CC_OPEN_001 string")
    row = ("p1", 3, "EN", "30301", *([None] * 13), 1, 1, 1, "words")
    spark.createDataFrame([row], schema).write.parquet(f"{tmpdir_fresh}/w")
    long = build_response_table(spark.read.parquet(f"{tmpdir_fresh}/w"), CC, allow_missing=True,
                                split_hot_keys=False)
    assert "EqualTo(CC_OPEN_007,1)" in _plan(long)


def test_partitions_deal_out_only_the_columns_used(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumnsRenamed(
        {"source": "question", "text": "response"})
    occ = bigram_occurrences(docs, partitions=12)
    assert occ.rdd.getNumPartitions() == 12
    assert "ReadSchema: struct<response:string,question:string>" in _plan(occ) or "struct<text:string,source:string>" in _plan(occ)


def test_stop_word_table_uses_broadcast_anti_joins(spark):
    from verbatim.sources.stopwords import ENGLISH_STOP_WORDS, stop_words
    occ = bigram_occurrences(responses(spark, SF_SMALL),
                             stop=stop_words(spark, ENGLISH_STOP_WORDS))
    p = _plan(occ)
    import re
    assert len(re.findall(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], LeftAnti", p)) == 2


def test_bounded_broadcast_falls_back_past_the_bound(spark):
    from verbatim.operators.broadcast import bounded_broadcast
    dim = spark.range(50).withColumnRenamed("id", "k")
    assert bounded_broadcast(dim, 100) is not dim          # hinted copy
    assert bounded_broadcast(dim, 10) is dim               # unchanged: no hint
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).withColumnRenamed("id", "k")
        p = _plan(fact.join(bounded_broadcast(dim, 10), "k"))
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        p = _plan(fact.join(bounded_broadcast(dim, 100), "k"))
        assert "BroadcastHashJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_select_prefix_case(spark):
    from verbatim.operators.reshape import select_prefix
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, OPEN_001 string, open_x string, MH_1 string")
    assert select_prefix(df, "OPEN", keep=["id"]).columns == ["id", "OPEN_001", "open_x"]
    assert select_prefix(df, "OPEN", ignore_case=False).columns == ["OPEN_001"]


def test_sink_uses_rebalance_exchange(spark, tmpdir_fresh):
    df = spark.createDataFrame([("ec", 1, "x")], "panel string, question_num int, v string")
    from verbatim.plans import sinks
    seen = []
    kind = type(df)
    real = kind.hint
    kind.hint = lambda self, *a: seen.append(real(self, *a)) or seen[-1]
    try:
        sinks.write_partitioned(df, f"{tmpdir_fresh}/out", ["ec"])
    finally:
        kind.hint = real
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(seen[0])
