"""One micro fixture per semantic trap (FIXTURES §8)."""

from pyspark.sql import functions as F

from verbatim.functions.recode import child_flag, first_true, recode_map
from verbatim.functions.text import ngram_pairs, tokens
from verbatim.functions.zipcodes import normalize_zip
from verbatim.operators.audit import catalog_audit
from verbatim.operators.bigrams import bigram_occurrences, count_bigrams
from verbatim.operators.decode import decode_values
from verbatim.operators.fill import fill_forward
from verbatim.operators.harmonize import natural_full_join
from verbatim.operators.lookup import gazetteer_states, lookup_state
from verbatim.operators.reshape import unpivot_responses
from verbatim.operators.thresholds import PercentileRule, percentile_cuts, top_by_percentile
from verbatim.plans.panels import PROVIDER_RULES


def _fill(spark, rows, schema, cols, **kw):
    df = spark.createDataFrame(rows, schema)
    out = fill_forward(df, "id", "week", cols, tiebreak="tb", **kw)
    return [tuple(r) for r in out.orderBy("tb").select(*cols).collect()]


def test_fill_leading_null(spark):
    rows = [("a", 1, 1, None), ("a", 2, 2, "x"), ("a", 3, 3, None)]
    for split in (False, True):
        got = _fill(spark, rows, "id string, week int, tb int, v string", ["v"],
                    split_hot_keys=split)
        assert got == [(None,), ("x",), ("x",)]


def test_fill_hot_key_split_matches_window(spark):
    # one key holds every row; chunks of the range partitioning must hand values over
    rows = [("a", i // 3, i, ("v%d" % i) if i % 17 == 0 else None) for i in range(400)]
    rows += [("b", 1, 1000, "b1"), ("b", 2, 1001, None)]
    df = spark.createDataFrame(rows, "id string, week int, tb int, v string")
    split = fill_forward(df, "id", "week", ["v"], tiebreak="tb", num_partitions=8)
    plain = fill_forward(df, "id", "week", ["v"], tiebreak="tb", split_hot_keys=False)
    a = sorted(tuple(r) for r in split.collect())
    b = sorted(tuple(r) for r in plain.collect())
    assert a == b and len(a) == 402


def test_fill_gate_first(spark):
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 2, 1, None)],
                               "id string, week int, gate int, v string")
    gated = df.where(F.col("gate") == 1)
    out = fill_forward(gated, "id", "week", ["v"], split_hot_keys=False).collect()
    assert [r.v for r in out] == [None]


def test_fill_null_week_sorts_last(spark):
    got = _fill(spark, [("a", None, 1, None), ("a", 1, 2, "x")],
                "id string, week int, tb int, v string", ["v"])
    assert got == [("x",), ("x",)]  # the NULL-week row (tb=1) comes after week 1


def test_fill_unlabelled_code(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 9)], "id string, week int, c int")
    df = decode_values(df, {"c": {1: "Yes"}}, exclude=["id"])
    out = fill_forward(df, "id", "week", ["c"], split_hot_keys=False).orderBy("week")
    assert [r.c for r in out.collect()] == ["Yes", "Yes"]


def test_zip_lengths(spark):
    df = spark.createDataFrame([(z,) for z in ["1", "12", "123", "1234", "12345", "123456"]],
                               "z string")
    got = [r[0] for r in df.select(normalize_zip(F.col("z"))).collect()]
    assert got == [None, None, "00123", "01234", "12345", None]


def _gaz(spark, rows):
    return spark.createDataFrame(rows, "zip string, State string")


def test_zip_unpadded_survey_and_duplicates(spark):
    from verbatim.functions.zipcodes import zip_text
    survey = spark.createDataFrame([(1, 1234.0)], "id int, z double")
    gaz = _gaz(spark, [("01234", "MA"), ("1234", "MA"), ("01234", "CT")])
    raw = survey.withColumn("zip", zip_text(survey, "z"))
    # parity: the survey zip is not padded → no state
    parity = lookup_state(raw, gazetteer_states(gaz, dedupe=False)).collect()
    assert [r.State for r in parity] == [None]
    # default: both sides normalised, one State per zip
    fixed = raw.withColumn("zip", normalize_zip(F.col("zip")))
    got = lookup_state(fixed, gazetteer_states(gaz)).collect()
    assert [r.State for r in got] == ["CT"]
    # parity keeps the fan-out on duplicate zips
    fan = lookup_state(fixed, gazetteer_states(gaz, dedupe=False)).collect()
    assert sorted(r.State for r in fan) == ["CT", "MA", "MA"]


def test_lookup_refuses_existing_state(spark):
    import pytest
    df = spark.createDataFrame([("01234", "XX")], "zip string, State string")
    with pytest.raises(ValueError):
        lookup_state(df, _gaz(spark, [("01234", "MA")]))


def test_full_join_null_key_and_conflict(spark):
    a = spark.createDataFrame([(None, 1)], "k string, w int")
    b = spark.createDataFrame([(None, 1)], "k string, w int")
    assert natural_full_join(a, b).count() == 1
    c = spark.createDataFrame([("id1", 1, "x")], "id string, week int, s string")
    d = spark.createDataFrame([("id1", 1, "y")], "id string, week int, s string")
    assert natural_full_join(c, d).count() == 2


def test_flags_priority(spark):
    names = [f"f{k}" for k in range(1, 14)]
    def row(**on):
        return tuple(on.get(n) for n in names)
    df = spark.createDataFrame([row(f1=1, f5=1), row(f7=1), row()],
                               ", ".join(f"{n} int" for n in names))
    rules = [(label, [F.col(f"f{k}") for k in ks]) for label, ks in PROVIDER_RULES]
    got = [r[0] for r in df.select(first_true(rules)).collect()]
    assert got == ["Center teacher", None, None]


def test_child_flag_and_language(spark):
    df = spark.createDataFrame([(0, "EN"), (2, "SPA"), (None, "FR")], "c int, l string")
    out = df.select(child_flag(F.col("c")).alias("c"),
                    recode_map(F.col("l"), {"EN": "English", "SPA": "Spanish"}).alias("l"))
    assert [tuple(r) for r in out.collect()] == [("No", "English"), ("Yes", "Spanish"), (None, None)]


def test_response_blank(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "ok")], "id int, q1 string")
    out = unpivot_responses(df, ["id"], ["q1"]).orderBy("id").collect()
    assert [r.response for r in out] == [" ", "ok"]


def test_bigram_short_and_before_stop(spark):
    df = spark.createDataFrame([("q", ""), ("q", "one"), ("q", "one two"),
                                ("q", "worry about money")], "question string, response string")
    occ = bigram_occurrences(df).collect()
    assert [(r.word1, r.word2) for r in occ] == [("one", "two")]


def test_token_forms(spark):
    df = spark.createDataFrame([("I don't know, that.92 co-pay 3.5",)], "s string")
    got = df.select(tokens(F.col("s"))).first()[0]
    assert got == ["i", "don't", "know", "that", "92", "co", "pay", "3.5"]


def test_token_long_junk(spark):
    df = spark.createDataFrame([("a1" * 4000 + " tail",)], "s string")
    t = df.select(tokens(F.col("s")).alias("t")).select(
        F.size("t"), F.size(ngram_pairs(F.col("t")))).first()
    assert tuple(t) == (2, 1)


def test_percentile_rule_and_inclusive_cut(spark):
    rule = PercentileRule()
    df = spark.createDataFrame([("OPEN.001",), ("MH.014",), ("OPEN.002",)], "question string")
    cuts = df.select(rule.choose(F.col("question"), F.array(F.lit(0.95), F.lit(0.99)))).collect()
    assert [r[0] for r in cuts] == [0.99, 0.99, 0.95]
    counts = spark.createDataFrame([("q", "a", "b", 1), ("q", "c", "d", 1)],
                                   "question string, word1 string, word2 string, n long")
    c = percentile_cuts(counts)
    assert c.first().cut == 1.0
    assert top_by_percentile(counts, c).count() == 2


def test_catalog_kinds(spark):
    q = spark.createDataFrame([("ec", 1, "A"), ("ec", 2, "B"), ("ec", 3, "C")],
                              "panel string, num int, code string")
    menu = spark.createDataFrame([
        ("ec", "bigram", "A", "bigram", 1),       # ok
        ("ec", "responses", "A", "responses", 1),  # ok
        ("ec", "bigram", "B", "bigram", 3),       # wrong_page
        ("ec", "responses", "B", "bigram", 2),     # wrong_view
        ("ec", "bigram", "Z", "bigram", 2),       # unknown_code
        ("ec", "responses", "C", "responses", 4),  # page_out_of_range
    ], "panel string, section_view string, code string, href_view string, page_num int")
    got = {(r.code, r.view): r.status for r in catalog_audit(menu, q).collect()}
    assert got[("A", "bigram")] == "ok"
    assert got[("B", "bigram")] == "wrong_page"
    assert got[("B", "responses")] == "wrong_view"
    assert got[("Z", "bigram")] == "unknown_code"
    assert got[("C", "responses")] == "page_out_of_range"
    assert got[("C", "bigram")] == "missing_in_menu"


def test_counts_sum_equals_occurrences(spark):
    df = spark.createDataFrame([("q", "big cat big cat"), ("r", "big cat")],
                               "question string, response string")
    occ = bigram_occurrences(df)
    counts = count_bigrams(occ)
    assert counts.agg(F.sum("n")).first()[0] == occ.count() == 4


def test_stop_words_keyed_by_language(spark):
    from pyspark.ml.feature import StopWordsRemover
    stop = spark.createDataFrame(
        [("en", w) for w in StopWordsRemover.loadDefaultStopWords("english")]
        + [("fr", w) for w in StopWordsRemover.loadDefaultStopWords("french")], "lang string, word string")
    df = spark.createDataFrame([("q", "en", "the cat sat"), ("q", "fr", "le chat the dog")],
                               "question string, lang string, response string")
    occ = bigram_occurrences(df, keep=["lang"], stop=stop, stop_by=["lang"])
    got = sorted((r.lang, r.word1, r.word2) for r in occ.collect())
    # English list on English rows, French list on French rows ("the" is not French)
    assert got == [("en", "cat", "sat"), ("fr", "chat", "the"), ("fr", "the", "dog")]


def test_language_filter_option(spark):
    from verbatim.plans.panels import EC
    from verbatim.plans.response_table import build_response_table
    schema = ("CaregiverID string, Week int, UserLanguage string, DEMO_001 string, "
              "DEMO_004_a_2 int, OPEN_006 int, FPL_2019_150 int, RaceGroup int, "
              "CaregiverAge int, OPEN_001 string")
    df = spark.createDataFrame([("c1", 1, "EN", None, 1, 1, 1, 1, 1, "hello"),
                                ("c2", 1, "SPA", None, 1, 1, 1, 1, 1, "hola")], schema)
    assert build_response_table(df, EC, allow_missing=True).count() == 2
    only = build_response_table(df, EC, languages=("EN",), allow_missing=True).collect()
    assert [r.CaregiverID for r in only] == ["c1"]


def test_split_pair(spark):
    from verbatim.functions.text import split_pair
    df = spark.createDataFrame([("big cat",), ("solo",)], "b string")
    assert [tuple(r) for r in df.select(*split_pair(F.col("b"))).collect()] == [("big", "cat"), ("solo", None)]


def test_response_view_smart_search_and_page(spark):
    from verbatim.operators.views import response_view
    df = spark.createDataFrame(
        [(i, "q", "en" if i % 2 else "es", f"Rent and FOOD {i}" if i % 3 else f"food only {i}")
         for i in range(1, 31)], "id int, question string, lang string, response string")
    page = response_view(df, question="q", filters={"lang": ("in", ["en"])},
                         search="food  rent", order_by=[("id", False)], page=1, page_size=3)
    assert [r.id for r in page.collect()] == [19, 17, 13]
    assert page.columns == ["id", "lang", "response"]


def test_wave_type_drift_is_an_error(spark):
    import pytest
    a = spark.createDataFrame([("c1", 1, "30301")], "id string, week int, zip string")
    b = spark.createDataFrame([("c1", 2, 30301.0)], "id string, week int, zip double")
    with pytest.raises(TypeError):
        natural_full_join(a, b, split_hot_keys=False)


def test_null_weeks_are_not_disjoint(spark):
    from verbatim.operators.harmonize import fold_waves, waves_disjoint
    a = spark.createDataFrame([("c1", None, "x")], "id string, week int, s string")
    b = spark.createDataFrame([("c1", None, "x"), ("c2", 5, "y")], "id string, week int, s string")
    assert not waves_disjoint([a, b], "week")
    # the identical NULL-week row merges (NULL matches NULL), so 2 rows, not 3
    assert fold_waves([a, b], disjoint_on="week").count() == 2
    c = spark.createDataFrame([("c3", 7, "z")], "id string, week int, s string")
    assert waves_disjoint([b, c], "week") and fold_waves([b, c], disjoint_on="week").count() == 3


def test_general_ngrams(spark):
    from verbatim.functions.text import ngrams
    df = spark.createDataFrame([("a b c d",), ("a b",), ("",)], "s string")
    t = tokens(F.col("s"))
    got = [tuple(r) for r in df.select(ngrams(t, 3), ngrams(t, 1), ngrams(t, 2)).collect()]
    assert got == [(["a b c", "b c d"], ["a", "b", "c", "d"], ["a b", "b c", "c d"]),
                   ([], ["a", "b"], ["a b"]),
                   ([], [], [])]


def test_question_texts_from_codebook_table(spark):
    from verbatim.operators.audit import question_dimension, question_index
    labels = spark.createDataFrame(
        [("ec", "OPEN.001", 1, "What helps?"), ("ec", "OPEN.002", 2, "What worries you?"),
         ("cc", "OPEN.001", 1, "provider text")],
        "panel string, variable string, position int, label string")
    q = question_dimension(spark, "ec", ["OPEN.002", "OPEN.001", "MH.014"], labels)
    got = {r.code: (r.num, r.text) for r in q.collect()}
    assert got == {"OPEN.002": (1, "What worries you?"), "OPEN.001": (2, "What helps?"),
                   "MH.014": (3, None)}
    idx = {r.code: (r.index_line, r.bigram_page) for r in question_index(q).collect()}
    assert idx["OPEN.001"] == ("2: What helps?", "ec_bigram_2")
    assert idx["MH.014"] == ("3: MH.014", "ec_bigram_3")


def test_sorted_counts(spark):
    from verbatim.operators.bigrams import sort_counts
    c = spark.createDataFrame([("q", "a", "b", 1), ("q", "c", "d", 3), ("q", "a", "a", 3)],
                              "question string, word1 string, word2 string, n long")
    assert [(r.word1, r.word2) for r in sort_counts(c).collect()] == [("a", "a"), ("c", "d"), ("a", "b")]
