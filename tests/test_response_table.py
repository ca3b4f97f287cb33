"""Entry 1 end to end on micro wave files for both panels."""

from verbatim.operators.harmonize import fold_waves
from verbatim.plans.panels import CC, EC
from verbatim.plans.reports import panel_network, panel_questions, responses_by_question
from verbatim.plans.response_table import build_response_table

EC_SCHEMA = ("CaregiverID string, Week int, UserLanguage string, DEMO_001 double, "
             "DEMO_004_a_2 int, OPEN_006 int, FPL_2019_150 int, RaceGroup int, CaregiverAge int, "
             "OPEN_001 string, MH_014 string")


def _gaz(spark):
    return spark.createDataFrame([("US", "1234", "X", "A", "MA", "", "", "", "", 0.0, 0.0, 1),
                                  ("US", "30301", "Y", "B", "GA", "", "", "", "", 0.0, 0.0, 1)],
                                 "CountryCode string, zip string, PlaceName string, AdminName1 string, "
                                 "State string, AdminName2 string, AdminCode2 string, AdminName3 string, "
                                 "AdminCode3 string, latitude double, longitude double, accuracy int")


def test_household_flow(spark):
    w20 = spark.createDataFrame([
        ("c1", 1, "EN", 30301.0, 2, 1, 1, 1, 3, "worried about rent money", ""),
        ("c2", 1, "SPA", 1234.0, 0, 0, 0, 2, 2, "secret", None),
    ], EC_SCHEMA)
    w21 = spark.createDataFrame([
        ("c1", 60, "FR", None, None, 1, 9, None, None, "child care costs", "sleep"),
        ("c2", 61, "EN", None, None, 1, None, None, None, "", "fine"),
    ], EC_SCHEMA)
    master = fold_waves([w20, w21], disjoint_on="Week")
    labels = {"FPL.2019.150": {0: "No", 1: "Yes"}, "RaceGroup": {1: "White", 2: "Latinx"}}
    long = build_response_table(master, EC, _gaz(spark), labels, allow_missing=True)
    rows = {(r.CaregiverID, r.Week, r.question): r for r in long.collect()}
    # gate: c2's week-1 row is gated out, so nothing from it is carried forward
    assert ("c2", 1, "OPEN.001") not in rows
    c2 = rows[("c2", 61, "MH.014")]
    assert (c2.State, c2.RaceGroup, c2.Language) == (None, None, "English")
    # c1 week 60: language FR → NULL then carried; unlabelled poverty code 9 → NULL → carried
    c1 = rows[("c1", 60, "OPEN.001")]
    assert (c1.Language, c1.below_1_5x_fpl, c1.State, c1.zip, c1.child_0_3) == \
        ("English", "Yes", "GA", "30301", "Yes")
    assert ("c1", 1, "MH.014") not in rows  # empty response dropped
    assert long.columns == ["CaregiverID", "Week", "State", "below_1_5x_fpl", "zip", "Language",
                            "RaceGroup", "CaregiverAge", "child_0_3", "question", "response"]
    net = panel_network(long, EC)
    assert net.counts.count() > 0
    keyed = responses_by_question(long, panel_questions(spark, EC))
    nums = {r.question: r.question_num for r in keyed.select("question", "question_num").collect()}
    assert nums["OPEN.001"] == 1 and nums["MH.014"] == 24


def test_provider_flow(spark):
    flags = ", ".join(f"CC_DEMO_013_{k} int" for k in range(1, 14))
    schema = (f"ProviderID string, Week int, UserLanguage string, CC_DEMO_001 string, {flags}, "
              "CC_OPEN_007 int, FPL_2019_150 int, RaceGroup int, CC_OPEN_001 string")
    f = [None] * 13
    f1 = list(f); f1[4] = 1   # _5 → FFN
    df = spark.createDataFrame([("p1", 3, "EN", "30301", *f1, 1, 1, 1, "hello there friend"),
                                ("p1", 4, "SPA", None, *f, 1, None, None, "more words here")], schema)
    long = build_response_table(df, CC, _gaz(spark), None, allow_missing=True)
    got = sorted((r.Week, r.provider_type, r.Language, r.State) for r in long.collect())
    assert got == [(3, "FFN", "English", "GA"), (4, "FFN", "Spanish", "GA")]


def test_first_driver_config(spark):
    from verbatim.plans.panels import first_household_config
    original = ["CaregiverID", "Week", "UserLanguage", "DEMO.001", "DEMO.004.a.2", "OPEN.006",
                "FPL.2019.UM.150", "RaceGroup", "CaregiverAge", "OPEN.001", "OPEN.002", "MH.013"]
    cfg = first_household_config(original)
    assert cfg.question_codes[:3] == ("OPEN.001", "OPEN.002", "COVID.007")
    assert "OPEN.006" not in cfg.question_codes and "MH.013" in cfg.question_codes
    schema = ("CaregiverID string, Week int, UserLanguage string, DEMO_001 string, "
              "DEMO_004_a_2 int, OPEN_006 int, FPL_2019_UM_150 int, RaceGroup int, "
              "CaregiverAge int, OPEN_001 string, OPEN_002 string, MH_013 string")
    df = spark.createDataFrame([("c1", 1, "EN", "30301", 0, 1, 1, 1, 1, "a b", "", "c d"),
                                ("c2", 1, "SPA", "30301", 0, 1, 1, 1, 1, "e f", "g", "h")], schema)
    long = build_response_table(df, cfg, _gaz(spark), allow_missing=True)
    assert "Language" not in long.columns
    assert sorted((r.CaregiverID, r.question, r.State) for r in long.collect()) == [
        ("c1", "MH.013", "GA"), ("c1", "OPEN.001", "GA")]


def test_missing_question_column_is_an_error(spark):
    import pytest
    from verbatim.plans.response_table import missing_columns
    df = spark.createDataFrame([("c1", 1, "EN", 30301.0, 2, 1, 1, 1, 3, "a", "b")], EC_SCHEMA)
    assert "OPEN_002" in missing_columns(df, EC) and "OPEN_001" not in missing_columns(df, EC)
    with pytest.raises(ValueError, match="OPEN_002"):
        build_response_table(df, EC, _gaz(spark))


def test_same_week_tie_follows_wave_order(spark):
    from verbatim.operators.harmonize import stack_waves
    from verbatim.plans.response_table import with_order
    rows = [("c1", 5, "EN", 30301.0, 2, 1, 1, 1, 3, "first", ""), ("c1", 5, "EN", None, None, 1, None, 2, None, "second", "")]
    waves = [spark.createDataFrame([r], EC_SCHEMA) for r in rows]
    for order in (waves, waves[::-1]):
        long = build_response_table(stack_waves(with_order(order, EC)), EC, _gaz(spark), allow_missing=True)
        got = {r.response: (r.RaceGroup, r.CaregiverAge) for r in long.collect()}
        # only a later row of the week carries the age forward
        assert got["first"] == ("1", "3") or got["first"] == (1, 3)
        assert (got["second"][1] is not None) == (order is waves)


def test_relookup_takes_state_from_the_carried_zip(spark):
    df = spark.createDataFrame([("c1", 1, "EN", 30301.0, 2, 1, 1, 1, 3, "a", ""), ("c1", 2, "EN", None, None, 1, 1, 1, 3, "b", "")], EC_SCHEMA)
    for relookup in (True, False):
        long = build_response_table(df, EC, _gaz(spark), relookup=relookup, allow_missing=True)
        assert {(r.Week, r.State, r.zip) for r in long.collect()} == {(1, "GA", "30301"), (2, "GA", "30301")}
