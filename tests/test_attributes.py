"""Labels in the schema: kept on the way, decoded without a codebook."""

import os

import pytest
from pyspark.sql import functions as F

from verbatim.operators.attributes import (attribute_conflicts, attributes, decode_labelled, is_labelled, labelled_columns,
                                           merged_attributes, question_texts, with_attributes)
from verbatim.operators.decode import decode_values
from verbatim.operators.harmonize import fold_waves
from verbatim.plans import panels
from verbatim.plans.response_table import build_response_table

CODES = {"a": {1: "one", 2: "two"}, "b": {"x": "ex", "1": "uno"}}


def frame(spark):
    return spark.createDataFrame([(1.0, "x", 1), (1.5, "1", 2), (None, " 1.0", 1), (2.0, "y", None)], "a double, b string, c int")


def test_attributes_survive_files_projection_and_rename(spark, tmpdir_fresh):
    df = with_attributes(frame(spark), {"a": "How many?", "nope": "?"}, CODES)
    df.write.parquet(os.path.join(tmpdir_fresh, "w"))
    read = spark.read.parquet(os.path.join(tmpdir_fresh, "w"))
    moved = read.where("c > 0").withColumnsRenamed({"a": "how_many"}).select("c", "how_many", F.col("b").alias("letter")).orderBy("c").distinct()
    assert attributes(read) == attributes(df)
    assert labelled_columns(moved) == ["how_many", "letter"] and is_labelled(moved, "letter") and not is_labelled(moved, "c")
    assert question_texts(moved) == {"how_many": "How many?"}


def test_decode_from_the_schema_equals_decode_from_the_codebook(spark):
    df = frame(spark)
    table = spark.createDataFrame([(v, str(k), t) for v, m in CODES.items() for k, t in m.items()], "variable string, code string, label string")
    for labelled in (with_attributes(df, None, CODES), with_attributes(df, None, table)):
        got = decode_labelled(labelled)
        assert sorted(map(str, got.collect())) == sorted(map(str, decode_values(df, CODES).collect()))
        assert labelled_columns(got) == [] and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert decode_labelled(labelled, exclude=["a", "b"]).collect() == df.collect()
    assert question_texts(decode_labelled(with_attributes(df, {"a": "How many?"}, CODES))) == {"a": "How many?"}


def test_attributes_of_a_fold(spark):
    """The coalesced keys keep theirs; of waves that differ the earlier one counts."""
    a = with_attributes(spark.createDataFrame([(1, 1, "p")], "id int, sex int, only_a string"), {"id": "Who", "only_a": "A?"}, {"sex": {1: "male"}})
    b = with_attributes(spark.createDataFrame([(1, 1.0, 5)], "id int, sex double, only_b int"), {"id": "Who else", "only_b": "B?"}, {"sex": {1: "man", 2: "woman"}})
    for out in (fold_waves([a, b]), fold_waves([a, b.withColumn("id", F.lit(2))], disjoint_on="id")):
        assert question_texts(out) == {"id": "Who", "only_a": "A?", "only_b": "B?"}
        assert attributes(out)["sex"]["value_labels"] == {"1": "male", "2": "woman"}
    assert [tuple(r) for r in decode_labelled(fold_waves([a, b])).collect()] == [(1, "male", "p", 5)]
    assert attribute_conflicts([a, b]) == [("id", None, ["Who", "Who else"]), ("sex", "1", ["male", "man"])]
    assert merged_attributes([frame(spark)]) == {}


def test_response_table_decodes_by_the_schema(spark):
    """Entry 1 with the labels in the file gives what it gives with a codebook."""
    schema = ("CaregiverID string, Week int, UserLanguage string, DEMO_001 double, DEMO_004_a_2 int, OPEN_006 int, "
              "FPL_2019_150 int, RaceGroup int, CaregiverAge int, OPEN_001 string")
    master = spark.createDataFrame([("c1", 1, "EN", 30301.0, 2, 1, 1, 2, 3, "rent"), ("c1", 2, "EN", None, None, 1, 7, None, None, "food")], schema)
    codes = {"FPL_2019_150": {1: "Yes"}, "RaceGroup": {2: "Black"}}
    by_book = build_response_table(master, panels.EC, value_labels=codes, allow_missing=True)
    by_schema = build_response_table(with_attributes(master, None, codes), panels.EC, allow_missing=True)
    rows = sorted(map(str, by_schema.collect()))
    assert rows == sorted(map(str, by_book.collect())) and len(rows) == 2 and "Black" in rows[1]


def test_codebooks_are_bounded(spark, monkeypatch):
    from verbatim.operators import attributes as module
    monkeypatch.setattr(module, "MAX_ROWS", 2)
    table = spark.createDataFrame([("a", str(i), "x") for i in range(3)], "variable string, code string, label string")
    with pytest.raises(ValueError, match="codebook"):
        with_attributes(frame(spark), None, table)


def test_empty_codebooks_and_nulls(spark):
    none = spark.createDataFrame([("a", None, "x"), ("a", "1", None), (None, "1", "x")], "variable string, code string, label string")
    df = with_attributes(frame(spark), none.select("variable", "label").where("false"), none)
    assert attributes(df) == {} and decode_labelled(df).collect() == frame(spark).collect()
