"""Columns whose type differs between waves: least common type, exact values, refusals."""

import datetime
import decimal
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.operators.harmonize import fold_waves, stack_waves, waves_disjoint
from verbatim.operators.wavetypes import align_types, common_types, least_common_type

BYTE, SHORT, INT, LONG, FLOAT, DOUBLE = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
TEXT, BOOL, DATE, STAMP, NAIVE, NONE = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.NullType()


@pytest.mark.parametrize("types, want", [
    ([BYTE, INT, SHORT], INT), ([INT, LONG], LONG), ([SHORT, FLOAT], FLOAT), ([INT, FLOAT], DOUBLE), ([INT, DOUBLE], DOUBLE), ([LONG, DOUBLE], DOUBLE),
    ([FLOAT, DOUBLE], DOUBLE), ([INT, DOUBLE, TEXT], TEXT), ([BOOL, INT], INT), ([BOOL, DOUBLE], DOUBLE), ([NONE, DATE], DATE), ([NONE, BOOL, INT], INT),
    ([DATE, STAMP], STAMP), ([DATE, TEXT], TEXT), ([NAIVE, TEXT], TEXT), ([INT, T.DecimalType(5, 2)], T.DecimalType(12, 2)),
    ([T.DecimalType(10, 2), T.DecimalType(8, 5)], T.DecimalType(13, 5)), ([T.DecimalType(15, 2), DOUBLE], DOUBLE), ([T.VarcharType(5), TEXT], TEXT),
    ([T.ArrayType(INT, False), T.ArrayType(INT, True)], T.ArrayType(INT, True))])
def test_least_common_type(types, want):
    for order in itertools.permutations(types):
        assert least_common_type(order, "c") == want


@pytest.mark.parametrize("types", [
    [BOOL, TEXT], [STAMP, TEXT], [INT, DATE], [T.BinaryType(), TEXT], [T.DecimalType(20, 2), DOUBLE], [LONG, T.DecimalType(38, 20)],
    [FLOAT, DOUBLE, TEXT], [BOOL, INT, TEXT], [NAIVE, STAMP], [T.ArrayType(INT), T.ArrayType(TEXT)], [T.DecimalType(20, 2), TEXT, INT, FLOAT]])
def test_lossy_pairs_are_named(types):
    for order in itertools.permutations(types):
        with pytest.raises(TypeError) as e:
            least_common_type(order, "zip")
        named = [t.simpleString() for t in types if t.simpleString() in str(e.value)]
        assert len(named) >= 2 and "'zip'" in str(e.value)


def test_equal_values_stay_equal_as_text(spark):
    """One number in every type is one text; others keep apart."""
    ints = spark.sql("SELECT CAST(v AS int) v FROM VALUES (5), (-3), (0), (NULL) AS t(v)")
    doubles = spark.sql("SELECT CAST(v AS double) v FROM VALUES ('5'), ('-3'), ('-0.0'), ('1.5'), ('1e15'), ('1e-7'), ('NaN'), ('Infinity') AS t(v)")
    decimals = spark.sql("SELECT CAST(v AS decimal(9, 3)) v FROM VALUES (5.000), (1.500), (100.000) AS t(v)")
    texts = spark.sql("SELECT v FROM VALUES ('5'), ('005'), ('1.5'), ('x'), ('100') AS t(v)")
    got = [sorted(str(r.v) for r in w.collect()) for w in align_types([ints, doubles, decimals, texts])]
    assert got[0] == ["-3", "0", "5", "None"]
    assert got[1] == ["-3", "0", "1.0E-7", "1.5", "1000000000000000", "5", "Infinity", "NaN"]
    assert got[2] == ["1.5", "100", "5"] and got[3] == ["005", "1.5", "100", "5", "x"]
    exact = spark.sql("SELECT CAST(v AS decimal(30, 5)) v FROM VALUES (5), (123456789012345678901.50000), (100) AS t(v)")
    assert sorted(r.v for r in align_types([exact, texts])[0].collect()) == ["100", "123456789012345678901.5", "5"]


def test_long_beyond_double_is_named(spark):
    a, b = spark.createDataFrame([(1,), ((1 << 53) + 1,)], "id long"), spark.createDataFrame([(1.0,)], "id double")
    with pytest.raises(Exception, match="bigint in one wave and double.*9007199254740993"):
        fold_waves([a.withColumn("x", F.lit(1)), b.withColumn("y", F.lit(2))]).collect()
    small = fold_waves([a.where("id = 1").withColumn("x", F.lit(1)), b.withColumn("y", F.lit(2))])
    assert [tuple(r) for r in small.collect()] == [(1.0, 1, 2)]


def test_fold_of_int_double_and_text_keys(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, only_a string")
    b = spark.createDataFrame([(2.0, 20), (2.5, 25), (None, 0)], "id double, only_b int")
    c = spark.createDataFrame([("2", True), ("2.5", False), ("02", None), ("x", None)], "id string, only_c boolean")
    got = {tuple(r) for r in fold_waves([a, b, c]).collect()}
    assert got == {("1", "a", None, None), ("2", "b", 20, True), (None, "n", 0, None), ("2.5", None, 25, False), ("02", None, None, None), ("x", None, None, None)}


def test_every_order_of_waves_gives_the_same_rows(spark):
    waves = [spark.createDataFrame([(k, k * 10) for k in range(4)], "k byte, v0 int"), spark.createDataFrame([(float(k), k) for k in range(2, 6)], "k double, v1 int"),
             spark.createDataFrame([(decimal.Decimal(k), k) for k in range(1, 3)], "k decimal(5,1), v2 int"), spark.createDataFrame([(None, 7)], "k void, v3 int")]
    rows = set()
    for order in itertools.permutations(waves):
        out = fold_waves(list(order)).select("k", "v0", "v1", "v2", "v3")
        assert out.schema["k"].dataType == DOUBLE
        rows.add(frozenset(tuple(r) for r in out.collect()))
    assert len(rows) == 1 and len(next(iter(rows))) == 7


def test_stack_and_disjointness_see_common_types(spark):
    a = spark.createDataFrame([("p", 1)], "id string, Week int")
    b = spark.createDataFrame([("p", 2.0)], "id string, Week double")
    assert waves_disjoint([a, b], "Week")
    assert not waves_disjoint([a, b.withColumn("Week", F.lit(1.0))], "Week")
    got = fold_waves([a, b], disjoint_on="Week")
    assert {tuple(r) for r in got.collect()} == {("p", 1.0), ("p", 2.0)}
    assert {tuple(r) for r in stack_waves(align_types([a, b])).collect()} == {("p", 1.0), ("p", 2.0)}


def test_untouched_waves_and_metadata(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string").select(F.col("a").alias("a", metadata={"label": "Age"}), "b")
    b = spark.createDataFrame([(1.5,)], "a double")
    aligned = align_types([a, b])
    assert aligned[1] is b and aligned[0].schema["a"].metadata == {"label": "Age"}
    assert common_types([a, b]) == {"a": DOUBLE}
    day, moment = spark.createDataFrame([(datetime.date(2024, 1, 2),)], "d date"), spark.createDataFrame([(datetime.datetime(2024, 1, 2),)], "d timestamp_ntz")
    assert [w.first().d for w in align_types([day, moment])] == [datetime.datetime(2024, 1, 2)] * 2
