"""Property checks on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbatim.operators.fill import fill_forward
from verbatim.operators.harmonize import natural_full_join
from verbatim.operators.reshape import unpivot_responses

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.sampled_from(["a", "b", "c", None])
weeks = st.one_of(st.none(), st.integers(0, 5))
vals = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
rows = st.lists(st.tuples(st.sampled_from(["a", "a", "a", "b", "c"]), weeks, vals, vals),
                min_size=1, max_size=80)


def _with_tb(spark, rs):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rs)],
                                 "tb int, id string, week int, v1 string, v2 string")


@SETTINGS
@given(rs=rows)
def test_fill_split_equals_window_and_is_idempotent(spark, rs):
    df = _with_tb(spark, rs)
    cols = ["v1", "v2"]
    plain = fill_forward(df, "id", "week", cols, tiebreak="tb", split_hot_keys=False)
    split = fill_forward(df, "id", "week", cols, tiebreak="tb", num_partitions=4)
    a = sorted(tuple(r) for r in plain.collect())
    assert a == sorted(tuple(r) for r in split.collect())
    again = fill_forward(plain, "id", "week", cols, tiebreak="tb", split_hot_keys=False)
    assert a == sorted(tuple(r) for r in again.collect())
    before = {r.tb: r for r in df.collect()}
    for r in plain.collect():  # a non-NULL value is never changed
        for c in cols:
            if before[r.tb][c] is not None:
                assert r[c] == before[r.tb][c]


join_rows = st.lists(st.tuples(ids, st.integers(0, 2), st.sampled_from(["p", "q", "r"])),
                     min_size=0, max_size=60)


@SETTINGS
@given(ls=join_rows, rs=join_rows)
def test_natural_join_split_equals_plain(spark, ls, rs):
    left = spark.createDataFrame(ls, "id string, week int, lv string")
    right = spark.createDataFrame(rs, "id string, week int, rv string")
    a = natural_full_join(left, right, num_partitions=4)
    b = natural_full_join(left, right, split_hot_keys=False)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@SETTINGS
@given(rs=st.lists(st.tuples(ids, st.integers(0, 3)), min_size=1, max_size=30, unique=True))
def test_self_join_of_distinct_rows_is_identity(spark, rs):
    df = spark.createDataFrame(rs, "id string, week int")
    out = natural_full_join(df, df, split_hot_keys=False)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


@SETTINGS
@given(rs=st.lists(st.tuples(st.integers(0, 10 ** 6), vals, vals), min_size=1, max_size=30,
                   unique_by=lambda t: t[0]))
def test_unpivot_then_pivot_round_trip(spark, rs):
    df = spark.createDataFrame(rs, "id int, q1 string, q2 string")
    long = unpivot_responses(df, ["id"], ["q1", "q2"], drop_empty=False)
    wide = long.groupBy("id").pivot("question", ["q1", "q2"]).agg(F.first("response"))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, df.collect()))


def test_keyset_pages_equal_numbered_pages(spark):
    from verbatim.operators.views import response_view
    rows = [(i, None if i % 7 == 0 else i % 5, None if i % 11 == 0 else f"t{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, n int, t string")
    order = [("n", False), ("t", True), ("id", True)]
    after = None
    for page in range(7):
        want = [tuple(r) for r in response_view(df, order_by=order, page=page).collect()]
        got = [tuple(r) for r in response_view(df, order_by=order, after=after).collect()]
        assert got == want
        if got:
            after = (got[-1][1], got[-1][2], got[-1][0])
