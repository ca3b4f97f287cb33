"""Lines that don't parse are set apart and counted."""

import os

import pytest

from verbatim.sources.gazetteer import read_gazetteer, read_gazetteer_checked
from verbatim.sources.quarantine import read_delimited

GOOD = ["US\t1234\tO'Fallon\tMissouri\tMO\tSt. Charles\t183\t\t\t38.8\t-90.7\t4", "US\t99501\t\"Anchorage\tAlaska\tAK\tA\t020\t\t\t61.2\t-149.9\t",
        "US\t501\tHoltsville\tNew York\tNY\tSuffolk\t103\t\t\t1e1\t-73\t4"]
BAD = {"US\t1\tshort": "too_few_fields", GOOD[0] + "\tmore": "too_many_fields", GOOD[0].replace("38.8", "north"): "bad_value",
       GOOD[0].replace("\t4", "\t4.5"): "bad_value", "x": "too_few_fields"}


def gazetteer(folder, lines, name="US.txt"):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_good_and_bad_lines(spark, tmpdir_fresh):
    path = gazetteer(tmpdir_fresh, [GOOD[0], *BAD, "", "  ", *GOOD[1:]])
    q = read_gazetteer_checked(spark, path)
    clean = read_gazetteer(spark, gazetteer(tmpdir_fresh, GOOD, "clean.txt"))
    assert sorted(map(str, q.good.collect())) == sorted(map(str, clean.collect()))
    assert q.good.columns == clean.columns and [f.dataType for f in q.good.schema] == [f.dataType for f in clean.schema]
    assert {r.line: r.reason for r in q.bad.collect()} == BAD
    assert all(r.file.endswith("US.txt") for r in q.bad.collect())
    assert {r.reason: r.n for r in q.counts().collect()} == {"too_few_fields": 2, "too_many_fields": 1, "bad_value": 2}


def test_require(spark, tmpdir_fresh):
    q = read_gazetteer_checked(spark, gazetteer(tmpdir_fresh, [*GOOD, *BAD]))
    assert q.require(most=5).count() == 3
    with pytest.raises(ValueError, match="5 rows don't parse"):
        q.require()
    assert read_gazetteer_checked(spark, gazetteer(tmpdir_fresh, GOOD, "ok.txt")).require().count() == 3


def test_several_files_types_and_options(spark, tmpdir_fresh):
    for i, rows in enumerate((["1|2024-01-31|", "x|2024-01-31|a"], ["2|31.01.2024|b", "3||c", "|"])):
        gazetteer(tmpdir_fresh, rows, f"f{i}.txt")
    q = read_delimited(spark, tmpdir_fresh, "n int, d date, t string", sep="|")
    assert sorted((r.n, str(r.d), r.t) for r in q.good.collect()) == [(1, "2024-01-31", None), (3, "None", "c")]
    assert sorted((r.line, r.reason) for r in q.bad.collect()) == [("2|31.01.2024|b", "bad_value"), ("x|2024-01-31|a", "bad_value"), ("|", "too_few_fields")]
    assert len({r.file for r in q.bad.collect()}) == 2
    with pytest.raises(ValueError):
        read_delimited(spark, tmpdir_fresh, "n int", sep="||")


def test_one_scan(spark, tmpdir_fresh):
    """Good rows are a projection of the scan, without a shuffle; an empty file has none."""
    q = read_gazetteer_checked(spark, gazetteer(tmpdir_fresh, GOOD))
    assert "Exchange" not in q.good._jdf.queryExecution().executedPlan().toString()
    assert read_gazetteer_checked(spark, gazetteer(tmpdir_fresh, [""], "empty.txt")).good.count() == 0
