"""Indexed search: the rows of a scan from the files that can match."""

import random

import pytest
from pyspark.sql import functions as F

from verbatim.plans.text_index import TextIndex, grams

SPECIAL = ["", None, "ab", "Straße %_ \\\\ 'x'", "İstanbul and ÀÉ", "\U0001f600 smile \U0001f600\U0001f601", "a" * 5000 + "needle" + "b" * 5000, "tab\there\nline two", "NEEDLE"]


def rows():
    rng = random.Random(3)
    words = ["rent", "food", "school", "care", "money", "Sleep", "Tired"]
    out = [(i, f"Q{i % 3}", " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(300)]
    return out + [(1000 + i, "Q1" if i % 2 else None, t) for i, t in enumerate(SPECIAL)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    df = spark.createDataFrame(rows(), "id int, question string, response string")
    return TextIndex(spark, str(tmp_path_factory.mktemp("index"))).build(df, cluster_by=["response"], rows_per_file=10), df


@pytest.mark.parametrize("text", ["needle", "Rent Food", "school care", "%_", "STRASSE", "straße", "\U0001f600\U0001f601", "à", "e", "", "\there\n", "nothing like it", "aaaab", "'x'", "tired"])
def test_same_rows_as_a_scan(spark, index, text):
    built, df = index
    for question in (None, "Q1"):
        want = df.where(F.lower("response").contains(F.lower(F.lit(text))))
        if question:
            want = want.where(F.col("question") == question)
        got = built.search(text, question)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_matching_files_are_read(spark, index):
    built, _ = index
    every = spark.read.parquet(f"{built.root}/data").inputFiles()
    rare = built.files("needle")
    assert 1 <= len(rare) <= 2 and len(every) > 30
    read = built.search("needle").inputFiles()
    plain = lambda files: sorted(f.replace("file:///", "file:/") for f in files)
    assert plain(read) == plain(rare)
    assert built.files("zzzzz") == [] and built.search("zzzzz").count() == 0
    assert built.files("ab") is None  # too short: all files
    assert len(built.files("rent")) < len(every)


def test_index_lookup_is_pruned(spark, index):
    built, _ = index
    lookup = spark.read.parquet(f"{built.root}/grams").where("bucket = 3 AND gram = 'ren'")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(gram,ren)" in plan


def test_grams(spark):
    got = spark.createDataFrame([("abcabc",), ("ab",), ("",), (None,), ("\U0001f600ab",)], "t string").select(grams(F.col("t")).alias("g")).collect()
    assert [r.g for r in got] == [["abc", "bca", "cab"], [], [], None, ["\U0001f600ab"]]


def test_without_questions_and_empty(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "id int, t string")
    built = TextIndex(spark, tmpdir_fresh + "/a").build(df, "t", None)
    assert [r.id for r in built.search("ME TE").collect()] == [1]
    empty = TextIndex(spark, tmpdir_fresh + "/b").build(df.where("false"), "t", None)
    assert empty.search("some").count() == 0
