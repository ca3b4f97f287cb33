"""Publishing: all of a panel's pages at one moment, old ones whole until then."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from verbatim.operators.audit import question_dimension
from verbatim.operators.graph import bigram_network
from verbatim.plans.publish import Published
from verbatim.plans.reports import attach_questions

CODES = ["OPEN.001", "OPEN.002"]


def answers(spark, word):
    return spark.createDataFrame([(c, f"big {word} big {word} {c[-1]}") for c in CODES], "question string, response string")


def publish(spark, root, panel, word, fail=False):
    long, questions = answers(spark, word), question_dimension(spark, panel, CODES)
    net = bigram_network(long, questions=CODES)
    with Published(spark, root).refresh(panel) as new:
        new.write("responses", attach_questions(long, questions))
        if fail:
            raise RuntimeError("killed")
        new.write("edges", attach_questions(net.edges, questions))


def words(spark, root, panel, number):
    pages = Published(spark, root)
    assert all(r.panel == panel for r in pages.page("responses", panel, number).collect())
    return {r.response.split()[1] for r in pages.page("responses", panel, number).collect()}, {r.word2 for r in pages.page("edges", panel, number).collect()} - {"big"}


def test_refresh_switches_all_tables_together(spark, tmpdir_fresh):
    publish(spark, tmpdir_fresh, "ec", "cat")
    assert words(spark, tmpdir_fresh, "ec", 2) == ({"cat"}, {"cat"})
    before = Published(spark, tmpdir_fresh).table("responses", "ec")  # resolved, not yet read
    publish(spark, tmpdir_fresh, "ec", "dog")
    assert words(spark, tmpdir_fresh, "ec", 2) == ({"dog"}, {"dog"})
    assert {r.response.split()[1] for r in before.collect()} == {"cat"}


def test_killed_refresh_leaves_the_old_pages_whole(spark, tmpdir_fresh):
    publish(spark, tmpdir_fresh, "ec", "cat")
    with pytest.raises(RuntimeError, match="killed"):
        publish(spark, tmpdir_fresh, "ec", "dog", fail=True)
    assert words(spark, tmpdir_fresh, "ec", 1) == ({"cat"}, {"cat"})
    # and a job that dies within a write
    bad = answers(spark, "cow").select("question", F.when(F.col("question") == CODES[1], F.raise_error(F.lit("lost"))).otherwise(F.col("response")).alias("response"))
    with pytest.raises(Exception, match="lost"):
        with Published(spark, tmpdir_fresh).refresh("ec") as new:
            new.write("responses", attach_questions(bad, question_dimension(spark, "ec", CODES)))
    assert words(spark, tmpdir_fresh, "ec", 2) == ({"cat"}, {"cat"})
    assert Published(spark, tmpdir_fresh).manifest()["number"] == 1


def test_a_page_is_a_partition_pruned_read(spark, tmpdir_fresh):
    publish(spark, tmpdir_fresh, "ec", "cat")
    page = Published(spark, tmpdir_fresh).page("edges", "ec", 2)
    scan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(question_num" in scan.replace("#", "") or "PartitionFilters: [isnotnull(question_num#" in scan
    read = {f for f in page.inputFiles()}
    assert read and all("question_num=2" in f for f in page.select(F.input_file_name().alias("f")).distinct().toPandas()["f"])


def test_panels_and_simultaneous_refreshes(spark, tmpdir_fresh):
    """Refreshes of different panels at once: none is lost, whichever claims a number first."""
    failed = []

    def run(panel):
        try:
            publish(spark, tmpdir_fresh, panel, panel)
        except Exception as e:  # pragma: no cover
            failed.append(e)
    threads = [threading.Thread(target=run, args=(p,)) for p in ("ec", "cc", "xx")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    pages = Published(spark, tmpdir_fresh)
    assert pages.panels("edges") == ["cc", "ec", "xx"] and pages.manifest()["number"] == 3
    assert {r.panel for r in pages.table("responses").collect()} == {"cc", "ec", "xx"}


def test_a_taken_number_is_not_overwritten(spark, tmpdir_fresh):
    publish(spark, tmpdir_fresh, "ec", "cat")
    pages = Published(spark, tmpdir_fresh)
    was = pages.manifest()
    assert not pages._claim({"number": 1, "tables": {}}) and pages.manifest() == was
    assert [n for n in os.listdir(os.path.join(tmpdir_fresh, "_manifests")) if not n.startswith(".0") and n.startswith(".") and not n.endswith(".crc")] == []


def test_vacuum_keeps_what_readers_may_hold(spark, tmpdir_fresh):
    for word in ("cat", "dog", "cow"):
        publish(spark, tmpdir_fresh, "ec", word)
    with pytest.raises(RuntimeError):
        publish(spark, tmpdir_fresh, "ec", "dead", fail=True)
    pages = Published(spark, tmpdir_fresh)
    folders = lambda: len(os.listdir(os.path.join(tmpdir_fresh, "responses", "panel=ec")))
    assert folders() == 4
    assert len(pages.vacuum()) == 2 and folders() == 3  # the first version of two tables; the dead one may be being written
    assert len(pages.vacuum(orphan_hours=-1)) == 1 and folders() == 2
    assert words(spark, tmpdir_fresh, "ec", 1) == ({"cow"}, {"cow"})
    assert pages.vacuum(keep=1) and words(spark, tmpdir_fresh, "ec", 1) == ({"cow"}, {"cow"})


def test_empty_and_withdrawn_tables(spark, tmpdir_fresh):
    pages = Published(spark, tmpdir_fresh)
    with pytest.raises(LookupError):
        pages.table("edges")
    with pages.refresh("ec") as new:
        new.write("edges", spark.createDataFrame([], "question_num int, word1 string"))
        new.write("index", spark.createDataFrame([("ec", 1), ("cc", 2)], "panel string, num int"))
        with pytest.raises(ValueError):
            new.write("index", spark.range(1))
    assert pages.page("edges", "ec", 1).count() == 0 and pages.table("edges").columns == ["word1", "question_num", "panel"]
    assert [r.num for r in pages.table("index").collect()] == [1]
    with pages.refresh("ec") as new:
        new.write("edges", spark.createDataFrame([(1, "a")], "question_num int, word1 string"))
    assert pages.panels("index") == [] and pages.page("edges", "ec", 1).count() == 1
