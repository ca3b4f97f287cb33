"""Counts per wave: adding, correcting and removing waves equals counting all texts."""

import threading

import pytest

from verbatim.operators.graph import bigram_network
from verbatim.plans.wave_counts import WaveCounts

WAVES = {"2020": [("OPEN.001", "big red cat big red cat"), ("OPEN.002", "old dog"), ("OPEN.002", None)],
         "2021": [("OPEN.001", "big red dog"), ("OPEN.011", "red fox red fox jumps")], "2022": [("OPEN.001", "the big red cat"), ("OPEN.003", "")]}


def frame(spark, rows):
    return spark.createDataFrame(rows, "question string, response string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def full(spark, waves):
    return bigram_network(frame(spark, [r for w in waves for r in w]))


def same(store, spark, waves):
    want, got = full(spark, waves), store.network()
    return all(rows(a) == rows(b.select(*a.columns)) for a, b in zip((want.counts, want.cuts, want.edges, want.vertices), (got.counts, got.cuts, got.edges, got.vertices)))


def test_each_wave_added_equals_the_full_run(spark, tmpdir_fresh):
    store, so_far = WaveCounts(spark, tmpdir_fresh), []
    for wave, answers in WAVES.items():
        store.add(wave, frame(spark, answers))
        so_far.append(answers)
        assert same(store, spark, so_far)
    assert store.waves() == sorted(WAVES)


def test_corrected_and_removed_waves(spark, tmpdir_fresh):
    store = WaveCounts(spark, tmpdir_fresh)
    for wave, answers in WAVES.items():
        store.add(wave, frame(spark, answers))
    fixed = [("OPEN.001", "big red dog big"), ("OPEN.009", "new words here")]
    store.add("2021", frame(spark, fixed))
    assert same(store, spark, [WAVES["2020"], fixed, WAVES["2022"]])
    store.add("2021", frame(spark, fixed))  # the same again changes nothing
    assert same(store, spark, [WAVES["2020"], fixed, WAVES["2022"]])
    store.remove("2020")
    assert same(store, spark, [fixed, WAVES["2022"]]) and store.waves() == ["2021", "2022"]
    assert min(r.n for r in store.counts().collect()) > 0
    with pytest.raises(LookupError):
        store.remove("2020")


def test_a_new_wave_reads_no_older_text(spark, tmpdir_fresh, tmp_path):
    """The older wave's file is gone when the next is added; questions prune the merged table."""
    import shutil
    store = WaveCounts(spark, tmpdir_fresh)
    frame(spark, WAVES["2020"]).write.parquet(str(tmp_path / "w1"))
    store.add("2020", spark.read.parquet(str(tmp_path / "w1")))
    shutil.rmtree(tmp_path / "w1")
    store.add("2021", frame(spark, WAVES["2021"]))
    assert same(store, spark, [WAVES["2020"], WAVES["2021"]])
    only = store.network(questions=["OPEN.011"])
    assert {r.question for r in only.edges.collect()} == {"OPEN.011"}


def test_waves_added_at_the_same_time(spark, tmpdir_fresh):
    failed = []

    def run(wave):
        try:
            WaveCounts(spark, tmpdir_fresh).add(wave, frame(spark, WAVES[wave]))
        except Exception as e:  # pragma: no cover
            failed.append(e)
    threads = [threading.Thread(target=run, args=(w,)) for w in WAVES]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and same(WaveCounts(spark, tmpdir_fresh), spark, WAVES.values())


def test_an_empty_wave(spark, tmpdir_fresh):
    store = WaveCounts(spark, tmpdir_fresh, stop=["red"])
    store.add("none", frame(spark, []))
    assert store.counts().count() == 0 and store.network().edges.count() == 0
    store.add("2020", frame(spark, WAVES["2020"]))
    assert rows(store.counts()) == [("OPEN.001", "cat", "big", 1), ("OPEN.002", "old", "dog", 1)]
