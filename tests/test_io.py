"""Sources and sinks: write then read back in a fresh folder."""

import os

from pyspark.sql import functions as F

from verbatim.operators.graph import bigram_network
from verbatim.plans.sinks import write_network
from verbatim.operators.audit import question_dimension
from verbatim.sources.catalog import read_catalog
from verbatim.sources.gazetteer import read_gazetteer
from verbatim.sources.stopwords import ENGLISH_STOP_WORDS
from verbatim.sources.waves import read_waves


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_gazetteer_tab_no_quotes(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "US.txt")
    with open(path, "w") as f:
        f.write("US\t1234\tO'Fallon\tMissouri\tMO\tSt. Charles\t183\t\t\t38.8\t-90.7\t4\n")
        f.write("US\t99501\tAnchorage\tAlaska\tAK\tAnchorage\t020\t\t\t61.2\t-149.9\t4\n")
    g = read_gazetteer(spark, path)
    rows = g.orderBy("zip").collect()
    assert [r.PlaceName for r in rows] == ["O'Fallon", "Anchorage"]
    assert rows[0].zip == "1234" and rows[1].accuracy == 4


def test_waves_rename_dotted(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "MasterFile_2021.parquet")
    spark.createDataFrame([("c1", 1, "hi")], "`CaregiverID` string, `Week` int, `OPEN.001` string") \
        .write.parquet(p)
    waves = read_waves(spark, [p])
    assert list(waves) == ["MasterFile_2021"]
    assert waves["MasterFile_2021"].columns == ["CaregiverID", "Week", "OPEN_001"]


def test_catalog_json(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "menu.json")
    with open(p, "w") as f:
        f.write('{"section": "Household Bigram Plots", "panel": "ec", "section_view": "bigram", '
                '"module": "Open", "code": "OPEN.001", "text": "t", "page": "ec_bigram_17.html"}\n')
    r = read_catalog(spark, p).first()
    assert (r.href_panel, r.href_view, r.page_num) == ("ec", "bigram", 17)


def test_network_sink_partitioned(spark, tmpdir_fresh):
    df = spark.createDataFrame([("OPEN.001", "big cat big cat big dog"),
                                ("OPEN.002", "red fox red fox")],
                               "question string, response string")
    net = bigram_network(df, questions=["OPEN.001", "OPEN.002"])
    q = question_dimension(spark, "ec", ["OPEN.001", "OPEN.002"])
    write_network(net, q, tmpdir_fresh)
    edges = spark.read.parquet(os.path.join(tmpdir_fresh, "edges"))
    one = edges.where((F.col("panel") == "ec") & (F.col("question_num") == 2))
    # counts red→fox 2, fox→red 1; the 95th percentile is 1.95, so only red→fox stays
    assert [(r.word1, r.word2, r.n) for r in one.collect()] == [("red", "fox", 2)]
    assert os.path.isdir(os.path.join(tmpdir_fresh, "edges", "panel=ec", "question_num=1"))


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from verbatim.session import checkpoint_dir
    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)
    fake.conf = SimpleNamespace(get=lambda key, default=None: "hdfs://shared/ckpt")
    assert checkpoint_dir(fake) == "hdfs://shared/ckpt"
    # a bare path is on the default file system
    fake.conf = SimpleNamespace(get=lambda key, default=None: "/shared/ckpt")
    for default, shared in (("hdfs://nn", True), ("file:///", False)):
        hadoop = SimpleNamespace(get=lambda key, other, default=default: default)
        fake.sparkContext._jsc = SimpleNamespace(hadoopConfiguration=lambda hadoop=hadoop: hadoop)
        if shared:
            assert checkpoint_dir(fake) == "/shared/ckpt"
        else:
            with pytest.raises(RuntimeError):
                checkpoint_dir(fake)


def _as_on_a_cluster(spark, **conf):
    """The session as it looks with a cluster's master."""
    from types import SimpleNamespace
    context = spark.sparkContext
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), range=spark.range, read=spark.read,
        sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, _jsc=context._jsc, _jvm=context._jvm,
                                     applicationId=context.applicationId, defaultParallelism=context.defaultParallelism))


def test_checkpoint_folder_that_executors_share(spark, tmpdir_fresh):
    import pytest
    from verbatim.session import checkpoint_dir
    # a mounted folder named without a scheme
    cluster = _as_on_a_cluster(spark, **{"spark.checkpoint.dir": tmpdir_fresh})
    assert checkpoint_dir(cluster) == tmpdir_fresh and os.listdir(tmpdir_fresh) == []
    # without the setting, the warehouse
    cluster = _as_on_a_cluster(spark, **{"spark.sql.warehouse.dir": f"file:{tmpdir_fresh}"})
    assert checkpoint_dir(cluster).startswith(f"file:{tmpdir_fresh}/")
    # what can't be written is not shared
    (blocked := os.path.join(tmpdir_fresh, "file")) and open(blocked, "w").close()
    with pytest.raises(RuntimeError):
        checkpoint_dir(_as_on_a_cluster(spark, **{"spark.checkpoint.dir": blocked}))


def test_waves_with_one_stem(spark, tmpdir_fresh):
    import pytest
    paths = [os.path.join(tmpdir_fresh, y, "ec.parquet") for y in ("2020", "2021")]
    for i, p in enumerate(paths):
        spark.range(i + 1).write.parquet(p)
    with pytest.raises(ValueError, match="two wave files"):
        read_waves(spark, paths)
    both = read_waves(spark, {"w20": paths[0], "w21": paths[1]})
    assert [w.count() for w in both.values()] == [1, 2]


def test_lineage_tables_are_deleted(spark):
    from verbatim.session import cut_lineage, lineage_tables
    with lineage_tables(spark) as made:
        assert cut_lineage(spark.range(5)).count() == 5
    assert len(made) == 1 and not os.path.exists(made[0].removeprefix("file:"))


def test_codes_compare_as_numbers(spark):
    from verbatim.operators.decode import decode_values
    df = spark.createDataFrame([(1.0, "1", 1), (1.5, "x", 2), (None, " 2.0", None), (2.0, "abc", 7)], "a double, b string, c int")
    codes = {c: {1: "one", 2: "two"} for c in "abc"}
    codes["b"] = {"1": "one", "2": "two", "abc": "letters"}
    table = spark.createDataFrame([(v, str(k), l) for v, m in codes.items() for k, l in m.items()], "variable string, code string, label string")
    want = [("one", "one", "one"), (None, None, "two"), (None, "two", None), ("two", "letters", None)]
    for labels in (codes, table):
        assert sorted(map(str, map(tuple, decode_values(df, labels).collect()))) == sorted(map(str, want))
    assert decode_values(df, table, exclude=["a"]).select("a").collect() == df.select("a").collect()
