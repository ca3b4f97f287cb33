"""The command line runs one panel refresh end to end from files."""

import json
import os

from pyspark.sql import functions as F

from verbatim.__main__ import main


def test_cli_provider_refresh(spark, tmpdir_fresh):
    d = tmpdir_fresh
    flags = ", ".join(f"`CC.DEMO.013_{k}` int" for k in range(1, 14))
    schema = (f"ProviderID string, Week int, UserLanguage string, `CC.DEMO.001` double, {flags}, "
              "`CC.OPEN.007` int, `FPL.2019.150` int, RaceGroup int, `CC.OPEN.001` string, "
              "`CC.MH.013` string")
    f = [None] * 13
    w1 = spark.createDataFrame([("p1", 1, "EN", 30301.0, *([None, 1] + [None] * 11), 1, 1, 2,
                                 "staff feel tired", "sleep more")], schema)
    w2 = spark.createDataFrame([("p1", 30, "SPA", None, *f, 1, None, None, "staff feel tired", "")],
                               schema)
    w1.write.parquet(os.path.join(d, "cc_2021.parquet"))
    w2.write.parquet(os.path.join(d, "cc_2022.parquet"))
    with open(os.path.join(d, "US.txt"), "w") as fh:
        fh.write("US\t30301\tAtlanta\tGeorgia\tGA\tFulton\t121\t\t\t33.7\t-84.4\t4\n")
    spark.createDataFrame([("cc", "FPL.2019.150", 1, "Yes"), ("cc", "RaceGroup", 2, "Black")],
                          "panel string, variable string, code int, label string") \
        .write.parquet(os.path.join(d, "vl.parquet"))
    with open(os.path.join(d, "menu.json"), "w") as fh:
        for code, page in [("CC.OPEN.001", "cc_bigram_1.html"), ("CC.MH.013", "cc_bigram_18.html")]:
            fh.write(json.dumps({"section": "s", "panel": "cc", "section_view": "bigram",
                                 "module": "m", "code": code, "text": "t", "page": page}) + "\n")
    out = os.path.join(d, "out")
    main(["--panel", "cc", "--waves", os.path.join(d, "cc_2021.parquet"),
          os.path.join(d, "cc_2022.parquet"), "--gazetteer", os.path.join(d, "US.txt"),
          "--value-labels", os.path.join(d, "vl.parquet"), "--catalog", os.path.join(d, "menu.json"),
          "--out", out, "--allow-missing"], spark=spark)
    resp = spark.read.parquet(os.path.join(out, "responses"))
    rows = sorted((r.Week, r.question, r.State, r.below_1_5x_fpl, r.RaceGroup, r.provider_type,
                   r.Language) for r in resp.collect())
    # week 30 carries State, poverty flag, race and provider type forward from week 1
    assert rows == [(1, "CC.MH.013", "GA", "Yes", "Black", "Center director", "English"),
                    (1, "CC.OPEN.001", "GA", "Yes", "Black", "Center director", "English"),
                    (30, "CC.OPEN.001", "GA", "Yes", "Black", "Center director", "Spanish")]
    edges = spark.read.parquet(os.path.join(out, "edges")).where(F.col("question_num") == 1)
    assert {(r.word1, r.word2, r.n) for r in edges.collect()} == {("staff", "feel", 2),
                                                                   ("feel", "tired", 2)}
    audit = {r.code: r.status for r in spark.read.parquet(os.path.join(out, "catalog_audit"))
             .where("view = 'bigram'").collect()}
    assert audit["CC.OPEN.001"] == "ok" and audit["CC.MH.013"] == "wrong_page"
    assert spark.read.parquet(os.path.join(out, "question_index")).count() == 39


def test_cli_publishes_versions(spark, tmpdir_fresh):
    """Two refreshes with ``--publish``: the second one's answers, and the first still there for who holds it."""
    from verbatim.plans.publish import Published
    d, out = tmpdir_fresh, os.path.join(tmpdir_fresh, "out")
    flags = ", ".join(f"`CC.DEMO.013_{k}` int" for k in range(1, 14))
    cc = (f"ProviderID string, Week int, UserLanguage string, `CC.DEMO.001` double, {flags}, `CC.OPEN.007` int, "
          "`FPL.2019.150` int, RaceGroup int, `CC.OPEN.001` string")
    held = None
    for i, text in enumerate(["staff feel tired", "staff feel_fine fine"]):
        path = os.path.join(d, f"cc_{i}.parquet")
        spark.createDataFrame([("p1", 1, "EN", 1.0, *[None] * 13, 1, 1, 2, text)], cc).write.parquet(path)
        main(["--panel", "cc", "--waves", path, "--out", out, "--allow-missing", "--publish", "--unicode-words"], spark=spark)
        held = held or Published(spark, out).page("responses", "cc", 1)
    pages = Published(spark, out)
    assert [r.response for r in pages.page("responses", "cc", 1).collect()] == ["staff feel_fine fine"]
    assert [r.response for r in held.collect()] == ["staff feel tired"]
    assert pages.table("question_index").count() == 39 and pages.manifest()["number"] == 2
    assert {(r.word1, r.word2) for r in pages.page("edges", "cc", 1).collect()} == {("staff", "feel_fine"), ("feel_fine", "fine")}


def test_cli_panels_live_side_by_side(spark, tmpdir_fresh):
    d, out = tmpdir_fresh, os.path.join(tmpdir_fresh, "out")
    ec = ("CaregiverID string, Week int, UserLanguage string, `DEMO.001` double, `DEMO.004.a.2` int, `OPEN.006` int, "
          "`FPL.2019.150` int, RaceGroup int, CaregiverAge int, `OPEN.001` string, `MH.014` string")
    spark.createDataFrame([("c1", 1, "EN", 30301.0, 2, 1, 1, 1, 3, "rent money rent money", "sleep")], ec).write.parquet(os.path.join(d, "ec_1.parquet"))
    flags = ", ".join(f"`CC.DEMO.013_{k}` int" for k in range(1, 14))
    cc = (f"ProviderID string, Week int, UserLanguage string, `CC.DEMO.001` double, {flags}, `CC.OPEN.007` int, "
          "`FPL.2019.150` int, RaceGroup int, `CC.OPEN.001` string")
    spark.createDataFrame([("p1", 1, "EN", 1.0, *[None] * 13, 1, 1, 2, "staff feel tired")], cc).write.parquet(os.path.join(d, "cc_1.parquet"))
    spark.createDataFrame([("money",)], "word string").write.parquet(os.path.join(d, "stop.parquet"))
    for panel in ("ec", "cc", "ec"):
        main(["--panel", panel, "--waves", os.path.join(d, f"{panel}_1.parquet"), "--stop-words", os.path.join(d, "stop.parquet"),
              "--out", out, "--allow-missing"], spark=spark)
    resp = spark.read.parquet(os.path.join(out, "responses"))
    assert sorted((r.panel, r.question) for r in resp.collect()) == [("cc", "CC.OPEN.001"), ("ec", "MH.014"), ("ec", "OPEN.001")]
    assert {r.panel for r in spark.read.parquet(os.path.join(out, "question_index")).collect()} == {"ec", "cc"}
    edges = {(r.panel, r.word1, r.word2) for r in spark.read.parquet(os.path.join(out, "edges")).collect()}
    assert ("cc", "staff", "feel") in edges and not any("money" in e for e in edges)
    tables = os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "verbatim-tables")
    assert not [n for n in os.listdir(tables) if n.startswith("bigram-counts")] if os.path.isdir(tables) else True


def test_shrunk_question_list_leaves_no_stale_page(spark, tmpdir_fresh):
    from verbatim.operators.audit import question_dimension
    from verbatim.plans.sinks import write_responses
    long = spark.createDataFrame([("A", "x"), ("B", "y")], "question string, response string")
    out = os.path.join(tmpdir_fresh, "o")
    write_responses(long, question_dimension(spark, "ec", ["A", "B"]), out)
    write_responses(long, question_dimension(spark, "cc", ["B"]), out)
    write_responses(long, question_dimension(spark, "ec", ["A"], {"A": "What now?"}), out)
    got = sorted((r.panel, r.question_num, r.question, r.question_text, r.title) for r in spark.read.parquet(f"{out}/responses").collect())
    assert got == [("cc", 1, "B", "B", "Question 1"), ("ec", 1, "A", "What now?", "Question 1")]
