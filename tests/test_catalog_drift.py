"""The audit finds each kind of menu drift against the configured question lists."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from verbatim.operators.audit import catalog_audit
from verbatim.operators.graph import bigram_network
from verbatim.plans.panels import CC, EC
from verbatim.plans.reports import panel_questions
from verbatim.plans.testdata import responses
from verbatim.sources.catalog import parse_page


def test_menu_drift_kinds(spark):
    entries = [
        ("ec", "bigram", "OPEN.001", "ec_bigram_1.html"),             # ok
        ("ec", "responses", "FamCon.016", "ec_responses_17.html"),    # page of the next question
        ("ec", "responses", "GRAND.016", "ec_bigram_19.html"),        # bigram page in responses menu
        ("ec", "bigram", "JOB.040", "ec_bigram_44.html"),             # code is JOB.040.a
        ("cc", "bigram", "CC.OPEN.009", "cc_bigram_28.html"),         # one page too far
        ("cc", "bigram", "CC.Fam.003", "cc_bigram_40.html"),          # 39 questions only
        ("cc", "bigram", "CC.VACC.003.1", "cc_bigram_27.html"),       # code no longer asked
    ]
    menu = spark.createDataFrame(entries, "panel string, section_view string, code string, page string")
    menu = menu.select("*", *parse_page(F.col("page")))
    questions = panel_questions(spark, EC).unionByName(panel_questions(spark, CC))
    got = {(r.code, r.view): r.status for r in catalog_audit(menu, questions).collect()}
    assert got[("OPEN.001", "bigram")] == "ok"
    assert got[("FamCon.016", "responses")] == "wrong_page"
    assert got[("GRAND.016", "responses")] == "wrong_view"
    assert got[("JOB.040", "bigram")] == "unknown_code"
    assert got[("JOB.040.a", "bigram")] == "missing_in_menu"
    assert got[("CC.OPEN.009", "bigram")] == "wrong_page"
    assert got[("CC.Fam.003", "bigram")] == "page_out_of_range"
    assert got[("CC.VACC.003.1", "bigram")] == "unknown_code"
    # every configured question × view is accounted for exactly once, plus two strays
    assert len(got) == 2 * (len(EC.question_codes) + len(CC.question_codes)) + 2


def test_every_drift_of_the_survey(spark):
    """SURVEY trap 17, a to g: each entry of the published menu that is wrong."""
    both = ("bigram", "responses")
    entries, want = [], {}

    def entry(panel, view, code, page, status):
        entries.append((panel, view, code, page))
        want[panel, view, code, page] = status

    for i in (16, 17, 18):                                                     # 17a
        entry("ec", "responses", f"FamCon.0{i}", f"ec_responses_{i + 1}.html", "wrong_page")
    entry("ec", "responses", "GRAND.016", "ec_bigram_19.html", "wrong_view")   # 17b
    for view in both:
        entry("ec", view, "JOB.040", f"ec_{view}_44.html", "unknown_code")     # 17c
        entry("cc", view, "CC.VACC.003.1", f"cc_{view}_27.html", "unknown_code")  # 17d
        entry("cc", view, "CC.Fam.003", f"cc_{view}_40.html", "page_out_of_range")  # 17f
        for page in (14, 15):                                                  # 17g
            code = f"CC.DEBT.00{page - 9}"
            entry("cc", view, code, f"cc_{view}_{page}.html", "wrong_page")
        entry("cc", view, "CC.DEBT.006", f"cc_{view}_16.html", "wrong_page")
    number = {c: i + 1 for i, c in enumerate(CC.question_codes)}
    too_far = ("OPEN.009 OPEN.010 OPEN.011 Access.002 CTAX.029 FoodAid.002 FoodAid.005 FoodAid.007 "
               "HEALTH.039 Inflation.004 ProvDebt.007 Violence.002").split()
    for name in too_far:                                                       # 17e
        code = f"CC.{name}"
        for view in both:
            page = number[code] + 1
            entry("cc", view, code, f"cc_{view}_{page}.html",
                  "wrong_page" if page <= len(number) else "page_out_of_range")
    menu = spark.createDataFrame(entries, "panel string, section_view string, code string, page string")
    menu = menu.select("*", *parse_page(F.col("page")))
    questions = panel_questions(spark, EC).unionByName(panel_questions(spark, CC))
    rows = catalog_audit(menu, questions).collect()
    got = {(r.panel, r.view, r.code, r.page_num): r.status for r in rows}
    for (panel, view, code, page), status in want.items():
        n = int(page.rsplit("_", 1)[1].removesuffix(".html"))
        assert got[panel, view, code, n] == status, (panel, view, code, page)
    missing = {(r.view, r.code) for r in rows if r.status == "missing_in_menu"}
    assert {(v, f"CC.FamCon.0{i}") for v in both for i in (16, 17, 18)} <= missing
    assert {(v, "JOB.040.a") for v in both} <= missing


def test_link_to_the_other_panel_and_without_page(spark):
    menu = spark.createDataFrame([("ec", "bigram", "OPEN.001", "cc_bigram_1.html"), ("ec", "responses", "OPEN.001", "index.html")],
                                 "panel string, section_view string, code string, page string")
    menu = menu.select("*", *parse_page(F.col("page")))
    got = {r.view: r.status for r in catalog_audit(menu, panel_questions(spark, EC)).collect() if r.code == "OPEN.001"}
    assert got == {"bigram": "wrong_panel", "responses": "wrong_panel"}


def test_network_properties_on_documents(spark):
    net = bigram_network(responses(spark, SF_SMALL))
    counts, edges, vertices = net.counts, net.edges, net.vertices
    # edges ⊆ counts, with the same n
    assert edges.exceptAll(counts.select(*edges.columns)).count() == 0
    # every edge end is a vertex of the same question, and every vertex is an edge end
    ends = edges.select("question", F.explode(F.array("word1", "word2")).alias("name")).distinct()
    assert ends.exceptAll(vertices).count() == 0 and vertices.exceptAll(ends).count() == 0
    # each question keeps at least its most frequent bigram (cut ≤ max n)
    top = counts.groupBy("question").agg(F.max("n").alias("m"))
    kept = edges.groupBy("question").agg(F.max("n").alias("m"))
    assert top.exceptAll(kept).count() == 0
