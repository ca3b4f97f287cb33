"""The nested menu: paths, panels, views and every drift of the survey."""

import json
import os

import pytest

from verbatim.operators.audit import catalog_audit, number_questions
from verbatim.plans.panels import CC, EC
from verbatim.plans.reports import panel_questions
from verbatim.sources.menu import menu_questions, read_menu


def item(text, href=None, menu=None):
    return {k: v for k, v in (("text", text), ("href", href), ("menu", menu)) if v is not None}


def written(folder, left, right=()):
    path = os.path.join(folder, "site.json")
    with open(path, "w") as f:
        json.dump({"name": "x", "navbar": {"title": "t", "left": left, "right": list(right)}, "output": {"html": True}}, f, indent=1)
    return path


def test_entries_at_any_level(spark, tmpdir_fresh):
    left = [item("Household Bigram Plots", menu=[
        item("Open", menu=[item("OPEN.001: What?", "ec_bigram_1.html"), item("FSTR.008. How?", "ec_bigram_43.html"), item("JOB.040.a: Why: so?", "ec_bigram_44.html")]),
        item("Straight OPEN.002: no code", "ec_bigram_2.html"), item("Empty", menu=[])]),
        item("Provider Response Tables", menu=[item("M", menu=[item("Sub", menu=[item("CC.VACC.003.1: x", "cc_responses_27.html"), item(None, "cc_responses_1.html")])])]),
        item("Alone: top", "index.html")]
    rows = {tuple(r.place): r for r in read_menu(spark, written(tmpdir_fresh, left, [item("About", "about.html")])).collect()}
    assert sorted(rows) == [(0, 0, 0, 0), (0, 0, 0, 1), (0, 0, 0, 2), (0, 0, 1), (0, 1, 0, 0, 0), (0, 1, 0, 0, 1), (0, 2), (1, 0)]
    r = rows[0, 0, 0, 0]
    assert (r.path, r.section, r.panel, r.section_view, r.module, r.code, r.href_panel, r.href_view, r.page_num) == \
        (["Household Bigram Plots", "Open", "OPEN.001: What?"], "Household Bigram Plots", "ec", "bigram", "Open", "OPEN.001", "ec", "bigram", 1)
    assert [rows[0, 0, 0, i].code for i in (1, 2)] == ["FSTR.008", "JOB.040.a"]
    assert rows[0, 0, 1].code is None and rows[0, 0, 1].module is None
    deep = rows[0, 1, 0, 0, 0]
    assert (deep.panel, deep.section_view, deep.module, deep.code, deep.page_num) == ("cc", "responses", "Sub", "CC.VACC.003.1", 27)
    assert rows[0, 1, 0, 0, 1].text is None and rows[0, 2].code == "Alone" and rows[1, 0].panel is None


def test_deeper_than_allowed_and_no_menu(spark, tmpdir_fresh):
    left = [item("Household Bigram Plots", menu=[item("Open", menu=[item("OPEN.001: What?", "ec_bigram_1.html")])])]
    path = written(tmpdir_fresh, left)
    assert read_menu(spark, path, depth=3).count() == 1
    with pytest.raises(Exception, match="deeper than 2 levels under: Household Bigram Plots / Open"):
        read_menu(spark, path, depth=2).collect()
    with open(os.path.join(tmpdir_fresh, "bad.json"), "w") as f:
        f.write("{not json")
    with pytest.raises(Exception):
        read_menu(spark, os.path.join(tmpdir_fresh, "bad.json")).collect()
    with open(os.path.join(tmpdir_fresh, "none.json"), "w") as f:
        f.write('{"name": "x"}')
    assert read_menu(spark, os.path.join(tmpdir_fresh, "none.json")).count() == 0


def test_every_drift_of_the_survey_from_the_nested_menu(spark, tmpdir_fresh):
    """A right menu but for the drifts of SURVEY trap 17: the audit finds these and no others."""
    questions = {"ec": list(EC.question_codes), "cc": list(CC.question_codes)}
    number = {p: {c: i + 1 for i, c in enumerate(codes)} for p, codes in questions.items()}
    links = {(p, v, c): f"{p}_{v}_{n}.html" for p in number for c, n in number[p].items() for v in ("bigram", "responses")}
    want = {}

    def drift(panel, view, code, page, status, instead=None):
        links.pop((panel, view, instead), None)
        if instead:
            want[panel, view, instead] = "missing_in_menu"
        links[panel, view, code] = page
        want[panel, view, code] = status

    for i in (16, 17, 18):                                                        # 17a
        drift("ec", "responses", f"FamCon.0{i}", f"ec_responses_{number['ec'][f'FamCon.0{i}'] + 1}.html", "wrong_page")
    drift("ec", "responses", "GRAND.016", "ec_bigram_19.html", "wrong_view")      # 17b
    too_far = ("OPEN.009 OPEN.010 OPEN.011 Access.002 CTAX.029 FoodAid.002 FoodAid.005 FoodAid.007 "
               "HEALTH.039 Inflation.004 ProvDebt.007 Violence.002").split()
    for view in ("bigram", "responses"):
        drift("ec", view, "JOB.040", f"ec_{view}_44.html", "unknown_code", "JOB.040.a")   # 17c
        for name in too_far:                                                      # 17e
            n = number["cc"][f"CC.{name}"] + 1
            drift("cc", view, f"CC.{name}", f"cc_{view}_{n}.html", "wrong_page" if n <= len(questions["cc"]) else "page_out_of_range")
        drift("cc", view, "CC.VACC.003.1", f"cc_{view}_27.html", "unknown_code")  # 17d
        drift("cc", view, "CC.Fam.003", f"cc_{view}_40.html", "page_out_of_range")  # 17f
        for i in (16, 17, 18):                                                    # 17g: labelled as debt questions
            links.pop(("cc", view, f"CC.FamCon.0{i}"))
            want["cc", view, f"CC.FamCon.0{i}"] = "missing_in_menu"
        for code, page in (("CC.DEBT.005", 14), ("CC.DEBT.006", 15)):
            if code in number["cc"]:
                drift("cc", view, code, f"cc_{view}_{page}.html", "ok" if number["cc"][code] == page else "wrong_page")
            else:
                drift("cc", view, code, f"cc_{view}_{page}.html", "unknown_code")
    titles = {("ec", "bigram"): "Household Bigram Plots", ("ec", "responses"): "Household Response Tables",
              ("cc", "bigram"): "Provider Bigram Plots", ("cc", "responses"): "Provider Response Tables"}
    left = []
    for key, title in titles.items():
        modules = {}
        for (p, v, code), page in links.items():
            if (p, v) == key:
                modules.setdefault(code.split(".")[0], []).append(item(f"{code}: What about it?", page))
        left.append(item(title, menu=[item(f"{m} module", menu=entries) for m, entries in modules.items()]))
    entries = menu_questions(read_menu(spark, written(tmpdir_fresh, left)))
    dims = panel_questions(spark, EC).unionByName(panel_questions(spark, CC))
    got = {(r.panel, r.view, r.code): r.status for r in catalog_audit(entries, dims).collect()}
    assert {k: s for k, s in got.items() if s != "ok"} == {k: s for k, s in want.items() if s != "ok"}
    assert len(got) == len(links) + sum(s == "missing_in_menu" for s in want.values())


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_numbering_over_ranges(spark, parts):
    codes = [f"Q{i:03d}" for i in range(100)] + ["a", None, "Z"]
    df = spark.createDataFrame([(c,) for c in codes * 2], "code string")
    out = number_questions(df, "p", num_partitions=parts)
    rows = sorted(((r.num, r.code) for r in out.collect()))
    assert rows == [(i + 1, c) for i, c in enumerate(sorted(codes, key=lambda c: (c is not None, c or "")))]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert number_questions(df.where("false"), "p").count() == 0
