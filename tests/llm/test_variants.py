"""Spelling variants against a comparison of all pairs of words."""

import collections
import random
import re
import zlib

import duckdb
import pytest

from verbatim.llm import variants
from verbatim.llm.common import Tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def counts(texts, one_in=97):
    out = collections.Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % one_in else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return out


def brute(n):
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in close.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted([(w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n], key=str)


def collected(df):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()], key=str)


def texts():
    rng = random.Random(5)
    stock = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(120)]
    stock += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "Ärgerlich", "ärgerlich", "×÷×÷×", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1500]
    rows = [(i if i % 9 else None, " ".join(rng.choices(stock, [1 + 40 / (k + 1) for k in range(len(stock))], k=90)).title() + ", 12.") for i in range(40)]
    return rows + [(100, None), (101, ""), (102, " \n"), (103, "one two")] + [(104, " ".join(stock[-11:]))] * 3


@pytest.fixture(scope="module")
def spelled(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("spelled"))
    rows = [(*r, 1, "a", "b") for r in texts()]
    spark.createDataFrame(rows, "doc_id long, text string, n long, word string, state string").write.parquet(f"{base}/documents.parquet")
    return base


@pytest.fixture(scope="module")
def wanted():
    return brute({w: k for w, k in counts(texts()).items() if len(w) >= 5 and k >= 3})


def test_op13_awkward(spark, spelled, wanted):
    got = collected(variants.op13_spelling_variants(spark, spelled))
    assert got == wanted
    assert any(r[1] and r[2] != r[1] for r in got) and any(len(r[0]) == 3000 for r in got)


def test_op13_sql_on_awkward(spelled, wanted):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM read_parquet('{spelled}/documents.parquet/*.parquet')")
    res = con.execute(variants.ORACLE)
    order = [[d[0] for d in res.description].index(c) for c in "word form root n n_near form_n".split()]
    assert sorted([tuple(r[i] for i in order) for r in res.fetchall()], key=str) == wanted


def test_large_states_are_split(spark):
    """With at most three words a state: every split, down to single letters."""
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))): rng.randint(1, 50) for _ in range(150)}
    tables = Tables(spark, "test")
    got = collected(variants.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"), tables, most=3))
    assert got == brute(words)


def test_composition_accepts_every_pair_once():
    rng = random.Random(2)
    for _ in range(40):
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(60)}
        got = [frozenset(p) for p in variants.composed(words)]
        assert len(got) == len(set(got))
        assert set(got) == {frozenset((u, v)) for u in words for v in words if u < v and near(u, v)}


def test_acceptor_is_minimal():
    arcs, final, start = variants.acceptor(["tap", "taps", "top", "tops"])
    states, todo = set(), [start]
    while todo:
        s = todo.pop()
        if s not in states:
            states.add(s)
            todo += arcs[s].values()
    assert len(states) == 5 and sum(final[s] for s in states) == 2
