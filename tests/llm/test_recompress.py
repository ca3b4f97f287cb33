"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from verbatim.llm import recompress
from verbatim.llm.common import Tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=20):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0]):
        words, gone = WORD.findall(text or ""), set()
        for s in range(len(words) - width + 1):
            window = tuple(words[s:s + width])
            if window in seen:
                gone.update(range(s, s + width))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed, vocabulary, n=50):
    """Documents that repeat passages of each other, runs of a word and periods."""
    rng, rows, texts = random.Random(seed), [], []
    for i in range(n):
        words, size = [], rng.choice([5, 30, 200, 500])
        while len(words) < size:
            r = rng.random()
            if r < 0.3 and texts:
                t = rng.choice(texts)
                a = rng.randrange(len(t))
                words += t[a:a + rng.randint(5, 90)]
            elif r < 0.4:
                words += [rng.choice(vocabulary)] * rng.randint(1, 70)
            elif r < 0.45:
                words += vocabulary[:2] * rng.randint(1, 40)
            else:
                words += rng.choices(vocabulary, k=rng.randint(1, 40))
        texts.append(words)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


def awkward_rows():
    rows = passages(1, "a b c dé".split())
    long = ["ab" * 80, "ab" * 79 + "ba"]  # words named by a hash of their own
    rows += [(198, " ".join(long * 30)), (199, " ".join(long[::-1] * 15))]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "x " * 50), (204, "x " * 20), (205, "x\n" * 19), (None, rows[41][1]), (206, rows[40][1])]
    return rows + [rows[3], rows[3], (204, "x " * 20), (205, "x\n" * 19), (201, "")]


def collected(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()], key=str)


def written(spark, base, rows):
    spark.createDataFrame([(*r, 1, 2, "s") for r in rows], "doc_id long, text string, at int, start long, name string").write.parquet(f"{base}/documents.parquet")
    return base


def test_op11_awkward(spark, tmp_path):
    base = written(spark, str(tmp_path), awkward_rows())
    assert collected(recompress.op11_substring_dedup(spark, base)) == brute(awkward_rows())


@pytest.mark.parametrize("vocabulary", [40, 3000])
def test_op11_and_sql(spark, tmp_path, vocabulary):
    rows = passages(vocabulary, [f"w{i}" for i in range(vocabulary)])
    base, want = written(spark, str(tmp_path), rows), brute(rows)
    assert collected(recompress.op11_substring_dedup(spark, base)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM read_parquet('{base}/documents.parquet/*.parquet')")
    res = con.execute(recompress.ORACLE)
    order = [[d[0] for d in res.description].index(c) for c in "doc_id n_words n_removed kept_sha256".split()]
    assert sorted([tuple(r[i] for i in order) for r in res.fetchall()], key=str) == want


def test_spans_and_kept_words(spark):
    rows = passages(9, [f"w{i}" for i in range(300)], 20)
    out = recompress.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), Tables(spark, "test"), width=12, rounds=6).collect()
    want = {r[0]: r for r in brute(rows, 12)}
    assert any(r.spans.count(",") for r in out)
    for r in out:
        words = WORD.findall(dict(rows)[r.doc_id])
        gone = {i for x in r.spans.split(",") if x for i in range(*map(int, x.split(":")))}
        assert r.kept == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r.n_words, r.n_removed) == want[r.doc_id][1:3]


def test_equal_windows_have_equal_anchors():
    """Whatever stands around a window; and most anchors are shared by several windows."""
    rng = random.Random(6)
    for vocabulary in ("a", "ab", [f"w{i}" for i in range(500)]):
        window = " ".join(rng.choices(vocabulary, k=20))
        texts = [" ".join([*rng.choices(vocabulary, k=rng.randint(0, 60)), window, *rng.choices(vocabulary, k=rng.randint(0, 60))]) for _ in range(30)] + [window]
        with np.errstate(over="ignore"):
            names, counts, words = recompress.named_words(texts)
            found, begins, ends = recompress.levels(names, counts, 3, 3)
            starts = np.concatenate([np.arange(b, e - 19) for b, e in zip(begins, ends)])
            name, place = recompress.anchors(found, starts, 20)
        words = words.to_pylist()
        by_window = {}
        for s, n in zip(starts, name):
            by_window.setdefault(tuple(words[s:s + 20]), set()).add(int(n))
        assert all(len(x) == 1 for x in by_window.values())
    assert len(set(place)) < len(place) / 2


def test_equal_passages_have_equal_symbols():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = rng.choices(vocabulary, k=1000)
    texts = [" ".join([*rng.choices(vocabulary, k=150), *passage, *rng.choices(vocabulary, k=150)]) for _ in range(2)]
    with np.errstate(over="ignore"):
        names, counts, _ = recompress.named_words(texts)
        top = recompress.levels(names, counts)[0][-1]
    inside = [{n for n, s, d, e in zip(top.names[0], top.start, top.doc, top.end) if d == i and s >= 1300 * i + 350 and e <= 1300 * i + 950} for i in (0, 1)]
    assert inside[0] == inside[1] and 10 < len(inside[0]) < 120
