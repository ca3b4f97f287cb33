"""Each operator's query against a brute-force version on the awkward table."""

import collections
import hashlib
import math
import os
import re
import subprocess
import sys
import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from verbatim.llm import ann, bpe, cws, langid, lines, lm, mixing, registry, secrets, shards, simhash
from verbatim.llm.common import Tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(x):
    return -(1 << 63) if x is None else x


def collected(df, *names):
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=str)


def test_every_query_takes_an_empty_table(spark, empty):
    for name, query in registry.QUERIES.items():
        assert query(spark, empty).count() == 0, name


def test_op1_counts_and_base(spark, awkward, texts):
    out = lm.op1_lm_score(spark, awkward).collect()
    tokens = [(i, [*words((t or "").translate(LOWER)), None]) for i, t in texts]
    c = collections.Counter(w for i, ws in tokens if crc(i) % 10 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, crc(i) % 10 == 0, len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tokens), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str)
    assert got == want
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the model predicts better than the base
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_op1_estimates_follow_the_formula():
    counts, codes, hashes = lm.encode_block(["a b a", None, "b"])
    assert counts.tolist() == [4, 1, 2] and codes[[3, 4, 6]].tolist() == [lm.END] * 3
    before, pairs = lm.pair_hashes(codes, counts, hashes)
    assert before[[0, 4, 5]].tolist() == [lm.START] * 3
    assert len(set(pairs.tolist())) == 7  # ^a ab ba a$ ^$ ^b b$
    found = {"context": np.array([2, 0]), "pair": np.array([1, 0]), "word": np.array([3, 0])}
    assert np.allclose(lm.estimates(found, 10, 4), [[0.5, 0.3, 0.2], [0, 0, 0.2]])
    assert lm.bucket(np.array([0, 1, 2, 3, 4])).tolist() == [0, 1, 2, 2, 3]


def test_op1_ranges_grow_with_the_corpus(spark, awkward, monkeypatch):
    names = ("doc_id", "n_tokens", "n_known", "base_score", "score")
    want = collected(lm.op1_lm_score(spark, awkward), *names)
    counts, entries = [], lm.entries
    monkeypatch.setattr(lm, "entries", lambda blocks, count: counts.append(count) or entries(blocks, count))
    monkeypatch.setattr(lm, "RANGE_ENTRIES", 500, raising=False)
    got = collected(lm.op1_lm_score(spark, awkward), *names)
    tokens = sum(r[1] for r in want)
    assert counts[0] >= tokens / 500 > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3:] for g in got], [w[3:] for w in want])


def test_op1_weights_by_em(spark):
    # tokens of one bucket that only the unigram explains: its weight goes to 1
    p = np.tile(np.array([[0.0, 0.5, 0.01]], np.float32), (100, 1))
    df = spark.createDataFrame([(bytearray(np.full(100, 3, np.uint8).tobytes()), bytearray(p.tobytes()))], "buckets binary, estimates binary")
    weights = lm.learn_weights(df)
    assert np.allclose(weights.sum(axis=1), 1) and weights[3, 1] > 0.95 and weights[3, 0] < 0.02


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_str(bpe.public_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_op2_equals_the_library(spark, awkward, texts, library):
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert collected(bpe.op2_bpe(spark, awkward), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def test_op2_random_texts(library):
    coder, rng = bpe.bpe(bpe.public_vocabulary()), np.random.default_rng(1)
    alphabet = [*" \n\t\r\x0b\x1c\x85\xa0 ​　﻿", "a", "the", "'s", "1", "½", "é", "中", "\U0001f600", "!", "<|endoftext|>", "  ", "ͅ"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.integers(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for _ in range(3000):
        text = "".join(rng.choice(list("abcdeinrstoh")) for _ in range(rng.integers(1, 40)))
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert coder.decode([10**6, 0]) == coder.decode([0])


def brute_fingerprint(text):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, most):
    left, out = dict.fromkeys(fps), {}
    for f in fps:
        if f in out:
            continue
        wait, group = [f], {f}
        while wait:
            x = wait.pop()
            near = [y for y in left if y not in group and (x ^ y).bit_count() <= most]
            group.update(near)
            wait += near
        out |= dict.fromkeys(group, f)
    return out


def test_op3_components(spark, awkward, texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    root = components(fps, 4)
    least = {}
    for (i, _), f in zip(texts, fps):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(texts, fps)), key=str)
    assert collected(simhash.op3_simhash(spark, awkward), "doc_id", "fingerprint", "component_id") == want


def test_op3_keys_find_every_link():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for errors in range(5):
        other = fps.copy()
        for i in range(len(fps)):
            for b in rng.choice(64, errors, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(b)
        mine, theirs = collections.defaultdict(set), collections.defaultdict(set)
        for store, values in ((mine, fps), (theirs, other)):
            for k, f in simhash.keys(values):
                for a, b in zip(k.tolist(), f.tolist()):
                    store[b].add(a)
        assert all(mine[a] & theirs[b] for a, b in zip(fps.tolist(), other.tolist())), errors


def test_op3_chains_and_families(spark):
    # chains of 3 bits a step, and a family of many near copies of one fingerprint
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(20):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(12):
            fps.add(x)
            for b in rng.choice(64, 3, replace=False):
                x ^= 1 << int(b)
    x = int(rng.integers(0, 1 << 63))
    fps |= {x ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)} | {0, (1 << 64) - 1}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.stars(simhash.links(df), Tables(spark, "t")).collect()}
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    truth = components(list(fps), 4)
    for f in fps:
        got[roots.get(f, f)].add(f)
        want[truth[f]].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_op3_keep_one(spark, awkward, texts):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    found = simhash.near_duplicates(docs, Tables(spark, "t")).collect()
    assert sorted(ids, key=str) == sorted([i for _, i in {(r.root, r.component_id) for r in found}], key=str)
    assert ids.count(None) == 2


def test_op3_one_id_in_two_components(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(3, text), (5, text), (5, "quite another text with nothing in common at all")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == sorted([text, "quite another text with nothing in common at all"])
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [3, 5]


RULES = [("assign", re.compile(secrets.ASSIGN, re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def test_op4_base_rules(spark, awkward, texts):
    want = []
    for i, t in texts:
        spans = sorted((m.start(), n, m.end()) for n, (_, p, g, least) in enumerate(RULES) for m in p.finditer(t or "") if len(m[g]) >= least)
        written = ",".join(f"{RULES[n][0]}:{a}:{b}" for a, n, b in spans)
        want.append((i, *(sum(s[1] == n for s in spans) for n in range(3)), sha(written), written))
    got = secrets.op4_secrets(spark, awkward)
    base = [(*r[:-1], ",".join(s for s in r[-1].split(",") if not s.startswith("model"))) for r in collected(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")]
    assert sorted(base, key=str) == sorted(want, key=str)
    assert any(r.n_assign for r in got.collect()) and any(r.n_access for r in got.collect())


def test_op4_model_finds_random_tokens(spark):
    ordinary = "identifier_name stationmaster anotherriver everything camelCaseName whiteHouses version_2 the_river_house_2nd_edition_of_that "
    random_token = "Zx81kQpW7vLm3RtB9nHs2YcD"
    docs = spark.createDataFrame([(i, ordinary * 20) for i in range(20)] + [(99, f"see {random_token} and {ordinary}"), (100, f"token={random_token}")], "doc_id long, text string")
    out = {r.doc_id: r for r in secrets.scan(docs, secrets.labelled(docs), Tables(spark, "t")).select("doc_id", secrets.written(secrets.F.col("spans")).alias("s")).collect()}
    assert out[99].s == f"model:4:{4 + len(random_token)}"
    assert out[100].s == f"assign:0:{6 + len(random_token)}"  # the base match covers the candidate
    assert out[0].s == ""


def test_op4_no_python(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for df in (secrets.scan(docs, secrets.labelled(docs), Tables(spark, "t")), lines.line_decisions(docs, Tables(spark, "t")), lines.drop_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 3 * sizes[s] + 1e-9]
        if not over:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= set(over)


def test_op5_targets_and_copies(spark, awkward, texts):
    out = mixing.op5_mix_sources(spark, awkward).collect()
    docs = [(r.doc_id, r.source, len(words(r.text))) for r in spark.read.parquet(f"{awkward}/documents.parquet").collect()]
    sizes = collections.Counter()
    for _, s, n in docs:
        sizes[s] += n
    target = brute_targets(sizes)
    assert sorted(((r.doc_id, r.source, r.size) for r in out), key=str) == sorted(docs, key=str)
    taken = collections.Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert r.copies >= math.floor(r.target / r.source_size + 1e-12) if r.source_size else True
        taken[r.source] += r.taken
    for s in sizes:
        largest = max(n for _, t, n in docs if t == s)
        assert abs(taken[s] - target[s]) <= largest
    again = mixing.op5_mix_sources(spark, awkward)
    assert collected(again, "doc_id", "size", "taken") == sorted(((r.doc_id, r.size, r.taken) for r in out), key=str)


def test_op5_unequal_targets_and_refinement(spark, monkeypatch):
    # few rows a bin, so the end is found by several rounds of histograms
    monkeypatch.setattr(mixing, "LAST_ROWS", 50)
    data = [(i, f"{'abc'[i % 3] if i % 10 else 'a'}", 1 + i % 7, float(1 + i % 2)) for i in range(4000)] + [(5000, None, 9, 1.0)]
    df = spark.createDataFrame(data, "doc_id long, source string, size long, weight double").withColumn("key", mixing.F.xxhash64("doc_id"))
    tables = Tables(spark, "t")
    rows = tables.put(df, "rows")
    out = mixing.apply_mix(rows, mixing.plan_mix(rows, tables)).collect()
    target, taken, by_weight, number = {}, collections.Counter(), collections.Counter(), collections.Counter()
    for r in out:
        target[r.source] = r.target
        taken[r.source] += r.copies * r.size
        by_weight[r.source, r.weight] += r.copies
        number[r.source, r.weight] += 1
    assert len(out) == len(data)
    assert all(abs(taken[s] - target[s]) <= 4 for s in "abc")
    # twice the weight: about twice the copies where nothing is capped
    rate = [by_weight["a", w] / number["a", w] for w in (1.0, 2.0)]
    assert 1.6 < rate[1] / rate[0] < 2.5


@pytest.mark.parametrize("weight", [1.0, 0.1])
def test_op5_whole_copies_fill_nothing(spark, weight):
    for sizes, copies in ({"a": 300}, {"a": 1}), ({"a": 900, "b": 60}, {"b": 3}):
        data = [(i, s, 2, weight) for s, n in sizes.items() for i in range(n)]
        df = spark.createDataFrame(data, "doc_id long, source string, size long, weight double").withColumn("key", mixing.F.xxhash64("doc_id", "source"))
        tables = Tables(spark, "t")
        rows = tables.put(df, "rows")
        plan = mixing.plan_mix(rows, tables)
        done = list(copies)
        assert plan[2].where(mixing.F.col("source").isin(done)).isEmpty()
        out = mixing.apply_mix(rows, plan).collect()
        assert len(out) == len(data) and {(r.source, r.copies) for r in out if r.source in done} == set(copies.items())


def test_op5_mix_keeps_columns(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = collections.Counter()
    for r in mixing.op5_mix_sources(spark, awkward).collect():
        want[r.doc_id] += r.copies
    assert collections.Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +want


def test_op6_files(spark, awkward, texts, library):
    want, start = [], 0
    for i, t in sorted(texts, key=lambda r: (key(r[0]), r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert collected(shards.op6_token_shards(spark, awkward), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)


def test_op6_coder_equals_the_library(library):
    coder, rng = shards.LibraryCoder(bpe.public_vocabulary()), np.random.default_rng(3)
    alphabet = [*" \n\t\x1c\xa0\u2003", "a", " the", " river's", "1", " é", "中", "\U0001f600", "!", "<|endoftext|>", "  ", " \n", "\u0345"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.integers(0, 30))) for _ in range(4000)]
    kind = np.dtype(f"<u{coder.width}")
    assert [np.frombuffer(x, kind).tolist() for x in coder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_op6_rotation_and_absent_keys(spark, awkward, monkeypatch):
    # the writer runs in other processes: limits go with the function's module, so only the
    # index is tested at small size here
    at, copy = np.arange(50_000) * 7 - 1000, np.zeros(50_000, np.int64)
    raw = shards.pack_index(at, copy, at * 2, at * 3, at * 5)
    index = shards.Index(raw)
    there, entry = index.find(at, copy)
    assert there.all() and (entry["shard"] == at * 2).all() and (entry["offset"] == at * 3).all() and (entry["n"] == at * 5).all()
    assert index.find(at + 1, copy)[0].sum() <= 1 and index.find(at, copy + 1)[0].sum() <= 1
    slots = shards.PerfectHash.build(shards.key_hash(at, copy)).slots(shards.key_hash(at, copy))
    assert sorted(slots.tolist()) == list(range(50_000))
    with pytest.raises(ValueError):
        shards.PerfectHash.build(np.array([1, 1], np.uint64))
    assert not shards.Index(shards.pack_index(at[:0], copy[:0], at[:0], at[:0], at[:0])).find(at[:3], copy[:3])[0].any()


def vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    same = rng.normal(size=16).tolist()
    data += [(1000 + i, same) for i in range(60)]  # more copies than are wanted
    data += [(700, None), (720, [0.0] * 16), (740, [float("nan")] * 16), (760, [None] + [1.0] * 15), (780, [float("inf")] + [0.0] * 15), (None, same), (0, data[0][1])]
    return spark.createDataFrame(data, "vec_id long, vector array<float>"), data


def test_op7_against_brute_force(spark):
    df, data = vectors(spark)
    rows = ann.valid(df, "vec_id", "vector")
    out = ann.search(rows.where("vec_id % 20 = 0"), rows, Tables(spark, "t"), k=20)
    good = {i: np.array(v, np.float32).astype(float) for i, v in data if i is not None and i not in (700, 720, 740, 760, 780)}
    got = collections.defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        assert abs(r.score - good[r.query_id] @ good[r.vec_id]) < 1e-9
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    queries = [i for i in good if i % 20 == 0]
    assert set(got) == set(queries)
    hits = 0
    for q in queries:
        exact = sorted((i for i in good if i != q), key=lambda i: (-round(float(good[q] @ good[i]), 9), i))[:20]
        hits += len(set(exact) & {v for _, v, _ in got[q]})
        assert [r for r, _, _ in got[q]] == list(range(1, 21)) and [(-s, v) for _, v, s in got[q]] == sorted((-s, v) for _, v, s in got[q])
        assert q not in {v for _, v, _ in got[q]}
    assert hits / (20 * len(queries)) >= 0.9
    assert [v for _, v, _ in got[1000]][:20] == list(range(1001, 1021))  # ties go to the smaller ids


def test_op7_few_candidates(spark):
    rows = ann.valid(spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.1]), (3, [2.0])], "vec_id long, v array<float>"), "vec_id", "v")
    out = ann.search(rows.where("vec_id % 20 = 0"), rows, Tables(spark, "t"), probes=100)
    assert collected(out, "query_id", "rank", "vec_id") == [(0, 1, 3), (0, 2, 20), (20, 1, 3), (20, 2, 0)]


@pytest.mark.parametrize("n", [10, 21])
def test_op7_few_candidates_in_many_cells(spark, n):
    x = np.random.default_rng(5).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    out = ann.search(rows, rows, Tables(spark, "test"), k=20, block=8).collect()
    score = x @ x.T
    for q in range(n):
        want = sorted((i for i in range(n) if i != q), key=lambda i: -score[q, i])[:20]
        assert [r.vec_id for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])] == want


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
def test_op7_recall_of_unequal_norms(spark, norms):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms == "outlier":
        x[7] *= 100
    else:
        x *= np.exp(0.5 * rng.normal(size=4000))[:, None]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    out = ann.search(rows.where("vec_id % 20 = 0"), rows, Tables(spark, "test"), block=500).collect()
    got = collections.defaultdict(set)
    for r in out:
        got[r.query_id].add(r.vec_id)
    queries = range(0, 4000, 20)
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    assert all(len(got[q]) == 20 for q in queries)
    assert sum(len(got[q] & set(np.argsort(-score[q])[:20].tolist())) for q in queries) / (20 * len(queries)) >= 0.9


def test_op7_recall_on_the_given_table(spark):
    out = ann.op7_nearest(spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(ids[np.argsort(-s)[:20]]) & {r.vec_id for r in out if r.query_id == ids[q]})
        total += 20
    assert hits / total >= 0.9


def weighted_jaccard(a, b):
    a, b = (collections.Counter(words(t.translate(LOWER))) for t in (a, b))
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


def test_op8_neighbours(spark, awkward, texts):
    out = cws.op8_fingerprints(spark, awkward).collect()
    order = sorted(texts, key=lambda r: (key(r[0]), r[1] or ""))
    want, truth = [], []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        h = len(t) // 2
        changed = t[:len(t) - h] + nxt[:h]
        want.append((i, len(t), sha(changed)))
        truth.append((i, weighted_jaccard(t, changed), weighted_jaccard(t, nxt)))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=str) == sorted(want, key=str)
    got = [(r.doc_id, r.near_edited, r.near_next) for r in out if r.doc_id is not None]
    truth = [r for r in truth if r[0] is not None]
    truth.sort(key=lambda r: str((r[0],)))
    got.sort(key=lambda r: str((r[0],)))
    error = [abs(a[k] - b[k]) for a, b in zip(got, truth) for k in (1, 2)]
    assert np.mean(error) < 0.06 and max(error) < 0.3
    by_text = collections.defaultdict(set)
    lookup = collections.defaultdict(set)
    for r in out:
        lookup[r.doc_id].add(r.fingerprint)
    for i, t in texts:
        if i is not None:  # two rows have no id
            by_text[t or ""] |= lookup[i]
    assert all(len(v) == 1 for v in by_text.values())


def test_op8_collision_rate():
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(300)]
    error = []
    for _ in range(30):
        a = " ".join(rng.choice(vocabulary, 400))
        b = " ".join(a.split()[:250]) + " " + " ".join(rng.choice(vocabulary, 150))
        s = cws.signatures([a, b], 512)
        error.append(cws.likeness(s[:1], s[1:])[0] - weighted_jaccard(a, b))
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.03
    assert (cws.signatures(["", " \n"]) == 0).all()


def brute_lines(texts):
    sets = []
    for n, (i, t) in enumerate(texts):
        for no, line in enumerate(t.split("\n") if t is not None else []):
            ws = frozenset(line.lower().split())
            if ws:
                sets.append((key(i), n, no, ws))
    sets.sort(key=lambda s: s[:3])
    return {(n, no) for j, (_, n, no, ws) in enumerate(sets) if any(len(ws & o) >= 0.8 * len(ws | o) - 1e-9 for *_, o in sets[:j])}


def test_op9_decisions(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [list(rng.choice(vocabulary, rng.integers(1, 25))) for _ in range(40)]
    texts = []
    for i in range(150):
        some = []
        for _ in range(rng.integers(0, 5)):
            line = list(base[rng.integers(0, len(base))])
            for _ in range(rng.integers(0, 4)):
                line[rng.integers(0, len(line))] = rng.choice(vocabulary)
            some.append(" ".join(line))
        texts.append((i, "\n".join(some)))
    texts += [(900, None), (901, ""), (902, " \n \n")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    removed = brute_lines(texts)
    got = {(r.doc_id, no) for r in lines.line_decisions(df, Tables(spark, "t")).collect() for no in r.removed}
    assert got == {(texts[n][0], no) for n, no in removed}
    kept = {r.doc_id: r.text for r in lines.drop_lines(df).collect()}
    want = {}
    for n, (i, t) in enumerate(texts):
        rest = None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (n, no) not in removed)
        if t is None or t == rest or rest.split():
            want[i] = rest
    assert kept == want


def test_op9_other_spaces(spark):
    texts = [(1, "a b c d e f"), (2, "a\tb\x0bc \x0c d\re  f "), (3, "\t\r"), (4, "a b c x y z")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.removed for r in lines.line_decisions(df, Tables(spark, "t")).collect()} == {1: [], 2: [0], 3: [], 4: []}


def test_op9_awkward(spark, awkward, texts):
    out = lines.op9_line_dedup(spark, awkward).collect()
    assert len(out) == len(set(texts))
    by = {r.doc_id: r for r in out}
    assert (by[1].n_lines, by[2].n_lines, by[3].n_lines) == (0, 1, 2)
    assert by[10].n_removed == by[10].n_lines  # doc 5 comes before it
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    left = lines.drop_lines(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert 5 in ids and ids.count(5) == 1 and 10 not in ids  # doc 5 comes before doc 10, its equal
    assert {1, 2, 3, None} <= set(ids)


def test_op10_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    out = langid.op10_language_id(spark, d).toPandas()
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(out) == len(truth) and (both.held_out == [crc(i) % 4 == 2 for i in both.doc_id]).all()
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_op10_awkward(spark, awkward):
    out = {r.doc_id: r for r in langid.op10_language_id(spark, awkward).collect()}
    for i in (1, 2, 3, 4):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert out[8].lang_pred == "en" and out[None].lang_pred == "en"
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and not {1, 2, 3, 4} & {r.doc_id for r in kept.select("doc_id").collect()}


def test_op10_without_labels(spark):
    docs = spark.createDataFrame([(i, "some text", None) for i in range(8)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, model, ["doc_id"]).collect()} == {("und", 0.0)}
    one = docs.withColumn("lang", langid.F.lit("en"))
    assert {(r.lang_pred, r.score) for r in langid.predict(one, langid.train(one), ["doc_id"]).collect()} == {("en", 1.0)}


def test_op10_predictions_by_plain_tf_idf(spark, awkward, texts):
    docs = langid.split(spark.read.parquet(f"{awkward}/documents.parquet"))
    learned = docs.where("NOT held_out")
    model = langid.train(learned)
    frequency, n = langid.document_frequencies(learned.where("lang IS NOT NULL"))
    known = [r.text for r in learned.where("lang IS NOT NULL AND length(text) > 0").collect()]
    assert n == len(known)
    plain = [set(langid._grams(t).tolist()) for t in known]
    assert all(frequency[g] == sum(g in p for p in plain) for g in list(plain[0])[:200])
    out = collections.Counter((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.predict(docs, model, ["doc_id"]).select("kept.*", "lang_pred", "score").collect())
    want = collections.Counter()
    for i, t in texts:
        if not t or not any(c.isalpha() for c in t):
            want[(i, "und", 0.0)] += 1
            continue
        grams = collections.Counter(langid._grams(t).tolist())
        logits = [b + langid.SCALE * sum(k * float(model.table[g, c]) for g, k in grams.items()) / sum(grams.values()) for c, b in enumerate(model.bias)]
        e = [math.exp((x - max(logits)) / model.temperature) for x in logits]
        best = max(range(len(e)), key=e.__getitem__)
        want[(i, model.languages[best], round(e[best] / sum(e), 9))] += 1
    assert out == want


def test_op10_quota():
    assert langid.quota([5, 100, 1000], 300) == 195 and langid.quota([5, 100, 1000], 3000) == 1000
    assert langid.quota([], 10) == 0 and langid.quota([7, 7], 3) == 1


def test_op10_rare_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid.sample, "__defaults__", (400,))
    rng = np.random.default_rng(2)
    common, rare = "the of and with that there house river".split(), "jest się nie żółw źdźbło który czy łąka".split()
    text = lambda words: " ".join(rng.choice(words, 12))
    data = [(i, text(common), "en") for i in range(6000)] + [(10_000 + i, text(rare), "pl") for i in range(8)]
    data += [(5, data[5][1], "en")] * 3000  # copies count once
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    rows = langid.sample(docs)
    assert (rows.lang == "pl").sum() == 8 and 200 < len(rows) <= 400
    new = spark.createDataFrame([(1, text(rare)), (2, text(common))], "doc_id long, text string")
    assert {r.kept.doc_id: r.lang_pred for r in langid.predict(new, langid.train(docs), ["doc_id"]).collect()} == {1: "pl", 2: "en"}


def test_op10_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    features, classes = [], []
    for i in range(300):
        c = i % 2
        at = np.sort(rng.choice(np.arange(c * 50, 50 + c * 50), 10, replace=False))
        features.append((np.append(at, langid.DIMS), np.append(np.full(10, 0.1), 1.0)))
        classes.append(c)
    w, bias = langid.ftrl(features, np.array(classes), 2)
    assert (w[100:] == 0).all() and (w[:50, 0] > w[:50, 1]).mean() > 0.9


def test_parts_of_many_texts_at_once():
    from verbatim.llm.chunks import part_starts, parts
    texts = ["", "a b", " a  b\n", "\n \nx", "  ", "", "tab\tin it", "é ü\n\nß", "a b c", "end"]
    joined, starts, begins = part_starts(texts)
    ends = [*starts[1:].tolist(), len(joined)]
    got = [[joined[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends) if x <= a < y] for x, y in zip(begins[:-1], begins[1:])]
    assert got == [parts(t) for t in texts]
    coder = shards.LibraryCoder(bpe.public_vocabulary())
    asked = []
    coder._ids, own = lambda new: (asked.extend(new), own(new))[1], coder._ids
    raw = coder.encode(["so so so so", " so, so", ""])
    assert sorted(asked) == [" so", " so,", "so"]  # each distinct part once
    kind = np.dtype(f"<u{coder.width}")
    assert [np.frombuffer(r, kind).tolist() for r in raw] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in ["so so so so", " so, so", ""]]
    assert list(shards._stretches(["x" * shards.STRETCH, "", "y"])) == [(0, 1), (1, 3)] and list(shards._stretches([])) == []


def test_op9_wide_parity_bits(spark):
    """Long unrelated lines, which fill 64 parity bits, are told apart before their words are sent."""
    from pyspark.sql import functions as F
    rng, t = np.random.default_rng(5), lines.SIMILARITY
    base = rng.choice(1 << 40, 160, replace=False)
    def other(k):  # k of the words replaced
        return np.concatenate([base[k:], (1 << 41) + rng.choice(1 << 40, k, replace=False)])
    rows = [(i, " ".join(map(str, base)), " ".join(map(str, other(k)))) for i, k in enumerate([0, 1, 8, 17] * 5 + [120, 150] * 5)]
    sets = spark.createDataFrame(rows, "i int, a string, b string").select("i", lines.words(F.col("a")).alias("a"), lines.words(F.col("b")).alias("b"))
    side = lambda c: F.struct(F.size(c).alias("n"), lines._parity(F.col(c)).alias("bits"), *[lines._parity(F.col(c), j).alias(f"bits{j}") for j in range(lines.WIDE)]).alias(f"x{c}")
    got = sets.select("i", side("a"), side("b"), lines._similar(F.col("a"), F.col("b"), t).alias("same"))
    got = got.select("i", "same", lines._may_match("xa", "xb", t).alias("narrow"), lines._may_match_wide("xa", "xb", t).alias("wide")).orderBy("i").collect()
    assert all(r.same and r.narrow and r.wide for r in got[:20])
    assert not any(r.same or r.wide for r in got[20:]) and sum(r.narrow for r in got[20:]) >= 3


def test_op9_unrelated_lines_are_no_candidates(spark):
    """Long unrelated lines that share rare words are in no table after the features; near copies of a
    long and of a short line, and of one on either side of ``LONG``, are found."""
    rng = np.random.default_rng(6)
    some = lambda n: [f"w{i}" for i in rng.choice(3000, n, replace=False)]
    other = [some(160) for _ in range(250)]
    near = [some(160), some(12), some(67)]
    copies = [near[0][:140] + ["x1", "x2"], near[1][1:], near[2][6:]]
    texts = [(i, " ".join(w)) for i, w in enumerate([*near, *other, *copies])]
    df = spark.createDataFrame(texts, "doc_id long, text string")

    class Counted(Tables):
        def put(self, df, name):
            out = super().put(df, name)
            rows[name] = out.count()
            return out

    rows = {}
    got = {(r.doc_id, no) for r in lines.line_decisions(df, Counted(spark, "t")).collect() for no in r.removed}
    assert got == {(253, 0), (254, 0), (255, 0)} == {(texts[n][0], no) for n, no in brute_lines(texts)}
    later = {k: n for k, n in rows.items() if k not in ("lines", "sets", "features")}
    assert len(later) >= 3 and max(later.values()) <= 120, later


def test_op9_classes_of_length(spark):
    """A word is shuffled and compared within classes of length, in one of which similar lines of any
    lengths meet."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(8)
    texts = [(i, "\n".join(" ".join(f"w{x}" for x in rng.choice(40, rng.integers(1, 30))) for _ in range(3))) for i in range(40)]
    for i, n in enumerate([4, 5, 13, 16, 20, 52, 64, 80, 205, 256, 320], 40):  # the first 0.8 n words again
        ws = [f"x{n}y{k}" for k in range(n)]
        texts.append((i, " ".join(ws) + "\n" + " ".join(ws[:-(-4 * n // 5)])))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, no) for r in lines.line_decisions(df, Tables(spark, "t")).collect() for no in r.removed}
    assert got == brute_lines(texts) and {(i, 1) for i in range(40, 51)} <= got
    sets = lines.features(lines.text_lines(df), Tables(spark, "t"), 0.8)
    some = lines.candidates(sets, Tables(spark, "t"), 0.8).collect()
    assert all(math.floor(math.log(r.n, lines.SPREAD) + 1e-9) <= r.w >> 32 <= math.log(r.n / 0.8, lines.SPREAD) + 1e-6 for r in some)
    # of two sizes that may be similar, the larger's class is one of the smaller's
    own = {r.n: r.c for r in spark.range(1, 700).select(F.col("id").alias("n"), lines._classes(F.col("id"), 0.8).alias("c")).collect()}
    assert all(own[m][0] in own[n] for n in own for m in range(n, int(n / 0.8 + 1e-9) + 1) if m in own)


def test_op9_fewer_words_in_another_class(spark):
    """In a class of longer texts a text is compared by the words that only a longer one needs, and is
    found there; the words go to parts by ranges of their hash, also one at a range's end."""
    from pyspark.sql import functions as F
    texts = []
    for i, (n, m) in enumerate([(60, 70), (58, 64), (15, 17), (63, 78), (13, 16)]):
        ws = [f"x{i}y{k}" for k in range(m)]
        texts.append((i, " ".join(ws[:n]) + "\n" + " ".join(ws)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, no) for r in lines.line_decisions(df, Tables(spark, "t")).collect() for no in r.removed}
    assert got == brute_lines(texts) == {(i, 1) for i in range(5)}
    some = lines.candidates(lines.features(lines.text_lines(df), Tables(spark, "t"), 0.8), Tables(spark, "t"), 0.8).collect()
    other = [r for r in some if math.floor(math.log(r.n, lines.SPREAD) + 1e-9) < r.w >> 32]
    assert {r.n for r in other} == {60, 58, 15, 63, 13}
    assert all(r.at <= r.n - math.ceil(r.n * 1.6 / 1.8 - 1e-9) for r in other)
    rng = np.random.default_rng(9)
    sets = [[*map(int, rng.integers(-(1 << 63), (1 << 63) - 1, n)), *lines.BOUNDS[:k]] for n, k in ((0, 0), (5, 1), (90, 3))]
    rows = spark.createDataFrame([(x,) for x in sets], "a array<long>").select("a", lines._parity(F.col("a")).alias("all"), *[lines._parity(F.col("a"), i).alias(f"p{i}") for i in range(lines.WIDE)], *[lines._part(lines._in_parts(F.col("a")), i).alias(f"w{i}") for i in range(lines.WIDE)])
    for r in rows.collect():
        parts = [r[f"w{i}"] for i in range(lines.WIDE)]
        assert sorted(r.a) == [w for p in parts for w in p]
        assert [w for p in parts for w in p if (w - (-1 << 63)) * lines.WIDE >> 64 != parts.index(p)] == []
        assert np.bitwise_xor.reduce([r[f"p{i}"] for i in range(lines.WIDE)]) == r["all"]


def test_bpe_stage_gives_memory_back():
    """An encoder with the bounds of the pipeline's stage stays small, and what it found goes back
    to the system."""
    code = """
import random
from verbatim.llm import bpe
def own():
    return sum(int(x.split()[1]) for x in open('/proc/self/smaps_rollup') if x.startswith('Pss_Anon')) // 1024
coder, rng = bpe.bpe(bpe.public_vocabulary(), bpe.CACHED_IN_STAGE, bpe.COMPATIBLE_IN_STAGE), random.Random(2)
start, most = own(), 0
for _ in range(400):
    coder.encode(' '.join('%x' % rng.getrandbits(40) for _ in range(1000)))
    most = max(most, own())
    assert len(coder.known) <= bpe.CACHED_IN_STAGE and len(coder.fits) <= bpe.COMPATIBLE_IN_STAGE
coder.forget()
print(most - start, own() - start)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__)))).stdout
    most, after = map(int, out.split())
    assert most <= 90 and after <= 30, out
