"""The corpus pipeline: stages against the operators' decisions, and on an empty table."""

import collections

import corpus_pipeline
from verbatim.llm import bpe, langid, lines, mixing, simhash
from verbatim.llm.common import Tables


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "bpe"]


def test_stages_keep_columns_and_take_effect(spark, awkward, tmpdir_fresh):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, awkward)
        out.write.parquet(f"{tmpdir_fresh}/{name}")
        out = spark.read.parquet(f"{tmpdir_fresh}/{name}")
        if name != "bpe":
            assert out.columns == docs.columns, name
        ids = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())
        if name == "language_id":
            assert not {1, 2, 3, 4} & set(ids(out)) and {8, 9, None} <= set(ids(out))
        if name == "line_dedup":
            assert all(r.n_chars == len(r.text) for r in out.collect())
            gone = {(r.doc_id, r.h) for r in lines.line_decisions(docs, Tables(spark, "t")).collect() if len(r.removed) == r.n_lines}
            assert len({i for i, _ in gone} & set(ids(out))) <= 1
        if name == "near_dedup":
            found = simhash.near_duplicates(docs, Tables(spark, "t")).collect()
            assert ids(out) == collections.Counter(i for _, i in {(r.root, r.component_id) for r in found})
        if name == "mixing":
            rows = Tables(spark, "t").put(mixing.sized(docs), "sizes")
            want = collections.Counter()
            for r in mixing.apply_mix(rows, mixing.plan_mix(rows, Tables(spark, "t"))).collect():
                want[r.doc_id] += r.copies
            assert ids(out) == +want
        if name == "bpe":
            coder = bpe.bpe(bpe.public_vocabulary())
            before = collections.Counter((r.doc_id, tuple(coder.encode(r.text or ""))) for r in docs.collect())
            assert before == collections.Counter((r.doc_id, tuple(r.ids)) for r in out.collect())
            assert all(r.n_tokens == len(r.ids) for r in out.collect())
        docs = out


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = langid.keep_identified(docs)
    clean = docs.where("length(text) > 100")
    assert clean.join(kept.select("doc_id"), "doc_id", "left_anti").count() <= 1


def test_run_equals_the_stages(spark, awkward):
    out = corpus_pipeline.run(spark, awkward)
    assert out.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(out.columns)


def test_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
