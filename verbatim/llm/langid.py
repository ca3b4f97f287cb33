"""Language identification by sparse multinomial logistic regression.

Features are hashed character bigrams and trigrams of the lower-cased text (a word's edges
count as characters), weighted by TF-IDF: the n-gram's share of the text's n-grams times
``log((1 + documents) / (1 + documents with it)) + 1``.  Document frequencies come from all
training documents.  Weights are learned by FTRL-proximal with an elastic net (L1 gives the
sparse model) from at most ``SAMPLE`` labelled documents, as many of each language as there
are; one in five of them is kept back to calibrate a temperature.

A prediction needs one pass over the text: each n-gram's IDF times its weights is looked up,
summed and divided by the number of n-grams.

Defined results: null text or text without a letter is ``und`` with score 0; rows without a
language are not learned from; with no labelled document every prediction is ``und``; one
language only is predicted with score 1; repeated rows get the same prediction; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatim.llm.common import doc_crc, row_hash, table

DIMS = 1 << 16
SAMPLE = 3_000  # labelled documents that the weights are fitted on, at most
UNKNOWN = "und"
EPOCHS = 3
ALPHA, BETA, L1, L2 = 4.0, 1.0, 2e-4, 1e-5
SCALE = 30.0  # features are shares times IDF, of the order of 1/100


def _grams(text: str) -> np.ndarray:
    """Hashed bigrams and trigrams of a text, one for each place."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]]).astype(np.uint32)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1)
    both = np.concatenate([two, three])
    both ^= both >> np.uint32(15)
    return (both * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def _has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # DIMS x languages: IDF times weight
    bias: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        grams = _grams(text)
        total = np.zeros(len(self.languages))
        for i in range(0, len(grams), 1 << 18):  # a very long text in pieces
            total += self.table[grams[i:i + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return total * (SCALE / len(grams)) + self.bias


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each hashed n-gram, and all documents: DIMS numbers to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, mark = np.zeros(DIMS, np.int64), 0, np.zeros(DIMS, bool)
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    grams = _grams(text)
                    mark[grams] = True
                    df += mark
                    mark[grams] = False
                    docs += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], docs))], ["gram", "n"])
    rows = texts.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIMS, np.int64)
    grams = rows[rows["gram"] >= 0]
    df[grams["gram"].to_numpy()] = grams["n"].to_numpy()
    return df, int(rows.loc[rows["gram"] < 0, "n"].sum())


def quota(counts: list[int], most: int) -> int:
    """The largest number q with the sum of min(count, q) at most ``most``."""
    left = most
    for i, n in enumerate(sorted(counts)):
        if n * (len(counts) - i) > left:
            return left // (len(counts) - i)
        left -= n
    return max(counts, default=0)


def sample(labelled: DataFrame, most: int = SAMPLE) -> pd.DataFrame:
    """(lang, at, tf): the n-grams and their shares in the texts of at most ``most`` documents.

    Each language has the same quota, so that a rare one is learned too: its documents smallest
    by a hash of id and text.  Copies have one hash and count once.  A cut on the hash that lets
    through about twice the quota comes first, so neither texts nor ids of all documents are
    sorted."""
    hashed = F.shiftrightunsigned(row_hash(F.col("doc_id"), F.col("text")), 11).cast("double") / float(1 << 53)
    ranked = labelled.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", hashed.alias("rank"))
    counts = {r["lang"]: r["n"] for r in ranked.groupBy("lang").agg(F.approx_count_distinct("rank", 0.02).alias("n")).collect()}
    each = quota(list(counts.values()), int(most * 0.9))  # the counts are right to some per cent
    if not each:
        return pd.DataFrame({"lang": [], "at": [], "tf": []})
    cuts = F.create_map(*[F.lit(v) for x, n in counts.items() for v in (x, min(1.0, (2.0 * each + 100) / n))])
    some = ranked.where(F.col("rank") <= F.element_at(cuts, F.col("lang"))).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    some = some.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("rank"))).where(F.col("no") <= each)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(_grams(x), return_counts=True) for x in b.column(2).to_pylist()]
            at = pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32()))
            tf = pa.array([f[1] / f[1].sum() for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), at, tf], ["rank", "lang", "at", "tf"])

    grams = some.select("rank", "lang", "text").mapInArrow(count, "rank double, lang string, at array<int>, tf array<double>")
    rows = grams.toPandas().sort_values(["rank", "lang"], kind="stable")
    return rows[["lang", "at", "tf"]].head(most)


def ftrl(features: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for the softmax loss: weights (DIMS x k, sparse by L1) and bias."""
    z, n = np.zeros((DIMS + 1, k)), np.zeros((DIMS + 1, k))

    def weights(at):
        zz = z[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - L1 * (at < DIMS)[:, None], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(features)):
            at, x = features[i]
            w = weights(at)
            g = softmax(x @ w)
            g[classes[i]] -= 1
            g = x[:, None] * g[None, :]
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    w = weights(np.arange(DIMS + 1))
    return w[:DIMS], w[DIMS]


def train(labelled: DataFrame) -> Model:
    """A model from rows (doc_id, text, lang) with a language."""
    labelled = labelled.where("lang IS NOT NULL")
    df, docs = document_frequencies(labelled)
    idf = np.log((1 + docs) / (1 + df)) + 1
    rows = sample(labelled)
    languages = sorted(set(rows["lang"]))
    if not languages:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros(0), 1.0)
    features = [(np.append(at, DIMS), np.append(tf * idf[at] * SCALE, 1.0))
                for at, tf in ((np.asarray(a, np.int64), np.asarray(f)) for a, f in zip(rows["at"], rows["tf"]))]
    classes = rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    kept_back = np.arange(len(features)) % 5 == 4
    w, bias = ftrl([f for f, k in zip(features, kept_back) if not k], classes[~kept_back], len(languages))
    model = Model(languages, (idf[:, None] * w).astype(np.float32), bias, 1.0)
    if kept_back.any():
        logits = np.stack([f[1][:-1] @ w[f[0][:-1]] + bias for f, k in zip(features, kept_back) if k])
        right = classes[kept_back]
        # Smoothed labels: few or easily told documents don't drive the temperature to 0.
        off = 1 / (len(right) + 2)
        aim = np.full(logits.shape, off / logits.shape[1])
        aim[np.arange(len(right)), right] += 1 - off
        loss = lambda t: -(aim * np.log(np.maximum(softmax(logits / t), 1e-12))).sum(axis=1).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    return model


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Each row's columns ``keep`` as a struct ``kept``, lang_pred and score.

    The model, DIMS x languages numbers, goes to the tasks with the function."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")
    # a text that is kept goes to the task once
    inside = keep.index("text") if "text" in keep else None
    rows = docs.select(kept) if inside is not None else docs.select(kept, "text")
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            texts = b.column(1) if inside is None else b.column(0).flatten()[inside]
            known = _has_letter(texts) & bool(model.languages)
            best, score = np.full(b.num_rows, len(model.languages)), np.zeros(b.num_rows)
            for i in np.flatnonzero(known):
                p = softmax(model.logits(texts[int(i)].as_py()) / model.temperature)
                best[i] = p.argmax()
                score[i] = p[best[i]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names[best], pa.string()), pa.array(score)], ["kept", "lang_pred", "score"])

    schema = rows.select("kept").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def split(docs: DataFrame) -> DataFrame:
    """Adds held_out: documents that are never learned from."""
    return docs.withColumn("held_out", doc_crc() % 4 == 2)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = split(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    known = predict(docs, train(docs.where("NOT held_out")), ["doc_id", "held_out"])
    return known.select("kept.*", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a language that the model gives at least the probability ``least``."""
    model = train(split(docs).where("NOT held_out"))
    known = predict(docs, model, docs.columns)
    return known.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("kept.*")
