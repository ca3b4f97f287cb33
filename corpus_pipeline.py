"""The corpus pipeline: stages applied one after the other to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents.  All but the last return the columns they were
given.

Defined results: documents without a letter (null and empty texts too) go in the first stage;
rows repeated by the mix are encoded each; an empty table goes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.llm.bpe import encode, public_vocabulary
from verbatim.llm.common import Tables, table
from verbatim.llm.langid import keep_identified
from verbatim.llm.lines import drop_lines
from verbatim.llm.mixing import mix
from verbatim.llm.simhash import SHINGLE, keep_one


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model doesn't know go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and documents of which nothing is left."""
    out = drop_lines(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return keep_one(docs, SHINGLE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights; a document taken twice is there twice."""
    return mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in place of their texts."""
    out = encode(docs, public_vocabulary(), [c for c in docs.columns if c != "text"])
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: The stages use models, hash ranks and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tables = Tables(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = tables.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
