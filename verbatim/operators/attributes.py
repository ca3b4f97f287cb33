"""Column attributes of labelled survey files (S4, P8, X14): texts and value labels in the schema.

A labelled export says of each column what it asks (``label``) and what its codes mean
(``value_labels``).  Both are kept in the column's metadata, which Spark writes into Parquet
and carries through projection, filter and rename, so a codebook table is needed once, on
ingest (``with_attributes``), and never again:

* ``is labelled`` is a property of the schema: the column has value labels;
* ``decode_labelled`` replaces codes by labels as literal expressions, without a join;
* ``question_texts`` reads the questions' texts off the columns;
* an operator that computes a column anew loses its attributes, as the fold does with its
  coalesced keys: ``merged_attributes`` takes them from the waves and ``with_metadata`` puts
  them back.  Of two waves that say different things the earlier one counts;
  ``attribute_conflicts`` lists them.

A codebook has a row per column and code, so it is as large as the questionnaire, not the data;
more than ``MAX_ROWS`` is refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.operators.decode import decode_map

LABEL, VALUES = "label", "value_labels"
MAX_ROWS = 200_000


def attributes(df: DataFrame) -> dict[str, dict]:
    """``{column: {"label": text, "value_labels": {code: label}}}`` of the columns that have any."""
    out = {}
    for f in df.schema.fields:
        found = {k: f.metadata[k] for k in (LABEL, VALUES) if f.metadata and f.metadata.get(k)}
        if found:
            out[f.name] = found
    return out


def is_labelled(df: DataFrame, column: str) -> bool:
    """The column's codes have labels."""
    return VALUES in attributes(df).get(column, {})


def labelled_columns(df: DataFrame) -> list[str]:
    return [c for c, a in attributes(df).items() if VALUES in a]


def question_texts(df: DataFrame) -> dict[str, str]:
    """The columns' texts, by column name."""
    return {c: a[LABEL] for c, a in attributes(df).items() if LABEL in a}


def with_metadata(df: DataFrame, found: Mapping[str, Mapping]) -> DataFrame:
    """``df`` with these attributes in place of those of the same kind (other metadata stays)."""
    cols = []
    for f in df.schema.fields:
        name = F.col(f"`{f.name}`")
        cols.append(name.alias(f.name, metadata={**(f.metadata or {}), **found[f.name]}) if f.name in found else name)
    return df.select(cols) if any(f.name in found for f in df.schema.fields) else df


def _limited(table: DataFrame) -> list:
    rows = table.limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"a codebook of more than {MAX_ROWS} rows")
    return rows


def with_attributes(df: DataFrame, variable_labels: Mapping[str, str] | DataFrame | None = None,
                    value_labels: Mapping[str, Mapping] | DataFrame | None = None) -> DataFrame:
    """Attributes from codebooks: mappings, or tables ``(variable, label)`` and ``(variable, code,
    label)`` (of several labels of a code the first in label order; codes without a label have none)."""
    own, found = set(df.columns), {}
    if isinstance(variable_labels, DataFrame):
        rows = _limited(variable_labels.where(F.col("variable").isin(df.columns) & F.col("label").isNotNull()).groupBy("variable").agg(F.min("label").alias("label")))
        variable_labels = {r["variable"]: r["label"] for r in rows}
    if isinstance(value_labels, DataFrame):
        rows = _limited(value_labels.where(F.col("variable").isin(df.columns) & F.col("code").isNotNull() & F.col("label").isNotNull())
                        .groupBy("variable", F.col("code").cast("string").alias("code")).agg(F.min("label").alias("label")).orderBy("variable", "code"))
        value_labels = {}
        for r in rows:
            value_labels.setdefault(r["variable"], {})[r["code"]] = r["label"]
    for c, text in (variable_labels or {}).items():
        if c in own:
            found.setdefault(c, {})[LABEL] = text
    for c, codes in (value_labels or {}).items():
        if c in own and codes:
            found.setdefault(c, {})[VALUES] = {str(k): v for k, v in codes.items()}
    return with_metadata(df, found)


def decode_labelled(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Every labelled column's codes replaced by their labels (unlabelled codes by NULL);
    a column keeps its text and is no longer labelled."""
    skip, found = set(exclude), attributes(df)
    cols = []
    for f in df.schema.fields:
        name, a = F.col(f"`{f.name}`"), found.get(f.name, {})
        if VALUES in a and f.name not in skip:
            rest = {k: v for k, v in f.metadata.items() if k != VALUES}
            name = decode_map(name, a[VALUES]).alias(f.name, metadata=rest)
        cols.append(name)
    return df.select(cols)


def merged_attributes(waves: Sequence[DataFrame]) -> dict[str, dict]:
    """The columns' attributes over all waves; where waves differ the earliest counts."""
    out: dict[str, dict] = {}
    for w in waves:
        for c, a in attributes(w).items():
            mine = out.setdefault(c, {})
            if LABEL in a:
                mine.setdefault(LABEL, a[LABEL])
            if VALUES in a:
                mine[VALUES] = {**a[VALUES], **mine.get(VALUES, {})}
    return out


def attribute_conflicts(waves: Sequence[DataFrame]) -> list[tuple[str, str | None, list[str]]]:
    """(column, code or None for its text, different labels in order of the waves)."""
    said: dict[tuple, list[str]] = {}
    for w in waves:
        for c, a in attributes(w).items():
            for code, text in [(None, a.get(LABEL)), *a.get(VALUES, {}).items()]:
                if text is not None:
                    texts = said.setdefault((c, code), [])
                    if text not in texts:
                        texts.append(text)
    return [(c, code, texts) for (c, code), texts in said.items() if len(texts) > 1]
