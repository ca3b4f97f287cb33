"""Value-label decoding (X11), applied to every labelled column.

Codes are compared as numbers: a survey export holds labelled columns as doubles, so the
codebook's 1 labels the value 1.0 but not 1.5, and a text that is no number has no label.
Text codes of the codebook are compared as text where they are no numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatim.operators.broadcast import bounded_broadcast

MAX_CODEBOOK_ROWS = 200_000  # broadcast up to here, shuffle join beyond


def code_key(code: Column) -> Column:
    """One text for each code: numbers by value (``1``, ``1.0`` and ``\"1\"`` alike)."""
    text = F.trim(code.cast("string"))
    number = text.try_cast("double")
    return F.when(number.isNotNull(), number.cast("string")).otherwise(text)


def labels_table(value_labels: DataFrame | Mapping[str, Mapping], spark=None,
                 panel: str | None = None) -> DataFrame:
    """``(variable, code_key, label)`` from a codebook table or nested mapping; the first
    label in label order counts where a code has several."""
    if not isinstance(value_labels, DataFrame):
        rows = [(v, str(c), l) for v, codes in value_labels.items() for c, l in codes.items()]
        value_labels = spark.createDataFrame(rows, "variable string, code string, label string")
        panel = None
    if panel is not None:
        value_labels = value_labels.where(F.col("panel") == panel)
    return (value_labels.select("variable", code_key(F.col("code")).alias("code_key"), "label")
            .groupBy("variable", "code_key").agg(F.min("label").alias("label")))


def decode_values(df: DataFrame, labels: Mapping[str, Mapping] | DataFrame,
                  exclude: Iterable[str] = (), columns: Iterable[str] | None = None) -> DataFrame:
    """Replace each labelled column's codes by their labels; unlabelled codes → NULL.

    A nested mapping names its columns; it becomes literal expressions.  A codebook table
    (``variable, code, label`` or the result of ``labels_table``) is joined, one left join
    per labelled column of ``columns`` (default: the table's variables that ``df`` has),
    each broadcast behind a size check.  Columns in ``exclude`` are left alone.
    """
    skip = set(exclude)
    if not isinstance(labels, DataFrame):
        todo = {c: decode_map(F.col(f"`{c}`"), m) for c, m in labels.items()
                if c in df.columns and c not in skip}
        return df.withColumns(todo) if todo else df
    table = labels if "code_key" in labels.columns else labels_table(labels)
    if columns is None:  # at most as many names as df has columns come to the driver
        known = table.where(F.col("variable").isin(df.columns)).select("variable").distinct()
        columns = [r[0] for r in known.collect()]
    order = df.columns
    for c in columns:
        if c not in order or c in skip:
            continue
        side = table.where(F.col("variable") == c).select(
            F.col("code_key").alias("__code"), F.col("label").alias("__label"))
        df = df.join(bounded_broadcast(side, MAX_CODEBOOK_ROWS), code_key(F.col(f"`{c}`")) == F.col("__code"), "left")
        df = df.withColumn(c, F.col("__label")).drop("__code", "__label")
    return df.select([F.col(f"`{c}`") for c in order])


def decode_map(code: Column, mapping: Mapping) -> Column:
    """Label of a code from a literal dictionary, compared like ``code_key``."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = {}
    for k, v in mapping.items():
        text = str(k).strip()
        try:
            same = float(text)
        except ValueError:
            same = text
        pairs.setdefault(same, (code_key(F.lit(text)), F.lit(v)))
    return F.create_map(*[x for kv in pairs.values() for x in kv])[code_key(code)]
