"""Categorical recodes (X5, X6, X7, X8, X9, X11 on literal dictionaries)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def child_flag(count: Column) -> Column:
    """>= 1 → "Yes"; present → "No"; missing stays missing."""
    return F.when(count >= 1, F.lit("Yes")).when(count.isNotNull(), F.lit("No"))


def recode_map(code: Column, mapping: Mapping) -> Column:
    """Literal dictionary lookup; codes without an entry become NULL.

    Compiles to a single ``map[...]`` expression — no join, no UDF.
    """
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[code]


def first_true(rules: Sequence[tuple[str, Sequence[Column]]]) -> Column:
    """Priority classification: the first rule with any flag equal to 1 wins.

    A missing flag is "not true" (three-valued OR, as a CASE WHEN condition).
    No rule true → NULL.
    """
    out = None
    for label, flags in rules:
        cond = None
        for f in flags:
            cond = (f == 1) if cond is None else (cond | (f == 1))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out if out is not None else F.lit(None).cast("string")
