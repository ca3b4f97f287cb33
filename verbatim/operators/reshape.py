"""Wide → long (R1), non-empty response filter (F3), prefix projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_responses(df: DataFrame, ids: Sequence[str],
                      values: Sequence[str] | Mapping[str, str],
                      question_col: str = "question", response_col: str = "response",
                      drop_empty: bool = True) -> DataFrame:
    """Gather value columns into (question, response) rows.

    ``values`` may map column name → question code to emit (``OPEN_001`` → ``OPEN.001``).
    Every value column is cast to string first (mixed types cannot be unpivoted).
    ``drop_empty`` keeps responses that are not NULL and not ``""`` — whitespace-only
    answers stay.  Planned as ``Expand`` followed by a ``Filter`` in the same stage.
    """
    pairs = values.items() if isinstance(values, Mapping) else [(v, v) for v in values]
    cols = [F.col(f"`{c}`").cast("string").alias(code) for c, code in pairs]
    out = df.unpivot([F.col(f"`{i}`") for i in ids], cols, question_col, response_col)
    if drop_empty:
        out = out.where(F.col(response_col) != "")
    return out


def select_prefix(df: DataFrame, *prefixes: str, keep: Sequence[str] = (),
                  ignore_case: bool = True) -> DataFrame:
    """``keep`` columns plus every column starting with one of ``prefixes``."""
    def hit(c: str) -> bool:
        name = c.lower() if ignore_case else c
        return any(name.startswith(p.lower() if ignore_case else p) for p in prefixes)
    chosen = list(keep) + [c for c in df.columns if hit(c) and c not in keep]
    return df.select([F.col(f"`{c}`") for c in chosen])
