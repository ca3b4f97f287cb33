"""Filterable response view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def questions_matching(df: DataFrame, pattern: str, question_col: str = "question") -> DataFrame:
    """rows whose question code matches a regular expression."""
    return df.where(F.col(question_col).rlike(pattern))


def _column_filter(name: str, spec) -> Column:
    """``("range", lo, hi)``, ``("in", values)`` or ``("contains", text)``.

    ``contains`` is case-insensitive, like the table widget's text box.  A bound given
    as None is open.
    """
    c = F.col(f"`{name}`")
    kind = spec[0]
    if kind == "range":
        lo, hi = spec[1], spec[2]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c <= hi)
        return cond
    if kind == "in":
        return c.isin(list(spec[1]))
    if kind == "contains":
        return F.lower(c.cast("string")).contains(str(spec[1]).lower())
    raise ValueError(f"unknown filter kind {kind!r}")


def _behind(keys: Sequence[tuple[str, bool]], values: Sequence) -> Column:
    """Rows after ``values`` in the order of ``keys`` (NULLs first ascending, last descending)."""
    out, equal = F.lit(False), F.lit(True)
    for (name, ascending), v in zip(keys, values, strict=True):
        c = F.col(f"`{name}`")
        if ascending:
            further = c.isNotNull() if v is None else F.coalesce(c > F.lit(v), F.lit(False))
        else:
            further = F.lit(False) if v is None else F.coalesce(c < F.lit(v), F.lit(True))
        out = out | (equal & further)
        equal = equal & c.eqNullSafe(F.lit(v))
    return out


def response_view(df: DataFrame, question: str | None = None, question_col: str = "question",
                  filters: Mapping[str, tuple] | None = None, search: str | None = None,
                  order_by: Sequence[tuple[str, bool]] | None = None,
                  page: int = 0, page_size: int | None = 10,
                  after: Sequence | None = None) -> DataFrame:
    """V1: one question's responses, filtered, globally searched, sorted, one page.

    ``search`` works like the table widget's search box: split into words, every word
    must occur (case-insensitive substring, any order) somewhere in the shown columns.  The page is the
    feature here (a table page), so ``limit`` is intended; ordered ``limit`` plans as a
    per-partition top-k, not a full sort.  ``order_by`` defaults to every shown column
    so pages are deterministic.

    A deep page by number gathers all rows before it.  ``after`` — the previous page's last
    row's values of the ``order_by`` columns — starts behind that row instead, so each page
    costs a top-k of its own size; the order must be unique for that.
    """
    out = df
    if question is not None:
        out = out.where(F.col(question_col) == question).drop(question_col)
    for name, spec in (filters or {}).items():
        out = out.where(_column_filter(name, spec))
    shown = out.columns
    words = (search or "").lower().split()
    if words:
        hay = F.lower(F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in shown]))
        for w in words:
            out = out.where(hay.contains(w))
    keys = order_by or [(c, True) for c in shown]
    out = out.orderBy(*[F.col(f"`{c}`").asc_nulls_first() if asc else F.col(f"`{c}`").desc_nulls_last()
                        for c, asc in keys])
    if after is not None:
        out = out.where(_behind(keys, after))
    if page_size is not None:
        if page:
            out = out.offset(page * page_size)
        out = out.limit(page_size)
    return out
