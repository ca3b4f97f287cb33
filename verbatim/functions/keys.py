"""Question numbering and page keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_key(panel: Column, view: Column, num: Column) -> Column:
    """e.g. ``ec_bigram_17``: the output partition/page name of one question view."""
    return F.format_string("%s_%s_%d", panel, view, num)


def page_title(num: Column) -> Column:
    """``Question 17``."""
    return F.concat_ws(" ", F.lit("Question"), num.cast("string"))


def index_line(num: Column, text: Column) -> Column:
    """``17: question text`` — the line printed for the manual menu check."""
    return F.concat_ws(": ", num.cast("string"), text)


def code_number(code: Column) -> Column:
    """First run of digits in a question code, as int (``OPEN.012`` → 12)."""
    return F.regexp_extract(code, r"(\d+)", 1).try_cast("int")
