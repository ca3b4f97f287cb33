"""S6 — the site menu as a flat table (one row per menu entry).

``section_view`` is the view the menu section promises (``bigram`` / ``responses``);
``href_panel``/``href_view``/``page_num`` are parsed from the link target
(``ec_bigram_17.html``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = ("section string, panel string, section_view string, module string, "
                  "code string, text string, page string")


def parse_page(page):
    """``ec_bigram_17.html`` → (href_panel, href_view, page_num)."""
    pat = r"^([A-Za-z]+)_([A-Za-z]+)_(\d+)"
    return (F.regexp_extract(page, pat, 1).alias("href_panel"),
            F.regexp_extract(page, pat, 2).alias("href_view"),
            F.regexp_extract(page, pat, 3).try_cast("int").alias("page_num"))


def read_catalog(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    df = spark.read.format(fmt).schema(CATALOG_SCHEMA).load(path)
    return df.select("*", *parse_page(F.col("page")))
