"""S6 — the site menu as it is: nested sections, any entry anywhere in them.

The menu file (JSON of the site configuration) nests items ``{text, href, menu: [items]}``
under ``navbar.left`` and ``navbar.right``.  Every item with a link becomes one row with the
path of the texts above it, its place at each level, the panel and view that its section
promises, the code its text starts with and what its link says.  Items are generated level by
level, so there is one pass for each level and no limit on the number of items; an item
nested deeper than ``depth`` levels is an error, not a loss.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatim.sources.catalog import parse_page

DEPTH = 6
# The words of a section's title that name its panel and its view.
SECTION_PANELS = {"Household": "ec", "Provider": "cc"}
SECTION_VIEWS = {"Bigram": "bigram", "Response": "responses"}
# a code with dots, or one that a colon ends
CODE = r"^\s*([A-Za-z]\w*(?:(?:\.\w+)+(?=[:.]?(?:\s|$))|(?=:(?:\s|$))))"


def _items(depth: int) -> T.ArrayType:
    below = _items(depth - 1) if depth > 1 else T.StringType()  # what lies deeper shows as its JSON
    return T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("href", T.StringType()), T.StructField("menu", below)]))


def menu_schema(depth: int = DEPTH) -> T.StructType:
    return T.StructType([T.StructField("navbar", T.StructType([T.StructField("left", _items(depth)), T.StructField("right", _items(depth))]))])


def _named(title: Column, words: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for word, value in reversed(list(words.items())):
        out = F.when(F.lower(title).contains(word.lower()), value).otherwise(out)
    return out


def menu_entries(sites: DataFrame, depth: int = DEPTH, panels: Mapping[str, str] = SECTION_PANELS,
                 views: Mapping[str, str] = SECTION_VIEWS) -> DataFrame:
    """One row per linked item of ``menu_schema`` rows: ``path``, ``place``, ``section``, ``panel``,
    ``section_view``, ``module`` (the text above, NULL at the top), ``code``, ``text``, ``page`` and
    the link's ``href_panel``, ``href_view``, ``page_num``."""
    no_texts, no_places = F.array().cast("array<string>"), F.array().cast("array<int>")
    sides = [sites.select(no_texts.alias("above"), F.array(F.lit(i)).alias("place"), F.posexplode(f"navbar.{side}").alias("at", "item")) for i, side in enumerate(("left", "right"))]
    rows = sides[0].unionByName(sides[1])
    found = None
    for level in range(depth):
        rows = rows.select("above", F.concat("place", F.array("at")).alias("place"), "item")
        linked = rows.where(F.col("item.href").isNotNull()).select("above", "place", F.col("item.text").alias("text"), F.col("item.href").alias("page"))
        found = linked if found is None else found.unionByName(linked)
        path = F.concat("above", F.array("item.text"))
        if level == depth - 1:
            deeper = F.concat(F.lit(f"the menu nests deeper than {depth} levels under: "), F.array_join(path, " / ", "?"))
            lost = rows.where(F.col("item.menu").isNotNull()).select("above", "place", F.raise_error(deeper).cast("string").alias("text"), F.lit(None).cast("string").alias("page"))
            found = found.unionByName(lost)
        else:
            rows = rows.select(path.alias("above"), "place", F.posexplode("item.menu").alias("at", "item"))
    section = F.get("above", F.lit(0))
    code = F.regexp_extract("text", CODE, 1)
    return found.select(
        F.concat("above", F.array("text")).alias("path"), "place", section.alias("section"), _named(section, panels).alias("panel"), _named(section, views).alias("section_view"),
        F.when(F.size("above") > 1, F.get("above", F.size("above") - 1)).alias("module"),
        F.when(code != "", code).alias("code"), "text", "page", *parse_page(F.col("page")))


def read_menu(spark: SparkSession, path: str, depth: int = DEPTH, **options) -> DataFrame:
    """The entries of a menu file (JSON, over several lines or one); a file that isn't such
    JSON is an error."""
    sites = spark.read.schema(menu_schema(depth)).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    return menu_entries(sites, depth, **options)


def menu_questions(entries: DataFrame) -> DataFrame:
    """The entries that the audit takes: those of sections that name a panel and a view."""
    return entries.where(F.col("panel").isNotNull() & F.col("section_view").isNotNull())
