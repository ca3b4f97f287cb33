"""Column expressions built only from ``pyspark.sql.functions`` (JVM-side, codegen'd)."""

from verbatim.functions.keys import code_number, index_line, page_key, page_title
from verbatim.functions.names import dotted_to_snake, rename_dotted
from verbatim.functions.recode import child_flag, first_true, recode_map
from verbatim.functions.text import (ORACLE_TOKEN_PATTERN, TOKEN_DELIMITER, ngram_pairs,
                                     ngrams, split_pair, tokens)
from verbatim.functions.zipcodes import normalize_zip, zip_text

__all__ = [
    "ORACLE_TOKEN_PATTERN", "TOKEN_DELIMITER", "child_flag", "code_number", "dotted_to_snake",
    "first_true", "index_line", "ngram_pairs", "normalize_zip", "page_key", "page_title",
    "ngrams", "recode_map", "rename_dotted", "split_pair", "tokens", "zip_text",
]
