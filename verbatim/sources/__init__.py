"""Readers.  Every reader returns a lazy DataFrame with a declared schema."""

from verbatim.sources.catalog import CATALOG_SCHEMA, read_catalog
from verbatim.sources.codebook import (VALUE_LABELS_SCHEMA, VARIABLE_LABELS_SCHEMA,
                                       read_value_labels, read_variable_labels)
from verbatim.sources.gazetteer import ZIP_SCHEMA, read_gazetteer
from verbatim.sources.stopwords import ENGLISH_STOP_WORDS, read_stop_words, stop_words
from verbatim.sources.waves import read_waves, wave_columns

__all__ = [
    "CATALOG_SCHEMA", "ENGLISH_STOP_WORDS", "VALUE_LABELS_SCHEMA", "VARIABLE_LABELS_SCHEMA",
    "ZIP_SCHEMA", "read_catalog", "read_gazetteer", "read_value_labels",
    "read_stop_words", "read_variable_labels", "read_waves", "stop_words", "wave_columns",
]
