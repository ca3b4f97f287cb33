"""verbatim — open-ended panel-survey analytics as lazy Spark DataFrame operators.

Layout
------
``sources``    readers for wave files, the zip gazetteer, codebooks, stop words, menus
``functions``  Column-level expressions (zip normalisation, recodes, tokenizer, page keys)
``operators``  DataFrame -> DataFrame operators (wave harmonisation, lookup, decode,
               fill-forward, unpivot, bigram network, thresholds, views, catalog audit)
``plans``      end-to-end panel flows and the test-table query registry
"""

__version__ = "0.1.0"
