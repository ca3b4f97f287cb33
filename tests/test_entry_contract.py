"""The driver contract: every registered query has an oracle twin, and vice versa."""

import inspect

import __spark_entry__ as E


def test_every_query_has_oracle_sql_and_back():
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_take_spark_and_folder():
    for name, q in E.queries().items():
        params = list(inspect.signature(q).parameters)
        assert len(params) == 2, name


def test_no_duplicate_implementations():
    fns = list(E.queries().values())
    assert len(fns) == len(set(fns))
