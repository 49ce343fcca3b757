"""Static rules for the registered queries: whole tables, no row caps or sampling."""

import re

import __spark_entry__ as E
from cardflow.registry.catalog import builders


def test_every_query_has_an_oracle_and_alias_only_names():
    qs, orc = builders(), {k: v for k, v in E.oracle_sql().items() if k in builders()}
    assert set(qs) == set(orc) and len(qs) >= 49
    for key, sql in orc.items():
        assert not re.search(r"\bLIMIT\b|\bOFFSET\b|\bTABLESAMPLE\b|\bUSING SAMPLE\b", sql, re.I), key
        assert not re.search(r"%\s*\d+\s*(=|<|>)", sql), key  # no modulo filters


def test_builders_use_no_row_caps():
    import inspect

    import cardflow.registry.operator_checks as ops
    import cardflow.registry.report_checks as rpt

    for mod in (ops, rpt):
        src = inspect.getsource(mod)
        assert ".limit(" not in src and ".sample(" not in src and "TABLESAMPLE" not in src
