"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["series", "period", "value"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_no_row_caps_in_oracle_sql():
    for k, s in E.oracle_sql().items():
        if k.startswith("top"):
            continue
        assert " LIMIT " not in s.upper(), k
