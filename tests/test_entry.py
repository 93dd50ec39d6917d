"""The driver contract."""

import __spark_entry__ as entry


def test_contract(spark):
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert all(callable(f) for f in names.values())
    assert entry.entry(spark).columns == ["kind", "n"]
