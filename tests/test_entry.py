import __spark_entry__ as entry


def test_contract(spark):
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 100
    assert entry.entry(spark).count() > 0
