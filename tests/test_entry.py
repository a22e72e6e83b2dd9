import __spark_entry__ as entry


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    found, sql = entry.queries(), entry.oracle_sql()
    assert len(found) > 100 and set(sql) <= set(found)
