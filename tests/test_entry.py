import __spark_entry__ as entry


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
