def test_entry_and_registries(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["row_id", "title"]
