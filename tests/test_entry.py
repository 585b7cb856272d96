import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q) and len(q) > 70
