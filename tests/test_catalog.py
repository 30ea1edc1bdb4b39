import pytest
from compare import duck, rows

from sparkloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, name):
    found = catalog.QUERIES[name](spark, sf_dir).toPandas()
    assert len(found), "a query without rows shows nothing"
    if name in catalog.SQL:
        assert rows(found) == rows(duck(sf_dir).execute(catalog.SQL[name]).fetchdf())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["source_location", "n"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
