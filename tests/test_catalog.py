import pytest

from loomgrain import catalog
from tests.compare import connect, oracle_rows, rows_of

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    found = rows_of(catalog.queries()[name](spark, FOLDER))
    if name in SQL:
        assert found == oracle_rows(duck, SQL[name])
    else:
        assert sum(found[1].values()) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
