import pytest

from compare import connect, duck_rows, spark_rows
from silverlode.plans import catalog


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_sql(spark, data, con, name):
    assert spark_rows(catalog.queries()[name](spark, data)) == duck_rows(con, catalog.oracle_sql()[name])


def test_every_query_has_sql_or_is_listed():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"batch_fingerprint"}


def test_fingerprint_ignores_order(spark, data):
    from silverlode.sources.files import fingerprint

    rows = spark.read.parquet(f"{data}/customer.parquet")
    a = fingerprint(rows).first()[0]
    assert a == fingerprint(rows.orderBy("c_name")).first()[0]
    assert a != fingerprint(rows.where("c_custkey > 0")).first()[0]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["sale_date", "region", "total", "row_count"]
