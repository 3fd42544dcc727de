"""Every registered query against its DuckDB result."""

import pytest

import __spark_entry__ as driver
from compare import connect, difference
from orefold.registry import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, db, name):
    assert difference(QUERIES[name].run(spark, small), db, QUERIES[name].sql) is None


def test_driver_contract(spark, small):
    optional = driver.LLM_QUERIES.keys()
    assert driver.queries().keys() - optional == driver.oracle_sql().keys() - optional == QUERIES.keys()
    assert driver.entry(spark).columns == [
        "order_number", "product_key", "customer_key", "order_date", "shipping_date",
        "due_date", "sales_amount", "quantity", "price",
    ]


@pytest.mark.parametrize("name", ["d14_measures", "d15_measures_repaired", "d18_country_values", "o02_three_columns", "o03_output_alias"])
def test_sorted_output(spark, small, name):
    df = QUERIES[name].run(spark, small)
    keys = {
        "d18_country_values": ["cntry"],
        "o03_output_alias": ["sls_price", "sls_ord_num"],
    }.get(name, ["sls_sales", "sls_quantity", "sls_price"])
    rows = [tuple((r[k] is not None, r[k]) for k in keys) for r in df.collect()]
    assert rows == sorted(rows, key=lambda r: [(known, v if known else 0) for known, v in r])
