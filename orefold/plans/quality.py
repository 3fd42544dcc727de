"""Data-quality checks. Each returns the offending rows; no rows means passed.

Domain reviews (``*_values``) are the exception: they list the values in use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions import cleaning as c
from orefold.operators.joins import left_lookup, orphans, repeated_keys, rows_not_in, rows_used
from orefold.operators.ordering import latest_per_key, number_within
from orefold.operators.skew import known_size, with_size
from orefold.plans import gold
from orefold.plans.silver import NEWEST_FIRST, sales_measures

OLDEST_BIRTH = dt.date(1924, 1, 1)
# Names of the columns that checks add to their results.
RANK = "flag_last"
RECORDS = "record_count"
COPIES = "duplicate_count"
CATEGORY, NUMBER = "cat_id", "product_number"
OLD_SALES, OLD_PRICE = "old_sls_sales", "old_sls_price"


# -- raw customers -----------------------------------------------------------

def numbered_customers(customers: DataFrame) -> DataFrame:
    """Every record with its age rank inside the customer id, newest first."""
    return number_within(customers, ["cst_id"], NEWEST_FIRST, RANK)


def superseded_customers(customers: DataFrame) -> DataFrame:
    """Records that are not the newest of their id; without an id counts as one id."""
    return numbered_customers(customers).where(F.col(RANK) != 1)


def newest_customers(customers: DataFrame) -> DataFrame:
    return latest_per_key(customers, ["cst_id"], NEWEST_FIRST, RANK)


def bad_customer_ids(customers: DataFrame) -> DataFrame:
    return repeated_keys(customers, "cst_id", RECORDS, include_null=True)


# -- raw products ------------------------------------------------------------

def bad_product_ids(products: DataFrame) -> DataFrame:
    return repeated_keys(products, "prd_id", RECORDS, include_null=True)


def with_category_id(products: DataFrame) -> DataFrame:
    return products.withColumn(CATEGORY, c.category_id(F.col("prd_key")))


def products_without_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products whose category id the ERP list lacks (``NOT IN``).

    A NULL id in the list hides every finding; see ``null_category_ids``.
    """
    return rows_not_in(with_category_id(products), CATEGORY, categories, "id")


def null_category_ids(categories: DataFrame) -> DataFrame:
    return categories.where(F.col("id").isNull())


def products_sold(products: DataFrame, sales: DataFrame) -> DataFrame:
    keyed = with_category_id(products).withColumn(NUMBER, c.product_number(F.col("prd_key")))
    return rows_used(keyed, NUMBER, sales, "sls_prd_key")


def bad_costs(products: DataFrame) -> DataFrame:
    return products.where((F.col("prd_cost") < 0) | F.col("prd_cost").isNull()).select("prd_cost")


def reversed_versions(products: DataFrame) -> DataFrame:
    return products.where(F.col("prd_end_dt") < F.col("prd_start_dt"))


# -- raw sales ---------------------------------------------------------------

def nonpositive_dates(sales: DataFrame, column: str) -> DataFrame:
    return sales.where(F.col(column) <= 0).select(column)


def bad_dates(sales: DataFrame, column: str) -> DataFrame:
    """Malformed or out-of-range date numbers, zero shown as NULL."""
    suspect = sales.where(c.date_key_suspect(F.col(column)))
    return suspect.select(F.nullif(F.col(column), F.lit(0)).alias(column))


def late_orders(sales: DataFrame) -> DataFrame:
    """Ordered after shipping or after the due date."""
    order = F.col("sls_order_dt")
    return sales.where((order > F.col("sls_ship_dt")) | (order > F.col("sls_due_dt")))


def _disagreeing(sales: DataFrame) -> DataFrame:
    return sales.where(c.measures_disagree(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")))


def bad_measures(sales: DataFrame) -> DataFrame:
    """Distinct contradictory measures, sorted."""
    measures = ["sls_sales", "sls_quantity", "sls_price"]
    return _disagreeing(sales).select(*measures).distinct().orderBy(*measures)


def repaired_measures(sales: DataFrame) -> DataFrame:
    """Distinct contradictory measures before and after repair, sorted by the latter."""
    repaired = sales_measures()
    return (
        _disagreeing(sales)
        .select(
            F.col("sls_sales").alias(OLD_SALES),
            "sls_quantity",
            F.col("sls_price").alias(OLD_PRICE),
            repaired["sls_sales"].alias("sls_sales"),
            repaired["sls_price"].alias("sls_price"),
        )
        .distinct()
        .orderBy("sls_sales", "sls_quantity", "sls_price")
    )


# -- any layer ---------------------------------------------------------------

def untrimmed_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(c.untrimmed(F.col(column))).select(column)


def untrimmed_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [c.untrimmed(F.col(n)) for n in columns]))


def values_in_use(df: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    found = df.select(column).distinct()
    return found.orderBy(column) if ordered else found


def odd_birth_dates(demographics: DataFrame, as_of: dt.date) -> DataFrame:
    born = F.col("bdate")
    return demographics.where((born < F.lit(OLDEST_BIRTH)) | (born > F.lit(as_of))).select("bdate").distinct()


# -- star schema -------------------------------------------------------------

def repeated_customer_keys(customers: DataFrame) -> DataFrame:
    return repeated_keys(customers, "customer_key", COPIES)


def repeated_product_keys(products: DataFrame) -> DataFrame:
    return repeated_keys(products, "product_key", COPIES)


def repeated_customer_ids(customers: DataFrame) -> DataFrame:
    """Business keys that would multiply facts; the surrogate key cannot show it."""
    return repeated_keys(customers, "customer_id", COPIES)


def repeated_product_numbers(products: DataFrame) -> DataFrame:
    return repeated_keys(products, "product_number", COPIES)


def facts_without_customer(facts: DataFrame, customers: DataFrame) -> DataFrame:
    return orphans(facts, "customer_key", customers, "customer_key")


def lines_without_customer(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """``facts_without_customer`` straight from cleaned sales: only the lines that are left look their product up."""
    keyed = gold.with_customer_key(sales, customers)
    lost = orphans(keyed, "customer_key", customers, "customer_key")
    return gold.renamed(gold.with_product_key(lost, products), gold.SALES_NAMES)


def facts_without_product(facts: DataFrame, products: DataFrame) -> DataFrame:
    return orphans(facts, "product_key", products, "product_key")


_ORPHANS = ("fact_without_customer", "fact_without_product")


def gate(facts: DataFrame, customers: DataFrame, products: DataFrame, checks: Collection[str] | None = None) -> DataFrame:
    """Offending rows per star-schema check; the gate is open when all are zero.

    One pass over the facts serves both orphan checks. Of ``checks`` only those are run.
    """
    repeated = {
        "repeated_customer_key": repeated_customer_keys(customers),
        "repeated_product_key": repeated_product_keys(products),
        "repeated_customer_id": repeated_customer_ids(customers),
        "repeated_product_number": repeated_product_numbers(products),
    }
    counts = [
        df.agg(F.count("*").alias("failing_rows")).select(F.lit(name).alias("check_name"), "failing_rows")
        for name, df in repeated.items()
        if checks is None or name in checks
    ]
    if checks is not None and not set(checks) & set(_ORPHANS):
        return reduce(DataFrame.unionByName, counts)
    known = facts.select("customer_key", "product_key")
    for dimension, key in ((customers, "customer_key"), (products, "product_key")):
        # One row per key, so that a repeated key cannot repeat the fact.
        present = with_size(dimension.select(key).distinct().withColumn(f"has_{key}", F.lit(True)), known_size(dimension))
        known = left_lookup(known, present, key, key)
    orphaned = known.agg(
        F.count_if(F.col("has_customer_key").isNull()).alias("fact_without_customer"),
        F.count_if(F.col("has_product_key").isNull()).alias("fact_without_product"),
    )
    names = [n for n in _ORPHANS if checks is None or n in checks]
    counts.append(orphaned.unpivot([], names, "check_name", "failing_rows"))
    return reduce(DataFrame.unionByName, counts)
