"""The star schema: two dimensions with dense surrogate keys around the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions.cleaning import preferred_gender
from orefold.operators.joins import left_lookup, repeated_keys
from orefold.operators.ordering import OCCURRENCE, stable_key, surrogate_key
from orefold.operators.skew import known_size, measure, measured, narrowed, same_key, set_aside
from orefold.session import at_once, limit

# Business names of the cleaned columns, in output order.
CUSTOMER_NAMES = {
    "customer_id": "cst_id",
    "customer_number": "cst_key",
    "first_name": "cst_firstname",
    "last_name": "cst_lastname",
    "country": "cntry",
    "marital_status": "cst_marital_status",
    "gender": "gender",
    "birthdate": "bdate",
    "create_date": "cst_create_date",
}
PRODUCT_NAMES = {
    "product_id": "prd_id",
    "product_number": "prd_key",
    "product_name": "prd_nm",
    "category_id": "cat_id",
    "category": "cat",
    "subcategory": "subcat",
    "maintenance": "maintenance",
    "cost": "prd_cost",
    "product_line": "prd_line",
    "start_date": "prd_start_dt",
}
SALES_NAMES = {
    "order_number": "sls_ord_num",
    "product_key": "product_key",
    "customer_key": "customer_key",
    "order_date": "sls_order_dt",
    "shipping_date": "sls_ship_dt",
    "due_date": "sls_due_dt",
    "sales_amount": "sls_sales",
    "quantity": "sls_quantity",
    "price": "sls_price",
}


# Key, business key and order of numbering of each dimension.
KEYS = {
    "dim_customers": ("customer_key", ["customer_id"], ["customer_id"]),
    "dim_products": ("product_key", ["product_number"], ["start_date", "product_number"]),
}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def customer_attributes(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with ERP birth date, gender and country; not yet numbered."""
    sides = demographics.select("cid", "bdate", "gen"), locations.select("cid", "cntry")
    born, lives = at_once(customers.sparkSession, *[lambda side=side: measured(side) for side in sides])
    known = left_lookup(customers, born, "cst_key", "cid")
    placed = left_lookup(known, lives, "cst_key", "cid")
    gender = preferred_gender(F.col("cst_gndr"), F.col("gen"))
    return renamed(placed.withColumn("gender", gender), CUSTOMER_NAMES)


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    attributes = customer_attributes(customers, demographics, locations)
    return surrogate_key(attributes, ["customer_id"], "customer_key")


def product_attributes(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Current product versions with their category; not yet numbered."""
    current = products.where(F.col("prd_end_dt").isNull())
    grouped = left_lookup(current, categories.select("id", "cat", "subcat", "maintenance"), "cat_id", "id")
    return renamed(grouped, PRODUCT_NAMES)


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    attributes = product_attributes(products, categories)
    return surrogate_key(attributes, ["start_date", "product_number"], "product_key")


def keyed(attributes: DataFrame, dimension: str, known: DataFrame | None = None) -> DataFrame:
    """Rows of a dimension with keys that keep their meaning from one publish to the next, and ``occurrence``.

    ``known`` is the key map of earlier publishes (``key_map``), None for the first.
    """
    name, identity, order = KEYS[dimension]
    return stable_key(attributes, identity, order, name, known)


def key_map(rows: DataFrame, dimension: str, known: DataFrame | None = None) -> DataFrame:
    """Every key ever given: those of ``rows`` (from ``keyed``), and known ones whose rows are gone."""
    name, identity, _ = KEYS[dimension]
    now = rows.select(name, *identity, OCCURRENCE)
    if known is None:
        return now
    gone = known.join(now.select(F.col(name).alias("__now")), F.col(name) == F.col("__now"), "left_anti")
    return now.unionByName(gone.select(*now.columns))


def with_product_key(sales: DataFrame, products: DataFrame) -> DataFrame:
    return left_lookup(sales, narrowed(products, "product_number", "product_key"), "sls_prd_key", "product_number")


def with_both_keys(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales lines with both keys and one shuffle of their whole rows, for dimensions too large to broadcast.

    Both lookups run on the distinct pairs of product and customer, two narrow columns
    combined before they are shuffled. The lines then meet the translated pairs in one
    join; adaptive execution splits a pair that has many lines.
    """
    pair = ["sls_prd_key", "sls_cust_id"]
    pairs = sales.select(*pair).distinct()
    translated = with_customer_key(with_product_key(pairs, products), customers)
    joined = sales.join(set_aside(translated, pair), same_key(pair), "left")
    return joined.select(*sales.columns, "product_key", "customer_key")


def _large(dimension: DataFrame, *columns: str) -> bool:
    most = limit(dimension.sparkSession, "broadcastBytes")
    known = known_size(dimension)
    return (known is None or known[1] > most) and measure(dimension.select(*columns))[1] > most


def with_customer_key(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return left_lookup(sales, narrowed(customers, "customer_id", "customer_key"), "sls_cust_id", "customer_id")


def key_is_unique(dimension: DataFrame, key: str) -> bool:
    """Whether a lookup on ``key`` finds at most one row; NULL finds none anyway."""
    return repeated_keys(dimension.where(F.col(key).isNotNull()), key, "rows").isEmpty()


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame | None, columns: Sequence[str] = tuple(SALES_NAMES)
) -> DataFrame:
    """Sales lines with the keys of the current product version and the customer.

    Only the business and surrogate key of a dimension enter the join. The customer
    lookup is left out if ``customers`` is None: for callers that do not ask for its
    key and know that the business key is unique, so the join would change nothing.
    """
    if customers is not None and _large(products, "product_number", "product_key") and _large(customers, "customer_id", "customer_key"):
        return renamed(with_both_keys(sales, products, customers), {name: SALES_NAMES[name] for name in columns})
    sales = with_product_key(sales, products)
    if customers is not None:
        sales = with_customer_key(sales, customers)
    return renamed(sales, {name: SALES_NAMES[name] for name in columns})
