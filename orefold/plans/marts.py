"""Flat and aggregated sales tables over the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.operators.joins import left_lookup
from orefold.operators.skew import measure, narrowed
from orefold.plans.gold import SALES_NAMES
from orefold.session import limit

CUSTOMER_COLUMNS = ["customer_id", "customer_number", "first_name", "last_name", "country", "marital_status", "gender", "birthdate", "create_date"]
PRODUCT_COLUMNS = ["product_id", "product_number", "product_name", "category_id", "category", "subcategory", "maintenance", "cost", "product_line", "start_date"]


# A table to look up, the lines' key and the table's key.
Side = tuple[DataFrame, str, str]


def _is_large(side: Side) -> bool:
    return measure(side[0])[1] > limit(side[0].sparkSession, "broadcastBytes")


def _in_turn(*sides: Side) -> list[Side]:
    """A side too large to broadcast has the lines shuffled, so those come first, while lines are short, and of them the one that makes lines less long."""

    def turn(side: Side) -> tuple[bool, float]:
        rows, size = measure(side[0])
        return not _is_large(side), size / max(1, rows)

    return sorted(sides, key=turn)


def _looked_up(lines: DataFrame, *sides: Side) -> DataFrame:
    """Lines with all sides."""
    for side, line_key, key in _in_turn(*sides):
        lines = left_lookup(lines, side, line_key, key)
    return lines


def flat_sales(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One wide row per sales line; every line stays, known or not."""
    product = narrowed(products, "product_key", *PRODUCT_COLUMNS), "product_key", "product_key"
    customer = narrowed(customers, "customer_key", *CUSTOMER_COLUMNS), "customer_key", "customer_key"
    return _looked_up(facts, product, customer).select(*facts.columns, *PRODUCT_COLUMNS, *CUSTOMER_COLUMNS)


def _sides(customers: DataFrame, products: DataFrame) -> tuple[Side, Side]:
    product = narrowed(products, "product_key", *PRODUCT_COLUMNS), "sls_prd_key", "product_number"
    customer = narrowed(customers, "customer_key", *CUSTOMER_COLUMNS), "sls_cust_id", "customer_id"
    return product, customer


def flat_lines(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The rows of ``flat_sales`` straight from cleaned sales: each dimension is joined once, key and attributes together."""
    return _flat(sales, *_sides(customers, products))


def flat_parts(sales: DataFrame, customers: DataFrame, products: DataFrame) -> list[DataFrame]:
    """``flat_lines`` in parts for one write after the other, of about ``linesAtOnce`` lines where lines are shuffled.

    Lines of a key of the first lookup stay together, so what they get from it compresses
    as well as in one write; a key with many lines makes its part larger.
    """
    sides = _sides(customers, products)
    first, key, _ = side = _in_turn(*sides)[0]
    parts = -(-sales.count() // max(1, limit(first.sparkSession, "linesAtOnce"))) if _is_large(side) else 1
    if parts <= 1:
        return [_flat(sales, *sides)]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    return [_flat(sales.where(part == n), *sides) for n in range(parts)]


def _flat(sales: DataFrame, product: Side, customer: Side) -> DataFrame:
    named = _looked_up(sales, product, customer)
    # a lookup returns its key column no more: it is the line's own where one was found
    found = {key: F.when(F.col(surrogate).isNotNull(), F.col(line)) for surrogate, line, key in (("product_key", *product[1:]), ("customer_key", *customer[1:]))}
    lines = [F.col(old).alias(new) for new, old in SALES_NAMES.items()]
    return named.withColumns(found).select(*lines, *PRODUCT_COLUMNS, *CUSTOMER_COLUMNS)


def _totals() -> list[Column]:
    return [
        F.count("*").alias("lines"),
        F.countDistinct("order_number").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.sum("sales_amount").alias("sales_amount"),
    ]


def sales_by_product_group(facts: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per category and product line."""
    groups = narrowed(products, "product_key", "category", "product_line")
    return left_lookup(facts, groups, "product_key", "product_key").groupBy("category", "product_line").agg(*_totals())


def sales_by_customer_group(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals per country, gender and marital status."""
    groups = narrowed(customers, "customer_key", "country", "gender", "marital_status")
    joined = left_lookup(facts, groups, "customer_key", "customer_key")
    return joined.groupBy("country", "gender", "marital_status").agg(*_totals())


# Orders are dealt to this many parts by their number; all lines of an order are in one.
PARTS = 256
_BUCKET = "part"


def partial_sales(facts: DataFrame, dimension: DataFrame, key: str, groups: Sequence[str], parts: int = PARTS) -> DataFrame:
    """Totals per part of the orders and group, from which ``merged_sales`` rebuilds a mart.

    An order's lines are all in one part, so the number of different orders of a group
    is the sum of its parts', and a part whose orders change is computed again alone.
    The facts shrink to a row per order and group before they are shuffled.
    """
    named = left_lookup(facts, narrowed(dimension, key, *groups), key, key)
    per_order = named.groupBy(*groups, "order_number").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"), F.sum("sales_amount").alias("sales_amount"))
    part = F.pmod(F.xxhash64("order_number"), F.lit(parts)).cast("int")
    sums = [F.sum(c).alias(c) for c in ("lines", "quantity", "sales_amount")]
    return per_order.groupBy(part.alias(_BUCKET), *groups).agg(F.count("order_number").alias("orders"), *sums)


def merged_sales(partials: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The totals of ``partial_sales`` over all parts."""
    return partials.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("lines", "orders", "quantity", "sales_amount")])


def customer_profile(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Completed years of age and days since the customer record was created."""
    today = F.lit(as_of)
    return customers.select(
        "customer_key",
        "customer_id",
        F.timestamp_diff("YEAR", F.col("birthdate").cast("timestamp"), today.cast("timestamp")).cast("int").alias("age"),
        F.date_diff(today, "create_date").alias("days_as_customer"),
    )


def amount_mismatches(facts: DataFrame) -> DataFrame:
    """Lines that break ``sales_amount = quantity * price``; a NULL breaks it too."""
    return facts.where(~F.col("sales_amount").eqNullSafe(F.col("quantity") * F.col("price")))
