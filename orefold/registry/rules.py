"""Cleaning rules and scalar functions, each on the column it serves.

An entry names the input, the columns kept beside the result, the Spark
expression and the SQL expression.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orefold.functions import cleaning as c
from orefold.operators.ordering import latest_per_key
from orefold.plans import silver
from orefold.registry import oracle as o
from orefold.registry.lake import AS_OF

_INPUTS = {
    "cust": ("raw_cust", lambda lake: lake.raw("crm_cust_info"), ["cst_key", "cst_create_date"]),
    "prd": ("raw_prd", lambda lake: lake.raw("crm_prd_info"), ["prd_id"]),
    "sales": ("raw_sales", lambda lake: lake.raw("crm_sales_details"), ["sls_ord_num", "sls_cust_id"]),
    "lines": ("raw_sales", lambda lake: lake.raw("crm_sales_details"), ["sls_ord_num", "sls_prd_key"]),
    "az12": ("raw_az12", lambda lake: lake.raw("erp_cust_az12"), ["cid"]),
    "loc": ("raw_loc", lambda lake: lake.raw("erp_loc_a101"), ["cid"]),
}
_STARTED = dt.datetime(2025, 12, 31, 12, 0, 0)


def _rule(source: str, column: Callable[[], Column], sql: str):
    name, read, beside = _INPUTS[source]
    return (
        lambda lake: read(lake).select(*beside, column().alias("result")),
        f"SELECT {', '.join(beside)}, {sql} AS result FROM {name}",
    )


def _col(name: str) -> Column:
    return F.col(name)


def _measures() -> tuple[Column, Column, Column]:
    return F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")


QUERIES = {
    # Cleaning rules.
    "c01_marital_status": _rule("cust", lambda: c.marital_status(_col("cst_marital_status")), o.marital("cst_marital_status")),
    "c02_crm_gender": _rule("cust", lambda: c.crm_gender(_col("cst_gndr")), o.crm_gender("cst_gndr")),
    "c03_product_line": _rule("prd", lambda: c.product_line(_col("prd_line")), o.line("prd_line")),
    "c04_erp_gender": _rule("az12", lambda: c.erp_gender(_col("gen")), o.erp_gender("gen")),
    "c05_country": _rule("loc", lambda: c.country(_col("cntry")), o.country("cntry")),
    "c06_without_prefix": _rule("az12", lambda: c.without_prefix(_col("cid")), o.PREFIXLESS),
    "c07_without_hyphens": _rule("loc", lambda: c.without_hyphens(_col("cid")), "translate(cid, '-', '')"),
    "c08_category_id": _rule("prd", lambda: c.category_id(_col("prd_key")), o.CAT_ID),
    "c09_product_number": _rule("prd", lambda: c.product_number(_col("prd_key")), o.PRD_NUM),
    "c10_date_from_key": _rule("sales", lambda: c.date_from_key(_col("sls_order_dt")), o.day("sls_order_dt")),
    "c11_not_after": _rule("az12", lambda: c.not_after(_col("bdate"), F.lit(AS_OF)), o.PAST_BIRTH),
    "c12_known_cost": _rule("prd", lambda: c.known_cost(_col("prd_cost")), "coalesce(prd_cost, 0)"),
    "c13_repaired_sales": _rule("lines", lambda: c.repaired_sales(*_measures()), o.GOOD_SALES),
    "c14_repaired_price": _rule("lines", lambda: c.repaired_price(*_measures()), o.GOOD_PRICE),
    "c15_trimmed_names": _rule("cust", lambda: c.trimmed(_col("cst_firstname")), "trim(cst_firstname)"),
    "c16_latest_customers": (
        lambda lake: latest_per_key(
            lake.raw("crm_cust_info").where(_col("cst_id").isNotNull()),
            ["cst_id"],
            silver.NEWEST_FIRST,
        ),
        "SELECT * FROM newest_cust",
    ),
    "c17_version_ends": (
        lambda lake: silver.with_version_ends(lake.raw("crm_prd_info"), "rebuilt_end"),
        f"SELECT *, {o.REBUILT_END} AS rebuilt_end FROM raw_prd",
    ),
    "c18_preferred_gender": (
        lambda lake: lake.customers.select("customer_id", "gender"),
        "SELECT customer_id, gender FROM dim_cust",
    ),
    # Scalar functions.
    "x01_trim": _rule("cust", lambda: F.trim("cst_lastname"), "trim(cst_lastname)"),
    "x02_upper": _rule("az12", lambda: F.upper("gen"), "upper(gen)"),
    "x03_leading_characters": _rule("prd", lambda: F.substring("prd_key", 1, 5), "left(prd_key, 5)"),
    "x04_suffix": _rule("prd", lambda: F.substr("prd_key", F.lit(7)), "substr(prd_key, 7)"),
    "x05_text_length": _rule("prd", lambda: F.length("prd_key"), "CAST(length(prd_key) AS INTEGER)"),
    "x06_number_length": _rule("sales", lambda: F.length(_col("sls_order_dt").cast("string")), "CAST(length(CAST(sls_order_dt AS VARCHAR)) AS INTEGER)"),
    "x07_swap_characters": _rule("prd", lambda: F.translate("prd_key", "-", "_"), "replace(prd_key, '-', '_')"),
    "x08_delete_characters": _rule("loc", lambda: F.replace("cid", F.lit("-"), F.lit("")), "replace(cid, '-', '')"),
    "x09_concatenate": _rule("lines", lambda: F.concat("sls_ord_num", F.lit(" "), "sls_prd_key"), "sls_ord_num || ' ' || sls_prd_key"),
    "x10_default_for_null": _rule("prd", lambda: F.coalesce("prd_cost", F.lit(0)), "ifnull(prd_cost, 0)"),
    "x11_null_if_equal": _rule("sales", lambda: F.nullif("sls_order_dt", F.lit(0)), "nullif(sls_order_dt, 0)"),
    "x12_first_not_null": _rule("az12", lambda: F.coalesce("gen", F.lit("n/a")), "ifnull(gen, 'n/a')"),
    "x13_absolute": _rule("lines", lambda: F.abs("sls_price"), "abs(sls_price)"),
    "x14_multiply": _rule("lines", lambda: _col("sls_quantity") * _col("sls_price"), "sls_quantity * sls_price"),
    "x15_whole_quotient": _rule("lines", lambda: c.whole_quotient(*_measures()[:2]), "CAST(sls_sales // nullif(sls_quantity, 0) AS INTEGER)"),
    "x16_day_before": _rule("prd", lambda: F.date_sub("prd_start_dt", 1), "CAST(prd_start_dt AS DATE) - 1"),
    "x17_case": _rule("lines", lambda: F.when(_col("sls_sales") > 0, "sold").otherwise("other"), "if(sls_sales > 0, 'sold', 'other')"),
    "x18_number_to_date": _rule("lines", lambda: c.date_from_key(_col("sls_ship_dt")), o.day("sls_ship_dt")),
    "x19_moment_to_date": _rule("prd", lambda: F.to_date("prd_end_dt"), "CAST(prd_end_dt AS DATE)"),
    "x20_number_to_text": _rule("cust", lambda: _col("cst_id").cast("string"), "CAST(cst_id AS VARCHAR)"),
    "x21_current_date": _rule("az12", lambda: _col("bdate") > F.lit(AS_OF), f"bdate > {o.LITERAL_AS_OF}"),
    "x22_seconds_between": _rule(
        "cust",
        lambda: F.timestamp_diff("SECOND", _col("cst_create_date").cast("timestamp"), F.lit(_STARTED)),
        f"date_diff('second', CAST(cst_create_date AS TIMESTAMP), TIMESTAMP '{_STARTED}')",
    ),
}
