"""Data-quality checks over raw tables and the star schema."""

from __future__ import annotations

from orefold.plans import quality as q
from orefold.registry import oracle as o
from orefold.registry.lake import AS_OF

_TABLES = {
    "cust": ("crm_cust_info", "raw_cust"),
    "prd": ("crm_prd_info", "raw_prd"),
    "sales": ("crm_sales_details", "raw_sales"),
    "az12": ("erp_cust_az12", "raw_az12"),
    "loc": ("erp_loc_a101", "raw_loc"),
    "cat": ("erp_px_cat_g1v2", "raw_cat"),
}


def _check(source: str, plan, sql: str):
    table, name = _TABLES[source]
    return lambda lake: plan(lake.raw(table)), sql.format(t=name)


def _lines(plan, sql: str):
    return lambda lake: plan(lake.raw("crm_sales_details")), sql.format(t="raw_sales")


def _values(source: str, column: str):
    return _check(source, lambda df: q.values_in_use(df, column), f"SELECT DISTINCT {column} FROM {{t}}")


def _untrimmed(source: str, column: str):
    spaced = f"starts_with({column}, ' ') OR ends_with({column}, ' ')"
    return _check(source, lambda df: q.untrimmed_values(df, column), f"SELECT {column} FROM {{t}} WHERE {spaced}")


def _bad_dates_sql(column: str) -> str:
    return f"SELECT nullif({column}, 0) AS {column} FROM {{t}} WHERE {o.suspect(column)}"


def _repeated(column: str, table: str) -> str:
    return f"SELECT {column}, count(*) AS duplicate_count FROM {table} GROUP BY {column} HAVING duplicate_count > 1"


_SPACED_CATEGORY = " OR ".join(f"starts_with({n}, ' ') OR ends_with({n}, ' ')" for n in ("cat", "subcat", "maintenance"))
_NO_CUSTOMER = "SELECT * FROM fact ANTI JOIN dim_cust USING (customer_key)"
_NO_PRODUCT = "SELECT * FROM fact ANTI JOIN dim_prd USING (product_key)"
_GATE = {
    "repeated_customer_key": _repeated("customer_key", "dim_cust"),
    "repeated_product_key": _repeated("product_key", "dim_prd"),
    "repeated_customer_id": _repeated("customer_id", "dim_cust"),
    "repeated_product_number": _repeated("product_number", "dim_prd"),
    "fact_without_customer": _NO_CUSTOMER,
    "fact_without_product": _NO_PRODUCT,
}

QUERIES = {
    "d01_customer_ids": _check(
        "cust", q.bad_customer_ids,
        "SELECT cst_id, count(*) AS record_count FROM {t} GROUP BY cst_id HAVING cst_id IS NULL OR record_count > 1",
    ),
    "d02_superseded_customers": _check(
        "cust", q.superseded_customers,
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY cst_id ORDER BY {o.CUST_TIES}) AS INTEGER) AS flag_last
            FROM {{t}} QUALIFY flag_last <> 1""",
    ),
    "d03_untrimmed_first_names": _untrimmed("cust", "cst_firstname"),
    "d03_untrimmed_last_names": _untrimmed("cust", "cst_lastname"),
    "d04_gender_values": _values("cust", "cst_gndr"),
    "d04_marital_values": _values("cust", "cst_marital_status"),
    "d05_product_ids": _check(
        "prd", q.bad_product_ids,
        "SELECT prd_id, count(*) AS record_count FROM {t} GROUP BY prd_id HAVING prd_id IS NULL OR record_count > 1",
    ),
    "d06_unknown_categories": (
        # the id that is missing has a check of its own; left in, it would hide every finding of this one
        lambda lake: q.products_without_category(lake.raw("crm_prd_info"), lake.raw("erp_px_cat_g1v2").where("id IS NOT NULL")),
        f"SELECT *, {o.CAT_ID} AS cat_id FROM raw_prd WHERE {o.CAT_ID} NOT IN (SELECT id FROM raw_cat WHERE id IS NOT NULL)",
    ),
    "d06_null_category_ids": _check("cat", q.null_category_ids, "SELECT * FROM {t} WHERE id IS NULL"),
    "d07_products_sold": (
        lambda lake: q.products_sold(lake.raw("crm_prd_info"), lake.raw("crm_sales_details")),
        f"""SELECT *, {o.CAT_ID} AS cat_id, {o.PRD_NUM} AS product_number FROM raw_prd
            WHERE {o.PRD_NUM} IN (SELECT sls_prd_key FROM raw_sales)""",
    ),
    "d08_costs": _check("prd", q.bad_costs, "SELECT prd_cost FROM {t} WHERE coalesce(prd_cost, -1) < 0"),
    "d09_product_line_values": _values("prd", "prd_line"),
    "d10_reversed_versions": _check("prd", q.reversed_versions, "SELECT * FROM {t} WHERE prd_start_dt > prd_end_dt"),
    "d11_nonpositive_order_dates": _check(
        "sales", lambda df: q.nonpositive_dates(df, "sls_order_dt"), "SELECT sls_order_dt FROM {t} WHERE sls_order_dt <= 0"
    ),
    "d12_order_dates": _check("sales", lambda df: q.bad_dates(df, "sls_order_dt"), _bad_dates_sql("sls_order_dt")),
    "d12_ship_dates": _lines(lambda df: q.bad_dates(df, "sls_ship_dt"), _bad_dates_sql("sls_ship_dt")),
    "d12_due_dates": _lines(lambda df: q.bad_dates(df, "sls_due_dt"), _bad_dates_sql("sls_due_dt")),
    "d13_late_orders": _check(
        "sales", q.late_orders, "SELECT * FROM {t} WHERE sls_order_dt > least(sls_ship_dt, sls_due_dt)"
    ),
    "d14_measures": _lines(q.bad_measures, f"SELECT DISTINCT sls_sales, sls_quantity, sls_price FROM {{t}} WHERE {o.DISAGREE}"),
    "d15_measures_repaired": _lines(
        q.repaired_measures,
        f"""SELECT DISTINCT sls_sales AS old_sls_sales, sls_quantity, sls_price AS old_sls_price,
            {o.GOOD_SALES} AS sls_sales, {o.GOOD_PRICE} AS sls_price FROM {{t}} WHERE {o.DISAGREE}""",
    ),
    "d16_birth_dates": _check(
        "az12", lambda df: q.odd_birth_dates(df, AS_OF),
        f"SELECT DISTINCT bdate FROM {{t}} WHERE bdate NOT BETWEEN DATE '1924-01-01' AND {o.LITERAL_AS_OF}",
    ),
    "d17_erp_gender_values": _values("az12", "gen"),
    "d18_country_values": _check(
        "loc", lambda df: q.values_in_use(df, "cntry", ordered=True), "SELECT DISTINCT cntry FROM {t} ORDER BY cntry NULLS FIRST"
    ),
    "d19_untrimmed_categories": _check(
        "cat", lambda df: q.untrimmed_rows(df, "cat", "subcat", "maintenance"), f"SELECT * FROM {{t}} WHERE {_SPACED_CATEGORY}"
    ),
    "d20_category_values": _values("cat", "cat"),
    "d20_subcategory_values": _values("cat", "subcat"),
    "d20_maintenance_values": _values("cat", "maintenance"),
    "d21_customer_keys": (lambda lake: q.repeated_customer_keys(lake.customers), _GATE["repeated_customer_key"]),
    "d21_customer_business_keys": (lambda lake: q.repeated_customer_ids(lake.customers), _GATE["repeated_customer_id"]),
    "d22_product_keys": (lambda lake: q.repeated_product_keys(lake.products), _GATE["repeated_product_key"]),
    "d22_product_business_keys": (lambda lake: q.repeated_product_numbers(lake.products), _GATE["repeated_product_number"]),
    "d23_facts_without_customer": (
        lambda lake: q.lines_without_customer(lake.clean("crm_sales_details"), lake.customers, lake.products),
        _NO_CUSTOMER,
    ),
    "d24_facts_without_product": (lambda lake: q.facts_without_product(lake.facts, lake.products), _NO_PRODUCT),
    "gate_star_schema": (
        lambda lake: q.gate(lake.fact_columns("customer_key", "product_key"), lake.customers, lake.products),
        " UNION ALL ".join(
            f"SELECT '{name}' AS check_name, count(*) AS failing_rows FROM ({sql})" for name, sql in _GATE.items()
        ),
    ),
}
