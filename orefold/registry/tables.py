"""Raw, cleaned and star-schema tables, and the marts over them."""

from __future__ import annotations

from orefold.plans import marts
from orefold.registry.lake import AS_OF
from orefold.registry.oracle import LITERAL_AS_OF

_RAW = {
    "crm_cust_info": "raw_cust",
    "crm_prd_info": "raw_prd",
    "crm_sales_details": "raw_sales",
    "erp_cust_az12": "raw_az12",
    "erp_loc_a101": "raw_loc",
    "erp_px_cat_g1v2": "raw_cat",
}

_TOTALS = """count(*) AS lines, count(DISTINCT order_number) AS orders,
    CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(sales_amount) AS BIGINT) AS sales_amount"""

QUERIES = {
    **{
        f"p14_review_{table}": (lambda lake, t=table: lake.raw(t), f"SELECT * FROM {name}")
        for table, name in _RAW.items()
    },
    "p08_pass_through": (lambda lake: lake.clean("erp_px_cat_g1v2"), "SELECT * FROM raw_cat"),
    "t01_clean_customers": (lambda lake: lake.clean("crm_cust_info"), "SELECT * FROM cln_cust"),
    "t02_clean_products": (lambda lake: lake.clean("crm_prd_info"), "SELECT * FROM cln_prd"),
    "t03_clean_sales": (lambda lake: lake.clean("crm_sales_details"), "SELECT * FROM cln_sales"),
    "t04_clean_demographics": (lambda lake: lake.clean("erp_cust_az12"), "SELECT * FROM cln_az12"),
    "t05_clean_locations": (lambda lake: lake.clean("erp_loc_a101"), "SELECT * FROM cln_loc"),
    "t06_clean_categories": (lambda lake: lake.clean("erp_px_cat_g1v2"), "SELECT id, cat, subcat, maintenance FROM raw_cat"),
    "t07_dim_customers": (lambda lake: lake.customers, "SELECT * FROM dim_cust"),
    "t08_dim_products": (lambda lake: lake.products, "SELECT * FROM dim_prd"),
    "t09_fact_sales": (lambda lake: lake.facts, "SELECT * FROM fact"),
    "m01_flat_sales": (
        lambda lake: marts.flat_lines(lake.clean("crm_sales_details"), *lake.dimensions),
        """SELECT fact.*, dim_prd.* EXCLUDE (product_key), dim_cust.* EXCLUDE (customer_key)
           FROM fact LEFT JOIN dim_prd USING (product_key) LEFT JOIN dim_cust USING (customer_key)""",
    ),
    "m02_sales_by_product_group": (
        lambda lake: marts.sales_by_product_group(
            lake.fact_columns("order_number", "product_key", "quantity", "sales_amount"), lake.products
        ),
        f"SELECT category, product_line, {_TOTALS} FROM fact LEFT JOIN dim_prd USING (product_key) GROUP BY ALL",
    ),
    "m02_sales_by_customer_group": (
        lambda lake: marts.sales_by_customer_group(
            lake.fact_columns("order_number", "customer_key", "quantity", "sales_amount"), lake.customers
        ),
        f"SELECT country, gender, marital_status, {_TOTALS} FROM fact LEFT JOIN dim_cust USING (customer_key) GROUP BY ALL",
    ),
    "m03_customer_profile": (
        lambda lake: marts.customer_profile(lake.customers, AS_OF),
        f"""SELECT customer_key, customer_id, CAST(datesub('year', birthdate, {LITERAL_AS_OF}) AS INTEGER) AS age,
                   CAST({LITERAL_AS_OF} - create_date AS INTEGER) AS days_as_customer FROM dim_cust""",
    ),
    "m04_amount_mismatches": (
        lambda lake: marts.amount_mismatches(lake.facts),
        "SELECT * FROM fact WHERE sales_amount IS DISTINCT FROM quantity * price",
    ),
}
