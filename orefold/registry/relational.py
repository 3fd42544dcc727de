"""Projections, filters, joins, aggregates, windows, sorts, and stepwise cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.functions import cleaning as c
from orefold.operators.joins import left_lookup, orphans, repeated_keys, rows_not_in, rows_used
from orefold.operators.ordering import latest_per_key, sorted_rows
from orefold.plans import gold, quality, silver
from orefold.registry import oracle as o
from orefold.registry.lake import AS_OF

_NUMBERED = f"*, CAST(row_number() OVER (PARTITION BY cst_id ORDER BY {o.CUST_TIES}) AS INTEGER) AS flag_last"
_SPLIT_KEY = f"prd_id, prd_key, {o.CAT_ID} AS cat_id, {o.PRD_NUM} AS product_number, prd_nm"


def _cust(lake):
    return lake.raw("crm_cust_info")


def _prd(lake):
    return lake.raw("crm_prd_info")


def _sales(lake):
    return lake.raw("crm_sales_details")


def _az12(lake):
    return lake.raw("erp_cust_az12")


def _loc(lake):
    return lake.raw("erp_loc_a101")


def _cat(lake):
    return lake.raw("erp_px_cat_g1v2")


def _split_key(lake):
    key = F.col("prd_key")
    return _prd(lake).withColumns({"cat_id": c.category_id(key), "product_number": c.product_number(key)})


def _erp_customers(lake):
    return left_lookup(lake.clean("crm_cust_info"), lake.clean("erp_cust_az12"), "cst_key", "cid")


QUERIES = {
    # Projections and filters.
    "f01_projection": (lambda lake: _az12(lake).select("cid", "bdate", "gen"), "SELECT cid, bdate, gen FROM raw_az12"),
    "f02_rename": (
        lambda lake: gold.renamed(lake.raw("crm_sales_details"), {"order_number": "sls_ord_num", "quantity": "sls_quantity", "price": "sls_price"}),
        "SELECT sls_ord_num AS order_number, sls_quantity AS quantity, sls_price AS price FROM raw_sales",
    ),
    "f03_all_plus_computed": (
        lambda lake: _cust(lake).withColumn("label", c.crm_gender(F.col("cst_gndr"))),
        f"SELECT *, {o.crm_gender('cst_gndr')} AS label FROM raw_cust",
    ),
    "f04_filter_derived": (
        lambda lake: quality.with_category_id(_prd(lake)).where(F.col("cat_id") == "CO_PE").select("prd_id", "cat_id"),
        f"SELECT prd_id, cat_id FROM (SELECT prd_id, {o.CAT_ID} AS cat_id FROM raw_prd) WHERE cat_id = 'CO_PE'",
    ),
    "f05_compare_constant": (
        lambda lake: _sales(lake).where(F.col("sls_order_dt") > 20000101).select("sls_ord_num", "sls_order_dt"),
        "SELECT sls_ord_num, sls_order_dt FROM raw_sales WHERE sls_order_dt > 20000101",
    ),
    "f06_compare_columns": (
        lambda lake: lake.raw("crm_sales_details").where(F.col("sls_sales") != F.col("sls_quantity") * F.col("sls_price")),
        "SELECT * FROM raw_sales WHERE sls_sales <> sls_quantity * sls_price",
    ),
    "f07_is_null": (
        lambda lake: lake.raw("crm_sales_details").where(F.col("sls_sales").isNull() & F.col("sls_price").isNotNull()).select("sls_ord_num", "sls_price"),
        "SELECT sls_ord_num, sls_price FROM raw_sales WHERE sls_sales IS NULL AND sls_price IS NOT NULL",
    ),
    "f08_three_valued_or": (
        lambda lake: lake.raw("crm_sales_details").where((F.col("sls_sales") <= 0) | (F.col("sls_price") <= 0) | F.col("sls_price").isNull())
        .select("sls_ord_num", "sls_sales", "sls_price"),
        "SELECT sls_ord_num, sls_sales, sls_price FROM raw_sales WHERE sls_sales <= 0 OR coalesce(sls_price, 0) <= 0",
    ),
    "f09_in_list": (
        lambda lake: _az12(lake).where(c.code_form(F.col("gen")).isin("F", "FEMALE")),
        "SELECT * FROM raw_az12 WHERE upper(trim(gen)) IN ('F', 'FEMALE')",
    ),
    "f10_prefix": (
        lambda lake: _az12(lake).where(F.col("cid").startswith("NAS")),
        "SELECT * FROM raw_az12 WHERE starts_with(cid, 'NAS')",
    ),
    "f11_date_range": (
        lambda lake: _sales(lake).where(c.date_key_suspect(F.col("sls_order_dt"))).select("sls_ord_num", "sls_order_dt"),
        f"SELECT sls_ord_num, sls_order_dt FROM raw_sales WHERE {o.suspect('sls_order_dt')}",
    ),
    "f12_filter_window": (
        lambda lake: latest_per_key(_cust(lake), ["cst_id"], silver.NEWEST_FIRST).select("cst_id", "cst_create_date"),
        "SELECT cst_id, max(cst_create_date) AS cst_create_date FROM raw_cust GROUP BY cst_id",
    ),
    "f13_current_versions": (
        lambda lake: lake.clean("crm_prd_info").where(F.col("prd_end_dt").isNull()),
        "SELECT * FROM cln_prd WHERE prd_end_dt IS NULL",
    ),
    # Joins.
    "j01_customer_demographics": (
        lambda lake: _erp_customers(lake).select("cst_id", "cst_key", "bdate", "gen"),
        "SELECT cst_id, cst_key, bdate, gen FROM cln_cust LEFT JOIN cln_az12 ON cid = cst_key",
    ),
    "j02_customer_location": (
        lambda lake: left_lookup(_erp_customers(lake), lake.clean("erp_loc_a101"), "cst_key", "cid").select("cst_id", "bdate", "gen", "cntry"),
        """SELECT cst_id, bdate, gen, cntry FROM cln_cust
           LEFT JOIN cln_az12 a ON a.cid = cst_key LEFT JOIN cln_loc l ON l.cid = cst_key""",
    ),
    "j03_product_category": (
        lambda lake: left_lookup(lake.clean("crm_prd_info"), _cat(lake), "cat_id", "id"),
        "SELECT cln_prd.*, cat, subcat, maintenance FROM cln_prd LEFT JOIN raw_cat ON id = cat_id",
    ),
    "j04_product_key": (
        lambda lake: gold.with_product_key(lake.raw("crm_sales_details").select("sls_ord_num", "sls_prd_key"), lake.products),
        "SELECT sls_ord_num, sls_prd_key, product_key FROM raw_sales LEFT JOIN dim_prd ON product_number = sls_prd_key",
    ),
    "j05_customer_key": (
        lambda lake: gold.with_customer_key(_sales(lake).select("sls_ord_num", "sls_cust_id"), lake.customers),
        "SELECT sls_ord_num, sls_cust_id, customer_key FROM raw_sales LEFT JOIN dim_cust ON customer_id = sls_cust_id",
    ),
    "j06_orphans_by_customer": (
        lambda lake: orphans(_sales(lake).select("sls_ord_num", "sls_cust_id"), "sls_cust_id", lake.clean("crm_cust_info"), "cst_id"),
        "SELECT sls_ord_num, sls_cust_id FROM raw_sales WHERE NOT EXISTS (SELECT 1 FROM raw_cust WHERE cst_id = sls_cust_id)",
    ),
    "j07_orphans_by_product": (
        lambda lake: orphans(lake.raw("crm_sales_details").select("sls_ord_num", "sls_prd_key"), "sls_prd_key",
                             lake.products.where(F.col("category").isNotNull()), "product_number"),
        """SELECT sls_ord_num, sls_prd_key FROM raw_sales WHERE NOT EXISTS
           (SELECT 1 FROM dim_prd WHERE product_number = sls_prd_key AND category IS NOT NULL)""",
    ),
    "j08_not_in": (
        lambda lake: rows_not_in(lake.clean("crm_prd_info").select("prd_id", "cat_id"), "cat_id", _cat(lake).where("id IS NOT NULL"), "id"),
        "SELECT prd_id, cat_id FROM cln_prd WHERE cat_id NOT IN (SELECT id FROM raw_cat WHERE id IS NOT NULL)",
    ),
    "j09_in": (
        lambda lake: rows_used(lake.clean("crm_prd_info").select("prd_id", "prd_key"), "prd_key", lake.raw("crm_sales_details"), "sls_prd_key"),
        "SELECT prd_id, prd_key FROM cln_prd WHERE prd_key IN (SELECT sls_prd_key FROM raw_sales)",
    ),
    "j10_computed_key": (
        lambda lake: left_lookup(_split_key(lake).select("prd_id", "cat_id"), _cat(lake).select("id", "subcat"), "cat_id", "id"),
        f"SELECT prd_id, {o.CAT_ID} AS cat_id, subcat FROM raw_prd LEFT JOIN raw_cat ON id = {o.CAT_ID}",
    ),
    # Aggregates.
    "a01_customer_ids": (
        lambda lake: quality.bad_customer_ids(_cust(lake)),
        "SELECT cst_id, count(*) AS record_count FROM raw_cust GROUP BY cst_id HAVING record_count > 1 OR cst_id IS NULL",
    ),
    "a02_product_keys": (
        lambda lake: repeated_keys(_prd(lake), "prd_key", "record_count", include_null=True),
        "SELECT prd_key, count(*) AS record_count FROM raw_prd GROUP BY prd_key HAVING record_count > 1 OR prd_key IS NULL",
    ),
    "a03_repeated_birthdates": (
        lambda lake: repeated_keys(lake.customers, "birthdate", "duplicate_count"),
        "SELECT birthdate, count(*) AS duplicate_count FROM dim_cust GROUP BY birthdate HAVING duplicate_count > 1",
    ),
    "a04_repeated_categories": (
        lambda lake: repeated_keys(lake.products, "category_id", "duplicate_count"),
        "SELECT category_id, count(*) AS duplicate_count FROM dim_prd GROUP BY category_id HAVING duplicate_count > 1",
    ),
    "a05_distinct_values": (lambda lake: quality.values_in_use(_prd(lake), "prd_line"), "SELECT prd_line FROM raw_prd GROUP BY ALL"),
    "a06_distinct_filtered": (
        lambda lake: quality.odd_birth_dates(_az12(lake), AS_OF),
        f"SELECT bdate FROM raw_az12 WHERE bdate NOT BETWEEN DATE '1924-01-01' AND {o.LITERAL_AS_OF} GROUP BY ALL",
    ),
    "a07_distinct_measures": (
        lambda lake: lake.raw("crm_sales_details").select("sls_sales", "sls_quantity", "sls_price").distinct(),
        "SELECT sls_sales, sls_quantity, sls_price FROM raw_sales GROUP BY ALL",
    ),
    "a08_distinct_computed": (
        lambda lake: lake.raw("crm_sales_details").select(*[v.alias(k) for k, v in silver.sales_measures().items()]).distinct(),
        f"SELECT {o.GOOD_SALES} AS sls_sales, {o.GOOD_PRICE} AS sls_price FROM raw_sales GROUP BY 1, 2",
    ),
    # Windows.
    "w01_numbered": (lambda lake: quality.numbered_customers(_cust(lake)), f"SELECT {_NUMBERED} FROM raw_cust"),
    "w01_latest": (lambda lake: quality.newest_customers(_cust(lake)), f"SELECT {_NUMBERED} FROM raw_cust QUALIFY flag_last = 1"),
    "w02_superseded": (lambda lake: quality.superseded_customers(_cust(lake)), f"SELECT {_NUMBERED} FROM raw_cust QUALIFY flag_last > 1"),
    "w03_customer_key": (
        lambda lake: lake.customers.select("customer_key", "customer_id"),
        "SELECT customer_key, customer_id FROM dim_cust",
    ),
    "w04_product_key": (
        lambda lake: lake.products.select("product_key", "start_date", "product_number"),
        "SELECT product_key, start_date, product_number FROM dim_prd",
    ),
    "w05_next_version": (
        lambda lake: lake.clean("crm_prd_info").select("prd_id", "prd_start_dt", "prd_end_dt"),
        f"SELECT prd_id, CAST(prd_start_dt AS DATE) AS prd_start_dt, {o.REBUILT_END} AS prd_end_dt FROM raw_prd",
    ),
    # Sorts.
    "o01_one_column": (
        lambda lake: quality.values_in_use(_loc(lake), "cntry", ordered=True),
        "SELECT cntry FROM raw_loc GROUP BY ALL ORDER BY cntry NULLS FIRST",
    ),
    "o02_three_columns": (
        lambda lake: sorted_rows(
            lake.raw("crm_sales_details").select("sls_sales", "sls_quantity", "sls_price"), ["sls_sales", "sls_quantity", "sls_price"]
        ),
        "SELECT sls_sales, sls_quantity, sls_price FROM raw_sales ORDER BY ALL NULLS FIRST",
    ),
    "o03_output_alias": (
        lambda lake: sorted_rows(
            lake.raw("crm_sales_details").select("sls_ord_num", silver.sales_measures()["sls_price"].alias("sls_price")),
            ["sls_price", "sls_ord_num"],
        ),
        f"SELECT sls_ord_num, {o.GOOD_PRICE} AS sls_price FROM raw_sales ORDER BY 2 NULLS FIRST, 1",
    ),
    # Cleaning in steps.
    "s01_customers_trimmed": (
        lambda lake: latest_per_key(_cust(lake), ["cst_id"], silver.NEWEST_FIRST).withColumns(
            {n: F.trim(n) for n in ("cst_firstname", "cst_lastname")}
        ),
        f"""SELECT * EXCLUDE (flag_last) REPLACE (trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname)
            FROM (SELECT {_NUMBERED} FROM raw_cust QUALIFY flag_last = 1)""",
    ),
    "s02_products_costed": (
        lambda lake: _split_key(lake).withColumn("prd_cost", c.known_cost(F.col("prd_cost"))),
        f"SELECT {_SPLIT_KEY}, coalesce(prd_cost, 0) AS prd_cost, prd_line, prd_start_dt, prd_end_dt FROM raw_prd",
    ),
    "s03_products_named": (
        lambda lake: _split_key(lake).withColumns(
            {"prd_cost": c.known_cost(F.col("prd_cost")), "prd_line": c.product_line(F.col("prd_line"))}
        ),
        f"SELECT {_SPLIT_KEY}, coalesce(prd_cost, 0) AS prd_cost, {o.line('prd_line')} AS prd_line, prd_start_dt, prd_end_dt FROM raw_prd",
    ),
    "s04_versions_tried": (
        lambda lake: silver.with_version_ends(_prd(lake), "prd_end_dt_test")
        .select("prd_id", "prd_key", "prd_nm", "prd_start_dt", "prd_end_dt", "prd_end_dt_test")
        .where(F.col("prd_key").isin("AC-BR-P000000", "AC-HE-P000001")),
        f"""SELECT prd_id, prd_key, prd_nm, prd_start_dt, prd_end_dt, {o.REBUILT_END} AS prd_end_dt_test
            FROM raw_prd WHERE prd_key IN ('AC-BR-P000000', 'AC-HE-P000001')""",
    ),
    "s05_sales_dated": (
        lambda lake: _sales(lake).withColumns(silver.sales_dates()),
        f"""SELECT * REPLACE ({o.day('sls_order_dt')} AS sls_order_dt, {o.day('sls_ship_dt')} AS sls_ship_dt,
            {o.day('sls_due_dt')} AS sls_due_dt) FROM raw_sales""",
    ),
    "s06_erp_ids": (
        lambda lake: _az12(lake).withColumn("cid", c.without_prefix(F.col("cid"))),
        f"SELECT {o.PREFIXLESS} AS cid, bdate, gen FROM raw_az12",
    ),
    "s07_erp_birth_dates": (
        lambda lake: _az12(lake).withColumns(
            {"cid": c.without_prefix(F.col("cid")), "bdate": c.not_after(F.col("bdate"), F.lit(AS_OF))}
        ),
        f"SELECT {o.PREFIXLESS} AS cid, {o.PAST_BIRTH} AS bdate, gen FROM raw_az12",
    ),
    "s08_location_ids": (
        lambda lake: _loc(lake).withColumn("cid", c.without_hyphens(F.col("cid"))),
        "SELECT replace(cid, '-', '') AS cid, cntry FROM raw_loc",
    ),
}
