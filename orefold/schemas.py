"""Declared columns of every stored table, in storage order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "mart")
AUDIT_COLUMN = "dwh_create_date"

# Text columns hold at most 50 characters. Readers see plain strings; stored
# tables are declared VARCHAR(50), so a longer value is refused on insert.
_SPARK = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "text": T.StringType(),
    "note": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}
_DDL = {"text": "varchar(50)", "note": "string"}

# Table and column names and types.
BRONZE = {
    "crm_cust_info": {
        "cst_id": "int",
        "cst_key": "text",
        "cst_firstname": "text",
        "cst_lastname": "text",
        "cst_marital_status": "text",
        "cst_gndr": "text",
        "cst_create_date": "date",
    },
    "crm_prd_info": {
        "prd_id": "int",
        "prd_key": "text",
        "prd_nm": "text",
        "prd_cost": "int",
        "prd_line": "text",
        "prd_start_dt": "timestamp",
        "prd_end_dt": "timestamp",
    },
    "crm_sales_details": {
        "sls_ord_num": "text",
        "sls_prd_key": "text",
        "sls_cust_id": "int",
        "sls_order_dt": "int",
        "sls_ship_dt": "int",
        "sls_due_dt": "int",
        "sls_sales": "int",
        "sls_quantity": "int",
        "sls_price": "int",
    },
    "erp_loc_a101": {"cid": "text", "cntry": "text"},
    "erp_cust_az12": {"cid": "text", "bdate": "date", "gen": "text"},
    "erp_px_cat_g1v2": {"id": "text", "cat": "text", "subcat": "text", "maintenance": "text"},
}

_AUDIT = {AUDIT_COLUMN: "timestamp"}
_SALES_DATES = {"sls_order_dt": "date", "sls_ship_dt": "date", "sls_due_dt": "date"}

SILVER = {
    "crm_cust_info": {**BRONZE["crm_cust_info"], **_AUDIT},
    "crm_prd_info": {
        "prd_id": "int",
        "cat_id": "text",
        "prd_key": "text",
        "prd_nm": "text",
        "prd_cost": "int",
        "prd_line": "text",
        "prd_start_dt": "date",
        "prd_end_dt": "date",
        **_AUDIT,
    },
    "crm_sales_details": {**BRONZE["crm_sales_details"], **_SALES_DATES, **_AUDIT},
    "erp_cust_az12": {**BRONZE["erp_cust_az12"], **_AUDIT},
    "erp_loc_a101": {**BRONZE["erp_loc_a101"], **_AUDIT},
    "erp_px_cat_g1v2": {**BRONZE["erp_px_cat_g1v2"], **_AUDIT},
}

GOLD = {
    "dim_customers": {
        "customer_key": "int",
        "customer_id": "int",
        "customer_number": "text",
        "first_name": "text",
        "last_name": "text",
        "country": "text",
        "marital_status": "text",
        "gender": "text",
        "birthdate": "date",
        "create_date": "date",
    },
    "dim_products": {
        "product_key": "int",
        "product_id": "int",
        "product_number": "text",
        "product_name": "text",
        "category_id": "text",
        "category": "text",
        "subcategory": "text",
        "maintenance": "text",
        "cost": "int",
        "product_line": "text",
        "start_date": "date",
    },
    "dim_customers_parts": {"customer_id": "int", "customer_key": "int", "part": "int"},
    "dim_products_parts": {"product_number": "text", "product_key": "int", "part": "int"},
    "dim_customers_hot": {"customer_id": "int", "parts": "int"},
    "dim_products_hot": {"product_number": "text", "parts": "int"},
    "dim_customers_keys": {"customer_key": "int", "customer_id": "int", "occurrence": "int"},
    "dim_products_keys": {"product_key": "int", "product_number": "text", "occurrence": "int"},
    "fact_sales": {
        "order_number": "text",
        "product_key": "int",
        "customer_key": "int",
        "order_date": "date",
        "shipping_date": "date",
        "due_date": "date",
        "sales_amount": "int",
        "quantity": "int",
        "price": "int",
    },
}

_TOTALS = {"lines": "bigint", "orders": "bigint", "quantity": "bigint", "sales_amount": "bigint"}

MARTS = {
    "flat_sales": {
        **GOLD["fact_sales"],
        **{n: k for d in ("dim_products", "dim_customers") for n, k in GOLD[d].items() if n not in GOLD["fact_sales"]},
    },
    "sales_by_product_group_parts": {"part": "int", "category": "text", "product_line": "text", **_TOTALS},
    "sales_by_product_group": {"category": "text", "product_line": "text", **_TOTALS},
    "sales_by_customer_group": {"country": "text", "gender": "text", "marital_status": "text", **_TOTALS},
    "customer_profile": {"customer_key": "int", "customer_id": "int", "age": "int", "days_as_customer": "int"},
}

CHECK_RESULTS = {
    "run_id": "note",
    "checked_at": "timestamp",
    "layer": "note",
    "table_name": "note",
    "check_name": "note",
    "checked_rows": "bigint",
    "failing_rows": "bigint",
}

RUN_LOG = {
    "run_id": "note",
    "layer": "note",
    "table_name": "note",
    "started_at": "timestamp",
    "ended_at": "timestamp",
    "seconds": "int",
    "row_count": "bigint",
    "rejected_count": "bigint",
    "status": "note",
    "error_class": "note",
    "error_state": "note",
    "error_message": "note",
    "error_category": "note",
}

REJECTED_LINES = {
    "run_id": "note",
    "table_name": "note",
    "rejected_line": "note",
}

# One row per published star schema; the newest live one is what readers see.
GENERATIONS = {
    "generation": "note",
    "run_id": "note",
    "published_at": "timestamp",
    "state": "note",
}

TABLES = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD, "mart": MARTS}


def struct(columns: dict[str, str]) -> T.StructType:
    """Reader schema; every column is nullable."""
    return T.StructType([T.StructField(n, _SPARK[k], True) for n, k in columns.items()])


def ddl(columns: dict[str, str]) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"{n} {_DDL.get(k, k)}" for n, k in columns.items())


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns by name, in declared order and type."""
    return df.select(*[F.col(n).cast(_SPARK[k]).alias(n) for n, k in columns.items()])
