"""Cleaned tables: one function per table, raw DataFrame in, cleaned DataFrame out.

The load-time column is added by the job that stores the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import cleaning as c
from orefold.operators.ordering import latest_per_key, lead_within

NEWEST_FIRST = ["-cst_create_date"]


def customers(raw: DataFrame) -> DataFrame:
    """Latest record per customer id, names trimmed, codes spelled out."""
    latest = latest_per_key(raw.where(F.col("cst_id").isNotNull()), ["cst_id"], NEWEST_FIRST)
    return latest.withColumns(
        {
            "cst_firstname": c.trimmed(F.col("cst_firstname")),
            "cst_lastname": c.trimmed(F.col("cst_lastname")),
            "cst_marital_status": c.marital_status(F.col("cst_marital_status")),
            "cst_gndr": c.crm_gender(F.col("cst_gndr")),
        }
    )


def with_version_ends(raw: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the day before the next version of the same raw key starts."""
    ahead = lead_within(raw, ["prd_key"], ["prd_start_dt"], "prd_start_dt", "__next")
    return ahead.withColumn(name, F.date_sub(F.to_date("__next"), 1)).drop("__next")


def products(raw: DataFrame) -> DataFrame:
    """Key split into category and product number, versions closed without gaps.

    The delivered end date is discarded. Versions belong to the raw key, so they
    are linked before the key is shortened.
    """
    key = F.col("prd_key")
    return with_version_ends(raw.drop("prd_end_dt"), "prd_end_dt").select(
        "prd_id",
        c.category_id(key).alias("cat_id"),
        c.product_number(key).alias("prd_key"),
        "prd_nm",
        c.known_cost(F.col("prd_cost")).alias("prd_cost"),
        c.product_line(F.col("prd_line")).alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        "prd_end_dt",
    )


SALES_DATES = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")


def sales_dates(columns: Sequence[str] = SALES_DATES) -> dict[str, Column]:
    return {name: c.date_from_key(F.col(name)) for name in SALES_DATES if name in columns}


def sales_measures() -> dict[str, Column]:
    """Both repairs read the amounts as delivered, not each other's result."""
    measures = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return {"sls_sales": c.repaired_sales(*measures), "sls_price": c.repaired_price(*measures)}


def sales(raw: DataFrame) -> DataFrame:
    return raw.withColumns({**sales_dates(raw.columns), **sales_measures()})


def demographics(raw: DataFrame, as_of: dt.date) -> DataFrame:
    return raw.withColumns(
        {
            "cid": c.without_prefix(F.col("cid")),
            "bdate": c.not_after(F.col("bdate"), F.lit(as_of)),
            "gen": c.erp_gender(F.col("gen")),
        }
    )


def locations(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"cid": c.without_hyphens(F.col("cid")), "cntry": c.country(F.col("cntry"))})


def categories(raw: DataFrame) -> DataFrame:
    return raw.select("id", "cat", "subcat", "maintenance")


def clean(table: str, raw: DataFrame, as_of: dt.date) -> DataFrame:
    """The cleaned form of any raw table; ``as_of`` stands for the current date."""
    if table == "erp_cust_az12":
        return demographics(raw, as_of)
    return {
        "crm_cust_info": customers,
        "crm_prd_info": products,
        "crm_sales_details": sales,
        "erp_loc_a101": locations,
        "erp_px_cat_g1v2": categories,
    }[table](raw)
