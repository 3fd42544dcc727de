"""The layers over one folder of tables, as the registered queries see them."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from orefold.plans import gold, silver
from orefold.session import at_once
from orefold.sources.feeds import Feeds

# Stands for the current date, so that results do not change from day to day.
AS_OF = dt.date(2025, 12, 31)


class Lake:
    """Lazy raw, cleaned and star-schema tables; dimensions are built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.feeds = Feeds(spark, folder)

    def raw(self, table: str) -> DataFrame:
        return self.feeds.feed(table)

    def clean(self, table: str) -> DataFrame:
        return silver.clean(table, self.raw(table), AS_OF)

    @cached_property
    def customers(self) -> DataFrame:
        return gold.dim_customers(
            self.clean("crm_cust_info"), self.clean("erp_cust_az12"), self.clean("erp_loc_a101")
        )

    @cached_property
    def products(self) -> DataFrame:
        return gold.dim_products(self.clean("crm_prd_info"), self.clean("erp_px_cat_g1v2"))

    @property
    def dimensions(self) -> tuple[DataFrame, DataFrame]:
        """Customers and products, built side by side."""
        customers, products = at_once(self.spark, lambda: self.customers, lambda: self.products)
        return customers, products

    @property
    def facts(self) -> DataFrame:
        return self.fact_columns(*gold.SALES_NAMES)

    @cached_property
    def one_row_per_customer(self) -> bool:
        """Whether a customer id occurs once in the dimension.

        It does before the lookups (one record per id is kept), so only the keys of
        the two ERP tables need counting, not the dimension.
        """
        tables = ("erp_cust_az12", "erp_loc_a101")
        return all(at_once(self.spark, *[lambda t=t: gold.key_is_unique(self.clean(t), "cid") for t in tables]))

    def fact_columns(self, *columns: str) -> DataFrame:
        """Some columns of the fact, without the customer lookup where it changes nothing."""
        if "customer_key" in columns or not self.one_row_per_customer:
            products, customers = at_once(self.spark, lambda: self.products, lambda: self.customers)
        else:
            products, customers = self.products, None
        return gold.fact_sales(self.clean("crm_sales_details"), products, customers, columns)
