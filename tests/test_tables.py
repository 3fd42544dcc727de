"""Cleaned and star-schema tables: worked cases, known counts, properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import bag, column
from orefold.plans import gold, marts, quality, silver
from orefold.registry.lake import AS_OF, Lake
from orefold.schemas import BRONZE, struct

D, T = dt.date, dt.datetime

# A few product versions as delivered: two helmets, no line code, a pedal, no cost.
PRODUCTS = [
    (21, "CO-RF-OAK-7", "Oak frame, size 7", None, "R ", T(2009, 2, 1), None),
    (31, "AC-HE-DOME-2B", "Dome helmet, blue", 21, "S ", T(2015, 3, 1), T(2012, 5, 9)),
    (32, "AC-HE-DOME-2B", "Dome helmet, blue", 22, "S ", T(2016, 4, 1), T(2013, 6, 8)),
    (33, "AC-HE-DOME-2B", "Dome helmet, blue", 23, "S ", T(2017, 5, 1), None),
    (34, "AC-HE-DOME-2", "Dome helmet, grey", 21, "S ", T(2015, 3, 1), T(2012, 5, 9)),
    (35, "AC-HE-DOME-2", "Dome helmet, grey", 22, "S ", T(2016, 4, 1), T(2013, 6, 8)),
    (36, "AC-HE-DOME-2", "Dome helmet, grey", 23, "S ", T(2017, 5, 1), None),
    (57, "CO-PE-CLIP-4", "Clip pedal", 38, None, T(2018, 6, 1), None),
]
CATEGORIES = [("AC_HE", "Accessories", "Helmets", "Yes"), ("CO_RF", "Components", "Road Frames", "Yes"), ("CO_PD", "Components", "Pedals", "No")]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, struct(BRONZE["crm_prd_info"]))


@pytest.fixture(scope="module")
def categories(spark):
    return spark.createDataFrame(CATEGORIES, struct(BRONZE["erp_px_cat_g1v2"]))


@pytest.fixture(scope="module")
def lake(spark, medium):
    return Lake(spark, medium)


@pytest.mark.parametrize("limits", ["usual", "lowered"])
def test_versions_close_the_day_before_the_next(spark, products, request, limits):
    if limits == "lowered":
        request.getfixturevalue("hot")
        spark.conf.set("spark.orefold.hotGroupRows", "2")
    ends = {r.prd_id: r.prd_end_dt for r in silver.products(products).collect()}
    assert ends == {
        21: None,
        31: D(2016, 3, 31),
        32: D(2017, 4, 30),
        33: None,
        34: D(2016, 3, 31),
        35: D(2017, 4, 30),
        36: None,
        57: None,
    }


def test_versions_do_not_overlap(lake):
    v = lake.clean("crm_prd_info").select("cat_id", "prd_key", "prd_start_dt", "prd_end_dt")
    later = v.select(*[F.col(c).alias(f"later_{c}") for c in v.columns])
    overlap = v.join(
        later,
        (F.col("prd_key") == F.col("later_prd_key"))
        & (F.col("cat_id") == F.col("later_cat_id"))
        & (F.col("prd_start_dt") < F.col("later_prd_start_dt"))
        & (F.coalesce("prd_end_dt", F.lit(D(9999, 12, 31))) >= F.col("later_prd_start_dt")),
    )
    assert overlap.isEmpty()


def test_product_dimension(products, categories):
    rows = gold.dim_products(silver.products(products), silver.categories(categories)).orderBy("product_key").collect()
    assert [(r.product_key, r.product_id, r.product_number, r.category, r.cost, r.product_line) for r in rows] == [
        (1, 21, "OAK-7", "Components", 0, "Road"),
        (2, 36, "DOME-2", "Accessories", 23, "Other Sales"),
        (3, 33, "DOME-2B", "Accessories", 23, "Other Sales"),
        (4, 57, "CLIP-4", None, 38, "n/a"),
    ]


def test_product_checks(spark, products, categories):
    assert column(quality.products_without_category(products, categories), "prd_id") == [57]
    assert column(quality.bad_costs(products), "prd_cost") == [None]
    assert sorted(column(quality.reversed_versions(products), "prd_id")) == [31, 32, 34, 35]
    assert quality.bad_product_ids(products).isEmpty()
    holed = categories.unionByName(spark.createDataFrame([(None, "x", "x", "x")], categories.schema))
    assert quality.products_without_category(products, holed).isEmpty()
    assert quality.null_category_ids(holed).count() == 1


def test_untrimmed_category_columns(spark, categories):
    assert quality.untrimmed_rows(categories, "cat", "subcat", "maintenance").isEmpty()
    spaced = spark.createDataFrame([("A", "x", " y", "Yes"), ("B", "x", "y", "No "), ("C", None, "y", "No")], categories.schema)
    assert sorted(column(quality.untrimmed_rows(spaced, "cat", "subcat", "maintenance"), "id")) == ["A", "B"]


def test_facts_without_dimension(spark, products, categories):
    dim = gold.dim_products(silver.products(products), silver.categories(categories))
    people = spark.createDataFrame([(1, 11)], "customer_key int, customer_id int")
    schema = struct(BRONZE["crm_sales_details"])
    raw = spark.createDataFrame(
        [
            ("SO1", "DOME-2", 11, 20130101, 20130102, 20130103, 10, 1, 10),
            ("SO2", "NO-SUCH", 11, 20130101, 20130102, 20130103, 10, 1, 10),
            ("SO3", "DOME-2", 12, 20130101, 20130102, 20130103, 10, 1, 10),
            ("SO4", None, None, 0, None, 5489, None, 2, -10),
        ],
        schema,
    )
    facts = gold.fact_sales(silver.sales(raw), dim, people)
    assert sorted(column(quality.facts_without_product(facts, dim), "order_number")) == ["SO2", "SO4"]
    assert sorted(column(quality.facts_without_customer(facts, people), "order_number")) == ["SO3", "SO4"]
    last = facts.where("order_number = 'SO4'").first()
    assert (last.order_date, last.shipping_date, last.due_date, last.sales_amount, last.price) == (None, None, None, 20, None)


def test_known_counts(lake):
    raw, clean = lake.raw, lake.clean
    sales, people = raw("crm_sales_details"), raw("crm_cust_info")
    expected = {
        "customers": (clean("crm_cust_info"), 1484),
        "products": (clean("crm_prd_info"), 2020),
        "sales": (clean("crm_sales_details"), 60000),
        "demographics": (clean("erp_cust_az12"), 1401),
        "locations": (clean("erp_loc_a101"), 1500),
        "dim_customers": (lake.customers, 1501),
        "dim_products": (lake.products, 687),
        "fact_sales": (lake.facts, 62443),
        "bad_customer_ids": (quality.bad_customer_ids(people), 149),
        "first_names": (quality.untrimmed_values(people, "cst_firstname"), 237),
        "last_names": (quality.untrimmed_values(people, "cst_lastname"), 151),
        "no_category": (quality.products_without_category(raw("crm_prd_info"), raw("erp_px_cat_g1v2").where("id IS NOT NULL")), 288),
        "sold": (quality.products_sold(raw("crm_prd_info"), lake.raw("crm_sales_details")), 2020),
        "costs": (quality.bad_costs(raw("crm_prd_info")), 41),
        "reversed": (quality.reversed_versions(raw("crm_prd_info")), 1347),
        "order_dates": (quality.bad_dates(sales, "sls_order_dt"), 2335),
        "late": (quality.late_orders(sales), 29126),
        "measures": (quality.bad_measures(lake.raw("crm_sales_details")), 24700),
        "births": (quality.odd_birth_dates(raw("erp_cust_az12"), AS_OF), 94),
        "no_customer": (quality.facts_without_customer(lake.facts, lake.customers), 708),
        "no_product": (quality.facts_without_product(lake.facts, lake.products), 646),
        "null_dates": (clean("crm_sales_details").where("sls_order_dt IS NULL"), 3311),
        "null_births": (lake.customers.where("birthdate IS NULL"), 158),
        "uncategorised": (lake.products.where("category IS NULL"), 98),
        "women": (lake.customers.where("gender = 'Female'"), 785),
        "zero_sales": (marts.amount_mismatches(lake.facts).where("sales_amount = 0"), 3194),
        "bad_prices": (marts.amount_mismatches(lake.facts).where("price <= 0"), 3082),
    }
    assert {k: df.count() for k, (df, _) in expected.items()} == {k: n for k, (_, n) in expected.items()}


def test_same_facts_on_the_paths_for_large_tables(spark, small, request):
    usual = bag(Lake(spark, small).facts)
    request.getfixturevalue("hot")
    spark.conf.set("spark.orefold.hotGroupRows", "0")
    assert bag(Lake(spark, small).facts) == usual
