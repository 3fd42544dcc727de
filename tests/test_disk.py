"""What jobs leave on disk while they run: shuffle files, extracts, and the shuffles of a wide table."""

import os
import time
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import bag
from orefold import schemas, session
from orefold.plans import marts, warehouse as w
from orefold.registry import jobs
from orefold.sources.flatfiles import write_feed


@pytest.fixture
def house(spark, tmp_path):
    made = w.Warehouse(spark, str(tmp_path / "warehouse"), f"t{uuid.uuid4().hex}_")
    made.create()
    return made


def typed(df, columns):
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t.dataType).alias(c) for c, t in ((t.name, t) for t in schemas.struct(columns))])


@pytest.fixture
def star(spark):
    """Sales lines, some without a key or with one that no dimension has, and dimensions with repeated keys."""
    lines = spark.range(300).selectExpr(
        "concat('SO', id div 3) AS sls_ord_num", "if(id % 11 = 0, null, concat('P', id % 23)) AS sls_prd_key", "if(id % 13 = 0, null, id % 29) AS sls_cust_id", "id AS sls_sales"
    )
    customers = spark.range(30).selectExpr("id AS customer_key", "if(id = 29, 3, id % 28) AS customer_id", "concat('AW', id) AS customer_number")
    products = spark.range(23).selectExpr("id AS product_key", "concat('P', if(id = 20, 7, id)) AS product_number", "'Wheel' AS category")
    sales = typed(lines.unionByName(lines.where("sls_sales % 7 = 0")), schemas.SILVER["crm_sales_details"])
    return sales, typed(customers, schemas.GOLD["dim_customers"]), typed(products, schemas.GOLD["dim_products"])


def test_flat_sales_are_stored_in_parts(spark, house, star, hot):
    """Where lines are shuffled, a write takes some of them; together they are all lines, also those without a key."""
    spark.conf.set("spark.orefold.linesAtOnce", "100")
    try:
        parts = marts.flat_parts(*star)
    finally:
        spark.conf.unset("spark.orefold.linesAtOnce")
    whole = marts.flat_lines(*star)
    assert len(parts) == 4 and sum(p.count() > 0 for p in parts) > 1
    assert house.replace("mart", "flat_sales", parts, "run") == whole.count()
    assert bag(house.table("mart", "flat_sales")) == bag(whole)
    assert not whole.where("product_number is null").isEmpty()


def test_lines_that_stay_in_place_are_one_part(spark, star):
    spark.conf.set("spark.orefold.linesAtOnce", "1")
    try:
        assert len(marts.flat_parts(*star)) == 1
        assert len(marts.flat_parts(star[0].limit(0), *star[1:])) == 1
    finally:
        spark.conf.unset("spark.orefold.linesAtOnce")


def test_a_failed_part_leaves_the_old_rows(spark, house, star, tmp_path):
    good = marts.flat_lines(*star)
    house.replace("mart", "flat_sales", good, "good")
    kept = {p.name for p in (tmp_path / "warehouse/mart/flat_sales").iterdir()}
    bad = good.withColumn("order_number", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        house.replace("mart", "flat_sales", [good, bad], "bad")
    assert house.table("mart", "flat_sales").count() == good.count()
    assert {p.name for p in (tmp_path / "warehouse/mart/flat_sales").iterdir()} == kept


def test_a_write_leaves_no_shuffle_files(spark, house, tmp_path):
    def files():
        listed = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (listed.apply(i).getName() for i in range(listed.size())) if n.startswith("shuffle_")}

    rows = spark.range(1000).selectExpr("cast(id AS string) AS cid", "'x' AS cntry").repartition(5, "cid")
    before, setting = files(), spark.conf.get(session._CLEANUP, "false")
    house.replace("bronze", "erp_loc_a101", rows, "run")
    write_feed(rows, str(tmp_path / "feed"))
    session.stash(rows, "stored")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert spark.conf.get(session._CLEANUP, "false") == setting


def test_extracts_are_compressed_and_go_when_loaded(spark, monkeypatch):
    def raw(table):
        return typed(spark.range(50).selectExpr("id AS cst_id", "id AS prd_id", "id AS sls_cust_id", "cast(id AS string) AS cid", "cast(id AS string) AS id"), schemas.BRONZE[table])

    found, remove = [], session.remove

    def removed(spark, path):
        found.extend(os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.startswith("part-"))
        remove(spark, path)

    monkeypatch.setattr(jobs, "remove", removed)
    house, _ = jobs._loaded(SimpleNamespace(spark=spark, raw=raw), "bronze")
    assert found and all(f.endswith(".csv.gz") for f in found) and not any(os.path.exists(f) for f in found)
    assert {t: house.table("bronze", t).count() for t in schemas.BRONZE} == {t: 50 for t in schemas.BRONZE}
    assert bag(house.table("bronze", "crm_sales_details")) == bag(raw("crm_sales_details"))
