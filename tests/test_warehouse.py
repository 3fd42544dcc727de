"""Extract files, stored layers, load jobs and the run log."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import bag, column
from orefold import schemas
from orefold.plans import quality, warehouse as w
from orefold.registry.jobs import RUN_TS, write_feeds
from orefold.registry.lake import AS_OF, Lake
from orefold.session import stash
from orefold.sources.flatfiles import TooManyRejects, feed_path, read_feed, read_feed_tolerant


@pytest.fixture
def house(spark, tmp_path):
    made = w.Warehouse(spark, str(tmp_path / "warehouse"), f"t{uuid.uuid4().hex}_")
    made.create()
    return made


def test_feed_paths():
    assert feed_path("/in/", "crm_cust_info") == "/in/source_crm/cust_info.csv"
    assert feed_path("/in", "erp_loc_a101") == "/in/source_erp/LOC_A101.csv"


def test_csv_details(spark, tmp_path):
    """Header skipped whatever it says, CRLF, blanks kept, no newline at the end."""
    path = tmp_path / "prd.csv"
    path.write_bytes(b"a,b,c,d,e,f,g\r\n1,K-1, N ,,R ,2003-07-01,\r\n2,K-2,,7,,2011-07-01,2007-12-28")
    rows = read_feed(spark, str(path), schemas.BRONZE["crm_prd_info"]).orderBy("prd_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "K-1", " N ", None, "R ", dt.datetime(2003, 7, 1), None),
        (2, "K-2", None, 7, None, dt.datetime(2011, 7, 1), dt.datetime(2007, 12, 28)),
    ]


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "az.csv"
    path.write_text("cid,bdate,gen\nA,1970-01-01,M\nB,not a date,F\nC,1971-01-01,F\n")
    columns = schemas.BRONZE["erp_cust_az12"]
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_feed(spark, str(path), columns).collect()
    good, rejected = read_feed_tolerant(spark, str(path), columns, max_rejects=1)
    assert sorted(column(good, "cid")) == ["A", "C"]
    assert column(rejected, "rejected_line") == ["B,not a date,F"]
    with pytest.raises(TooManyRejects):
        read_feed_tolerant(spark, str(path), columns, max_rejects=0)


def test_full_load(spark, house, small, tmp_path):
    lake = Lake(spark, small)
    paths = write_feeds(lake, str(tmp_path / "in"))
    for table, columns in schemas.BRONZE.items():
        assert house.table("bronze", table).columns == list(columns)
        assert house.table("bronze", table).isEmpty()

    for run in ("one", "two"):  # the second run replaces, not appends
        bronze = w.load_bronze(house, paths, f"{run}_b")
        log = w.load_silver(house, AS_OF, RUN_TS, f"{run}_s")
        w.publish_gold(house, f"{run}_g")
    assert column(bronze.orderBy("started_at"), "table_name") == list(w.BRONZE_ORDER)
    assert column(log.orderBy("started_at"), "table_name") == list(w.SILVER_ORDER)
    assert set(column(log, "status")) == {"loaded"}

    for table in schemas.SILVER:
        stored = house.table("silver", table)
        assert set(column(stored, schemas.AUDIT_COLUMN)) == {RUN_TS}
        assert bag(stored.drop(schemas.AUDIT_COLUMN)) == bag(lake.clean(table))
        assert log.where(f"table_name = '{table}'").first().row_count == stored.count()
    assert bag(house.table("gold", "dim_customers")) == bag(lake.customers)
    assert bag(house.table("gold", "dim_products")) == bag(lake.products)
    facts = house.table("gold", "fact_sales")
    assert bag(facts) == bag(lake.facts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = house.table("gold", "fact_sales")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2

    gate = quality.gate(facts, house.table("gold", "dim_customers"), house.table("gold", "dim_products"))
    failing = {r.check_name: r.failing_rows for r in gate.collect()}
    assert failing["repeated_product_key"] == failing["repeated_customer_key"] == 0
    assert failing["fact_without_product"] == facts.where("product_key IS NULL").count() > 0
    assert failing["fact_without_customer"] == facts.where("customer_key IS NULL").count() > 0

    times = {(r.run_id, r.layer): r for r in w.batch_times(w.run_log(house)).collect()}
    assert times["two_s", "silver"].tables == 6
    assert times["two_s", "silver"].seconds >= 0
    assert len(times) == 6


def test_failed_load_keeps_the_old_rows(spark, house, small, tmp_path):
    lake = Lake(spark, small)
    paths = write_feeds(lake, str(tmp_path / "in"))
    w.load_bronze(house, paths, "good")
    before = house.table("bronze", "crm_prd_info").count()
    broken = tmp_path / "broken.csv"
    broken.write_text("prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\nx,y,z,1,M,2011-07-01,\n")
    with pytest.raises(Exception):
        w.load_bronze(house, {**paths, "crm_prd_info": str(broken)}, "bad")
    assert house.table("bronze", "crm_prd_info").count() == before
    log = {r.table_name: r for r in w.run_log(house, "bad").orderBy("started_at").collect()}
    assert list(log) == ["crm_cust_info", "crm_prd_info"]
    assert log["crm_cust_info"].status == "loaded"
    failed = log["crm_prd_info"]
    assert (failed.status, failed.row_count) == ("failed", None)
    assert failed.error_class and failed.error_message
    # the failed attempt left no files, so the good run is the one that stays
    folder = tmp_path / "warehouse" / "bronze" / "crm_prd_info"
    assert [p.name for p in folder.iterdir() if p.name.startswith("run-bad")] == []


def test_text_longer_than_declared_is_refused(spark, house):
    rows = spark.createDataFrame([("A", "x" * 51)], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        house.replace("bronze", "erp_loc_a101", rows, "long")
    assert house.table("bronze", "erp_loc_a101").isEmpty()


def test_tolerant_load(spark, house, small, tmp_path):
    paths = write_feeds(Lake(spark, small), str(tmp_path / "in"))
    dirty = tmp_path / "az.csv"
    dirty.write_text("cid,bdate,gen\nA,1970-01-01,M\nB,not a date,F\n")
    w.load_bronze(house, {**paths, "erp_cust_az12": str(dirty)}, "tolerant", max_rejects=10)
    assert column(house.table("bronze", "erp_cust_az12"), "cid") == ["A"]
    assert [tuple(r) for r in house.table("audit", "rejected_lines").collect()] == [("tolerant", "erp_cust_az12", "B,not a date,F")]
    counts = {r.table_name: r.rejected_count for r in w.run_log(house, "tolerant").collect()}
    assert counts == {t: int(t == "erp_cust_az12") for t in schemas.BRONZE}


def test_older_runs_expire(spark, house, tmp_path):
    rows = spark.createDataFrame([("A", "x")], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    bad = rows.withColumn("cntry", F.raise_error(F.lit("broken")).cast("string"))
    folder = tmp_path / "warehouse" / "bronze" / "erp_loc_a101"

    def left():
        return sorted(p.name.rpartition("-")[0] for p in folder.iterdir() if p.is_dir() and p.name != "run-empty")

    for run, frame in (("a", rows), ("b", rows), ("c", rows), ("bad", bad)):
        try:
            w._run(house, "bronze", {"erp_loc_a101": lambda frame=frame: frame}, run)
        except Exception:
            assert run == "bad"
    assert left() == ["run-a", "run-b", "run-c"]
    house.expire("bronze", "erp_loc_a101", keep=1)
    assert left() == ["run-b", "run-c"]
    assert bag(house.table("bronze", "erp_loc_a101")) == {("A", "x"): 1}


def test_a_run_id_used_twice_replaces(spark, house):
    rows = spark.createDataFrame([("A", "x"), ("B", "y")], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    for _ in range(2):
        assert house.replace("bronze", "erp_loc_a101", rows, "same") == 2
        assert house.table("bronze", "erp_loc_a101").count() == 2


def test_each_table_is_logged_when_done(spark, house):
    rows = spark.createDataFrame([("A", "x")], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    seen = []

    def second():
        seen.extend(column(w.run_log(house, "r"), "table_name"))
        return rows

    steps = {"erp_loc_a101": lambda: rows, "erp_px_cat_g1v2": lambda: second().selectExpr("cid AS id", "cntry AS cat", "cntry AS subcat", "cntry AS maintenance")}
    w._run(house, "bronze", steps, "r")
    assert seen == ["erp_loc_a101"]


def test_scratch_belongs_to_the_application(spark):
    stored = stash(spark.range(3), "probe")
    assert spark.sparkContext.applicationId in stored.inputFiles()[0]
    assert stored.count() == 3
