"""The load jobs, run on the derived feeds in a warehouse of their own.

Every run takes a new folder below the shared scratch folder and a namespace
prefix of its own, so nothing that exists is touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.plans import silver
from orefold.plans import warehouse as w
from orefold.registry import checks, tables
from orefold.registry.lake import AS_OF, Lake
from orefold.session import remove, scratch_path
from orefold.sources.flatfiles import feed_paths, read_feed, write_feed

RUN_TS = dt.datetime.combine(AS_OF, dt.time())


def write_feeds(lake: Lake, folder: str) -> dict[str, str]:
    paths = feed_paths(folder)
    for table, path in paths.items():
        write_feed(lake.raw(table), path, "gzip")
    return paths


def _loaded(lake: Lake, last_layer: str) -> tuple[w.Warehouse, DataFrame]:
    """A fresh warehouse loaded up to a layer, and the log of that layer; the extracts go once they are loaded."""
    run_id, feeds = w.new_run_id(), scratch_path(lake.spark, "feeds")
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{run_id}_")
    house.create()
    log = w.load_bronze(house, write_feeds(lake, feeds), run_id)
    remove(lake.spark, feeds)
    if last_layer != "bronze":
        log = w.load_silver(house, AS_OF, RUN_TS, run_id)
    if last_layer == "gold":
        log = w.publish_gold(house, run_id)
    return house, log


def _mart(lake: Lake, table: str) -> DataFrame:
    house, _ = _loaded(lake, "gold")
    w.publish_marts(house, AS_OF, w.new_run_id(), _PARTS.get(table, ()) + (table,))
    return house.table("mart", table)


def _check_results(lake: Lake) -> DataFrame:
    house, _ = _loaded(lake, "gold")
    return w.check_gold(house, w.new_run_id()).select("check_name", "failing_rows")


def _log(lake: Lake, layer: str) -> DataFrame:
    return _loaded(lake, layer)[1].where(f"layer = '{layer}'").select("layer", "table_name", "status", "row_count")


def _stored(lake: Lake, layer: str, table: str) -> DataFrame:
    """One stored table; below the star schema only its own feed is loaded for it."""
    if layer == "gold":
        return _loaded(lake, layer)[0].table(layer, table)
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{w.new_run_id()}_")
    house.create()
    path = scratch_path(lake.spark, "feed")
    write_feed(lake.raw(table), path, "gzip")
    house.replace("bronze", table, read_feed(lake.spark, path, schemas.BRONZE[table]), "run")
    remove(lake.spark, path)
    if layer == "silver":
        cleaned = silver.clean(table, house.table("bronze", table), AS_OF)
        house.replace("silver", table, w.with_load_time(cleaned, RUN_TS), "run")
    return house.table(layer, table).drop(schemas.AUDIT_COLUMN)


def _reloaded(lake: Lake) -> DataFrame:
    """The raw sales after loading them twice under one run id."""
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{w.new_run_id()}_")
    house.create()
    for _ in range(2):
        house.replace("bronze", "crm_sales_details", lake.raw("crm_sales_details"), "same-run")
    return house.table("bronze", "crm_sales_details")


# Customers whose line is made unreadable in the tests of tolerant and failed loads.
_BROKEN = "c_custkey % 17 = 0"


def _broken_extract(lake: Lake) -> str:
    """An extract of customer locations in which some keys are followed by a date that is none."""
    path = scratch_path(lake.spark, "broken")
    lines = lake.feeds.source("customer").selectExpr(
        "concat('K', c_custkey) AS cid", f"if({_BROKEN}, 'no date', '1970-01-01') AS bdate", "c_mktsegment AS gen"
    )
    write_feed(lines, path)
    return path


def _rejected(lake: Lake) -> DataFrame:
    """The stored rejected lines of a tolerant load, and the count in its log."""
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{w.new_run_id()}_")
    house.create()
    paths = {**write_feeds(lake, scratch_path(lake.spark, "feeds")), "erp_cust_az12": _broken_extract(lake)}
    w.load_bronze(house, paths, "tolerant", max_rejects=1 << 40)
    logged = w.run_log(house, "tolerant").select("table_name", "rejected_count")
    lines = house.table("audit", "rejected_lines").select("table_name", "rejected_line")
    return lines.join(logged, "table_name")


def _failed(lake: Lake) -> DataFrame:
    """The log of a load that fails on purpose, and the rows the table keeps."""
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{w.new_run_id()}_")
    house.create()
    house.replace("bronze", "erp_cust_az12", lake.raw("erp_cust_az12"), "good")
    paths = {**write_feeds(lake, scratch_path(lake.spark, "feeds")), "erp_cust_az12": _broken_extract(lake)}
    try:
        w.load_bronze(house, paths, "bad")
    except Exception:
        pass  # the load has to fail; what it leaves behind is the result
    kept = house.table("bronze", "erp_cust_az12").agg(F.count("*").alias("kept_rows"))
    log = w.run_log(house, "bad").select("table_name", "status", F.col("error_class").isNotNull().alias("has_error"))
    return log.join(F.broadcast(kept))


def _csv_sales(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "csv")
    write_feed(lake.raw("crm_sales_details"), path)
    return read_feed(lake.spark, path, schemas.BRONZE["crm_sales_details"])


def _batches(lake: Lake) -> DataFrame:
    house, _ = _loaded(lake, "silver")
    return w.batch_times(w.run_log(house)).select("layer", "tables", "row_count")


def _counts(layer: str, names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'loaded' AS status, count(*) AS row_count FROM {name}"
        for table, name in names.items()
    )


_RAW = {
    "crm_cust_info": "raw_cust",
    "crm_prd_info": "raw_prd",
    "crm_sales_details": "raw_sales",
    "erp_loc_a101": "raw_loc",
    "erp_cust_az12": "raw_az12",
    "erp_px_cat_g1v2": "raw_cat",
}
_CLEAN = {
    "crm_cust_info": "cln_cust",
    "crm_prd_info": "cln_prd",
    "crm_sales_details": "cln_sales",
    "erp_cust_az12": "cln_az12",
    "erp_loc_a101": "cln_loc",
    "erp_px_cat_g1v2": "raw_cat",
}

# An empty field of an extract is read as NULL.
_AS_READ = {
    "crm_cust_info": "REPLACE (nullif(cst_gndr, '') AS cst_gndr)",
    "erp_loc_a101": "REPLACE (nullif(cntry, '') AS cntry)",
    "erp_cust_az12": "REPLACE (nullif(gen, '') AS gen)",
}

# What a mart is merged from.
_PARTS = {"sales_by_product_group": ("sales_by_product_group_parts",)}
_MARTS = (
    (1, "flat_sales", "m01_flat_sales"),
    (2, "sales_by_product_group", "m02_sales_by_product_group"),
    (2, "sales_by_customer_group", "m02_sales_by_customer_group"),
    (3, "customer_profile", "m03_customer_profile"),
)

QUERIES = {
    "p03_csv_scan": (_csv_sales, "SELECT * FROM raw_sales"),
    "p03_rejected_lines": (
        _rejected,
        f"""SELECT 'erp_cust_az12' AS table_name, 'K' || c_custkey || ',no date,' || c_mktsegment AS rejected_line,
                   count(*) OVER () AS rejected_count FROM customer WHERE {_BROKEN}""",
    ),
    "p04_reload": (_reloaded, "SELECT * FROM raw_sales"),
    **{
        f"p04_stored_{table}": (lambda lake, t=table: _stored(lake, "bronze", t), f"SELECT * {_AS_READ.get(table, '')} FROM {name}")
        for table, name in _RAW.items()
    },
    **{
        f"p05_stored_{table}": (lambda lake, t=table: _stored(lake, "silver", t), f"SELECT * FROM {name}")
        for table, name in _CLEAN.items()
    },
    **{f"m0{n}_stored_{table}": (lambda lake, t=table: _mart(lake, t), tables.QUERIES[name][1]) for n, table, name in _MARTS},
    "p15_check_summary": (_check_results, checks.QUERIES["gate_star_schema"][1]),
    "p13_failed_load": (
        _failed,
        """SELECT table_name, status, status = 'failed' AS has_error, (SELECT count(*) FROM raw_az12) AS kept_rows
           FROM (VALUES ('crm_cust_info', 'loaded'), ('crm_prd_info', 'loaded'), ('crm_sales_details', 'loaded'),
                        ('erp_loc_a101', 'loaded'), ('erp_cust_az12', 'failed')) AS v(table_name, status)""",
    ),
    "p06_load_time": (
        lambda lake: w.with_load_time(lake.clean("erp_loc_a101"), RUN_TS),
        f"SELECT *, TIMESTAMP '{RUN_TS}' AS dwh_create_date FROM cln_loc",
    ),
    "p07_fact_view": (lambda lake: _stored(lake, "gold", "fact_sales"), "SELECT * FROM fact"),
    "p09_bronze_load": (lambda lake: _log(lake, "bronze"), _counts("bronze", _RAW)),
    "p10_silver_load": (lambda lake: _log(lake, "silver"), _counts("silver", _CLEAN)),
    "p12_batches": (
        _batches,
        f"""SELECT layer, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM ({_counts('bronze', _RAW)} UNION ALL {_counts('silver', _CLEAN)}) GROUP BY layer""",
    ),
}
