"""The checks of a whole layer in one run, refused publishes, resumed loads, times and errors of the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.plans import gold, marts
from orefold.plans import warehouse as w
from orefold.registry import oracle as o
from orefold.registry import tables
from orefold.registry.jobs import _BROKEN, _CLEAN, _RAW, RUN_TS, _broken_extract, _loaded, write_feeds
from orefold.registry.lake import AS_OF, Lake
from orefold.session import scratch_path, stash
from orefold.sources.flatfiles import rejected_places


def _house(lake: Lake) -> w.Warehouse:
    house = w.Warehouse(lake.spark, scratch_path(lake.spark, "warehouse"), f"run_{w.new_run_id()}_")
    house.create()
    return house


def _checks(lake: Lake, layer: str) -> DataFrame:
    house, _ = _loaded(lake, layer)
    return w.check_layer(house, layer, AS_OF, "checks").select("table_name", "check_name", "checked_rows", "failing_rows")


def _offending(lake: Lake, layer: str, table: str) -> DataFrame:
    house, _ = _loaded(lake, layer)
    w.check_layer(house, layer, AS_OF, "checks", keep_rows=True)
    return house.table("audit", f"{layer}_{table}_rows").drop(schemas.AUDIT_COLUMN)


def _refused(lake: Lake) -> DataFrame:
    """A second publish whose checks fail: its log, and the rows of the star that stays."""
    house, _ = _loaded(lake, "gold")
    before = w.star(house)
    try:
        w.publish_gold(house, "second", {"repeated_customer_id": 0, "fact_without_product": 1 << 40})
    except w.PublishRefused:
        pass  # what the refusal leaves behind is the result
    after = w.star(house)
    rows = after.customers.agg(F.count("*").alias("live_customers")).join(after.products.agg(F.count("*").alias("live_products")))
    same = before.customers.exceptAll(after.customers).agg((F.count("*") == 0).alias("unchanged"))
    log = w.run_log(house, "second").select("table_name", "status", "row_count", "error_class")
    return log.join(F.broadcast(rows)).join(F.broadcast(same))


def _resumed(lake: Lake) -> DataFrame:
    """A load that fails at one extract, and is called again once the extract is whole: attempts and rows by table."""
    house = _house(lake)
    paths = write_feeds(lake, scratch_path(lake.spark, "feeds"))
    try:
        w.run_steps(house, w.load_steps(house, {**paths, "erp_cust_az12": _broken_extract(lake)}, AS_OF, RUN_TS), "resumed")
    except Exception:
        pass  # the load has to fail for the second call to have something left
    log = w.run_steps(house, w.load_steps(house, paths, AS_OF, RUN_TS), "resumed")
    tried = [F.count_if(F.col("status") == s).alias(s) for s in ("loaded", "failed", "skipped")]
    return log.groupBy("layer", "table_name").agg(*tried, F.max("row_count").alias("row_count"))


def _times(lake: Lake) -> DataFrame:
    """Whether the logged times of both loads, by table and by layer, hold together."""
    house, _ = _loaded(lake, "silver")
    log = w.run_log(house)
    whole = F.timestamp_diff("SECOND", "started_at", "ended_at").cast("int")
    ordered = (F.col("ended_at") >= F.col("started_at")) & (F.col("seconds") >= 0) & (F.col("seconds") == whole)
    by_table = log.select("layer", "table_name", ordered.alias("times_hold"))
    inside = log.groupBy("layer").agg(F.sum("seconds").alias("parts"), F.min("started_at").alias("first"), F.max("ended_at").alias("last"))
    batch = w.batch_times(log).join(inside, "layer")
    # tables are loaded one after the other, and each loses less than a second to rounding
    covered = (F.col("seconds") >= F.col("parts")) & (F.col("started_at") == F.col("first")) & (F.col("ended_at") == F.col("last"))
    return by_table.unionByName(batch.select("layer", F.lit("all").alias("table_name"), covered.alias("times_hold")))


def _errors(lake: Lake) -> DataFrame:
    """Class, state and category of three loads that fail for different reasons, and what their messages name."""
    house = _house(lake)
    broken = _broken_extract(lake)
    part = lake.feeds.source("part")
    long = part.select(F.repeat("p_name", F.lit(9)).alias("cid"), F.lit("x").alias("cntry"))
    large = part.select((F.col("p_partkey") + F.lit(1 << 40)).alias("prd_id"), *[F.lit(None).alias(c) for c in list(schemas.BRONZE["crm_prd_info"])[1:]])
    missing = f"{scratch_path(lake.spark, 'nowhere')}.csv"
    loads = {
        "erp_cust_az12": lambda: w.read_feed(lake.spark, broken, schemas.BRONZE["erp_cust_az12"]),
        "erp_loc_a101": lambda: long,
        "crm_prd_info": lambda: large,
        "erp_px_cat_g1v2": lambda: w.read_feed(lake.spark, missing, schemas.BRONZE["erp_px_cat_g1v2"]),
    }
    for table, build in loads.items():
        try:
            w._run(house, "bronze", {table: build}, "errors")
        except Exception:
            pass  # the log of the failure is the result
    log = w.run_log(house, "errors")
    return log.select("table_name", "status", "error_category", "error_class", "error_state", (F.length("error_message") > 0).alias("has_message"))


_SPACED = "starts_with({0}, ' ') OR ends_with({0}, ' ')"
_KEYS = "SELECT {key} AS k FROM {t} GROUP BY k HAVING {required} (k IS NOT NULL AND count(*) > 1)"


def _rows_sql(table: str, name: str, conditions: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, count(*) AS checked_rows, count(*) FILTER (WHERE {condition}) AS failing_rows FROM {name}"
        for check, condition in conditions.items()
    ]


def _keys_sql(table: str, name: str, check: str, key: str, required: bool = True) -> str:
    keys = _KEYS.format(key=key, t=name, required="k IS NULL OR" if required else "")
    return f"SELECT '{table}', '{check}', (SELECT count(*) FROM {name}), (SELECT count(*) FROM ({keys}))"


def _superseded_sql(name: str) -> str:
    return f"SELECT 'crm_cust_info', 'superseded_rows', (SELECT count(*) FROM {name}), (SELECT coalesce(CAST(sum(n - 1) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM {name} GROUP BY cst_id))"


def _strange(column: str, codes: str) -> str:
    return f"coalesce(upper(trim({column})) NOT IN ({codes}), true)"


def _layer_sql(tables: dict[str, str], raw: bool) -> str:
    cust, prd, sales, loc, az12, cat = (tables[t] for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_loc_a101", "erp_cust_az12", "erp_px_cat_g1v2"))

    def unknown(column: str, codes: str) -> str:
        return _strange(column, codes) if raw else f"{column} = 'n/a'"

    category = o.CAT_ID if raw else "cat_id"
    number = o.PRD_NUM if raw else "prd_key"
    dates = (
        {"nonpositive_order_date": "sls_order_dt <= 0", **{f"bad_{d}_date": o.suspect(f"sls_{d}_dt") for d in ("order", "ship", "due")}}
        if raw
        else {f"missing_{d}_date": f"sls_{d}_dt IS NULL" for d in ("order", "ship", "due")}
    )
    repaired = o.DISAGREE.replace("sls_sales", "g").replace("sls_price", "p")
    parts = [
        *_rows_sql("erp_px_cat_g1v2", cat, {"missing_id": "id IS NULL", "untrimmed_text": " OR ".join(_SPACED.format(c) for c in ("cat", "subcat", "maintenance"))}),
        _keys_sql("erp_px_cat_g1v2", cat, "repeated_id", "id", False),
        *_rows_sql("crm_sales_details", sales, {**dates, "late_order": "sls_order_dt > least(sls_ship_dt, sls_due_dt)", "bad_measures": o.DISAGREE}),
        *_rows_sql("crm_cust_info", cust, {
            "untrimmed_first_name": _SPACED.format("cst_firstname"), "untrimmed_last_name": _SPACED.format("cst_lastname"),
            "unknown_gender": unknown("cst_gndr", "'F', 'M'"), "unknown_marital_status": unknown("cst_marital_status", "'S', 'M'"),
        }),
        _keys_sql("crm_cust_info", cust, "missing_or_repeated_id", "cst_id"),
        _superseded_sql(cust),
        *_rows_sql("crm_prd_info", prd, {
            "bad_cost": "coalesce(prd_cost, -1) < 0", "unknown_line": unknown("prd_line", "'M', 'R', 'S', 'T'"), "reversed_version": "prd_end_dt < prd_start_dt",
            "unknown_category": f"{category} NOT IN (SELECT id FROM {cat} WHERE id IS NOT NULL)",
            "never_sold": f"{number} NOT IN (SELECT sls_prd_key FROM {sales} WHERE sls_prd_key IS NOT NULL)",
        }),
        _keys_sql("crm_prd_info", prd, "missing_or_repeated_id", "prd_id") if raw
        else _keys_sql("crm_prd_info", prd, "repeated_current_version", "if(prd_end_dt IS NULL, prd_key, NULL)", False),
        *_rows_sql("erp_cust_az12", az12, {
            "odd_birth_date": f"bdate NOT BETWEEN DATE '1924-01-01' AND {o.LITERAL_AS_OF}", "unknown_gender": unknown("gen", "'F', 'FEMALE', 'M', 'MALE'"),
        }),
        _keys_sql("erp_cust_az12", az12, "missing_or_repeated_id", "cid"),
        *_rows_sql("erp_loc_a101", loc, {"unknown_country": "coalesce(trim(cntry), '') = ''" if raw else "cntry = 'n/a'"}),
        _keys_sql("erp_loc_a101", loc, "missing_or_repeated_id", "cid"),
    ]
    if raw:
        parts += _rows_sql("crm_sales_details", f"(SELECT sls_quantity, {o.GOOD_SALES} AS g, {o.GOOD_PRICE} AS p FROM {sales})", {"measures_beyond_repair": repaired})
    return " UNION ALL ".join(parts)


_FAILS = {
    "untrimmed_first_name": _SPACED.format("cst_firstname"),
    "untrimmed_last_name": _SPACED.format("cst_lastname"),
    "unknown_gender": _strange("cst_gndr", "'F', 'M'"),
    "unknown_marital_status": _strange("cst_marital_status", "'S', 'M'"),
    "missing_or_repeated_id": "cst_id IS NULL OR count(*) OVER (PARTITION BY cst_id) > 1",
}
_DONE = {("bronze", t): n for t, n in _RAW.items()} | {("silver", t): n for t, n in _CLEAN.items()}


def _resumed_sql() -> str:
    rows = []
    for (layer, table), name in _DONE.items():
        broken = table == "erp_cust_az12"
        failed, skipped = int(broken and layer == "bronze"), int(broken and layer == "silver")
        rows.append(f"SELECT '{layer}' AS layer, '{table}' AS table_name, 1::BIGINT AS loaded, {failed}::BIGINT AS failed, {skipped}::BIGINT AS skipped, count(*) AS row_count FROM {name}")
    return " UNION ALL ".join(rows)


def _stable_keys(lake: Lake) -> DataFrame:
    """Customers numbered in two publishes: those created before a day first, later all of them."""
    clean = [lake.clean(t) for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")]
    first = gold.keyed(gold.customer_attributes(clean[0].where(_EARLY), *clean[1:]), "dim_customers")
    known = stash(gold.key_map(first, "dim_customers"), "keys")
    return gold.keyed(gold.customer_attributes(*clean), "dim_customers", known).drop("occurrence")


def _places(lake: Lake) -> DataFrame:
    """File, line number and text of the malformed lines of an extract of several files."""
    path = scratch_path(lake.spark, "numbered")
    key, part = F.col("c_custkey"), (F.col("c_custkey") % 8).alias("part")
    lines = lake.feeds.source("customer").select(
        part, key, F.concat(F.lit("K"), key).alias("cid"), F.expr(f"if({_BROKEN}, 'no date', '1970-01-01')").alias("bdate"), F.col("c_mktsegment").alias("gen")
    )
    # one file per remainder, its lines in the order of the keys
    ordered = lines.repartition("part").sortWithinPartitions("part", "c_custkey").drop("c_custkey")
    ordered.write.option("header", True).partitionBy("part").csv(path)
    found = rejected_places(lake.spark, path, schemas.BRONZE["erp_cust_az12"])
    return found.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part"), "line_number", "rejected_line")


def _merged_mart(lake: Lake) -> DataFrame:
    """The totals by product group, from stored parts."""
    groups = ("category", "product_line")
    facts = lake.fact_columns("order_number", "product_key", "quantity", "sales_amount")
    return marts.merged_sales(stash(marts.partial_sales(facts, lake.products, "product_key", groups), "parts"), groups)


_EARLY = "cst_create_date < DATE '2025-11-25'"
_NUMBERED = "row_number() OVER (PARTITION BY create_date < DATE '2025-11-25' ORDER BY customer_id, customer_number)"

QUERIES = {
    "w03_stable_keys": (
        _stable_keys,
        f"""SELECT CAST({_NUMBERED} + if(create_date < DATE '2025-11-25', 0, (SELECT count(*) FROM dim_cust WHERE create_date < DATE '2025-11-25')) AS INTEGER) AS customer_key,
                   * EXCLUDE (customer_key) FROM dim_cust""",
    ),
    "p03_line_numbers": (
        _places,
        f"""SELECT CAST(c_custkey % 8 AS INTEGER) AS part, line_number, 'K' || c_custkey || ',no date,' || c_mktsegment AS rejected_line
            FROM (SELECT *, 1 + row_number() OVER (PARTITION BY c_custkey % 8 ORDER BY c_custkey) AS line_number FROM customer) WHERE {_BROKEN}""",
    ),
    "m02_from_partials": (_merged_mart, tables.QUERIES["m02_sales_by_product_group"][1]),
    "x23_error_class": (
        _errors,
        """SELECT *, true AS has_message FROM (VALUES
             ('erp_cust_az12', 'failed', 'malformed_line', 'USER_RAISED_EXCEPTION', 'P0001'),
             ('erp_loc_a101', 'failed', 'value_too_long', 'EXCEED_LIMIT_LENGTH', '54006'),
             ('crm_prd_info', 'failed', 'number_too_large', 'CAST_OVERFLOW_IN_TABLE_INSERT', '22003'),
             ('erp_px_cat_g1v2', 'failed', 'missing_input', 'PATH_NOT_FOUND', '42K03')
           ) AS v(table_name, status, error_category, error_class, error_state)""",
    ),
    "p15_raw_checks": (lambda lake: _checks(lake, "bronze"), _layer_sql(_RAW, True)),
    "p15_clean_checks": (lambda lake: _checks(lake, "silver"), _layer_sql(_CLEAN, False)),
    "p15_offending_customers": (
        lambda lake: _offending(lake, "bronze", "crm_cust_info"),
        f"""SELECT * EXCLUDE (cst_gndr), nullif(cst_gndr, '') AS cst_gndr, concat_ws(',', {', '.join(f"if({condition}, '{check}', NULL)" for check, condition in _FAILS.items())}) AS failed_checks
            FROM raw_cust QUALIFY failed_checks <> ''""",
    ),
    "p16_refused_publish": (
        _refused,
        """SELECT table_name, 'refused' AS status, row_count, 'PublishRefused' AS error_class, live_customers, live_products, true AS unchanged
           FROM (SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM dim_cust UNION ALL SELECT 'dim_products', count(*) FROM dim_prd),
                (SELECT count(*) AS live_customers FROM dim_cust), (SELECT count(*) AS live_products FROM dim_prd)""",
    ),
    "p10_resumed_load": (_resumed, _resumed_sql()),
    "p11_times": (
        _times,
        " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{table}' AS table_name, true AS times_hold" for layer, table in [*_DONE, ("bronze", "all"), ("silver", "all")]),
    ),
}
