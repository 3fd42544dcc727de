"""Publishing, resumed loads, audits, line numbers, stable keys and mergeable marts."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import bag, column
from orefold import schemas
from orefold.operators.ordering import OCCURRENCE, stable_key
from orefold.operators.skew import measure
from orefold.plans import audit, errors, gold, marts, quality, warehouse as w
from orefold.registry.jobs import RUN_TS, write_feeds
from orefold.registry.lake import AS_OF, Lake
from orefold.sources.flatfiles import numbered_lines, read_feed, rejected_places


@pytest.fixture
def house(spark, tmp_path):
    made = w.Warehouse(spark, str(tmp_path / "warehouse"), f"t{uuid.uuid4().hex}_")
    made.create()
    return made


@pytest.fixture
def silver_house(spark, house, small):
    lake = Lake(spark, small)
    for table in schemas.SILVER:
        house.replace("silver", table, w.with_load_time(lake.clean(table), RUN_TS), "silver")
    return house


def folders(tmp_path, layer, table):
    return {p.name for p in (tmp_path / "warehouse" / layer / table).iterdir() if p.is_dir() and p.name != "run-empty"}


# --- write, audit, publish


def test_a_refused_publish_changes_nothing(silver_house, tmp_path):
    house = silver_house
    w.publish_gold(house, "one")
    facts, customers, products = (bag(t) for t in w.star(house))
    before = {t: folders(tmp_path, "gold", t) for t in w.GOLD_TABLES}
    with pytest.raises(w.PublishRefused, match="repeated_customer_id: [0-9]+ rows"):
        w.publish_gold(house, "two", {"repeated_customer_id": 0})
    assert tuple(bag(t) for t in w.star(house)) == (facts, customers, products)
    assert bag(house.table("gold", "fact_sales")) == facts and bag(house.table("gold", "dim_customers")) == customers
    assert {t: folders(tmp_path, "gold", t) for t in w.GOLD_TABLES} == before
    assert set(column(w.run_log(house, "two"), "status")) == {"refused"}
    stored = house.table("audit", "check_results").where("run_id = 'two'").collect()
    assert [(r.check_name, r.failing_rows > 0) for r in stored] == [("repeated_customer_id", True)]


def test_readers_hold_one_generation(spark, silver_house):
    house = silver_house
    with pytest.raises(LookupError):
        w.star(house)
    w.publish_gold(house, "one")
    held = w.star(house)
    before = [bag(t) for t in held]
    fewer = house.table("silver", "crm_cust_info").where("cst_id % 2 = 0")
    house.replace("silver", "crm_cust_info", spark.createDataFrame(fewer.collect(), fewer.schema), "half")
    w.publish_gold(house, "two", {"repeated_customer_key": 0, "fact_without_customer": 1 << 40})
    assert [bag(t) for t in held] == before  # old keys, old attributes, old fact keys
    new = w.star(house)
    assert new.customers.count() < held.customers.count()
    keys = {r.customer_key for r in new.facts.select("customer_key").distinct().collect()} - {None}
    assert keys <= {r.customer_key for r in new.customers.collect()}
    assert bag(house.table("gold", "dim_customers")) == bag(new.customers)


def test_a_failing_dimension_leaves_the_old_star(silver_house, monkeypatch, tmp_path):
    house = silver_house
    w.publish_gold(house, "one")
    before = [bag(t) for t in w.star(house)]
    monkeypatch.setattr(w.gold, "dim_products", lambda *_: (_ for _ in ()).throw(RuntimeError("broken")))
    with pytest.raises(RuntimeError):
        w.publish_gold(house, "two")
    assert [bag(t) for t in w.star(house)] == before
    log = {r.table_name: r.status for r in w.run_log(house, "two").collect()}
    assert log == {"dim_customers": "failed", "dim_products": "failed"}
    assert not [f for f in folders(tmp_path, "gold", "dim_customers") if f.startswith("run-two")]


def test_expired_generations_leave_the_catalog(spark, silver_house):
    house = silver_house
    for run in ("one", "two", "three"):
        w.publish_gold(house, run)
    for table in w.GOLD_TABLES:
        assert house.expire("gold", table, keep=1) == 1
    names = {t.name for t in spark.catalog.listTables(f"{house.prefix}gold")}
    assert len([n for n in names if n.startswith("dim_customers__")]) == 2
    assert w.star(house).facts.count() == house.table("gold", "fact_sales").count()


# --- keys that last


def test_keys_last_when_rows_are_added(spark, silver_house):
    house = silver_house
    everybody = house.table("silver", "crm_cust_info")
    rows = spark.createDataFrame(everybody.collect(), everybody.schema)
    for run, part in (("one", "cst_id % 3 = 0"), ("two", "cst_id % 3 < 2"), ("three", "cst_id % 3 = 1"), ("four", "true")):
        house.replace("silver", "crm_cust_info", rows.where(part), run)
        w.publish_gold(house, run, stable_keys=True)
        known = {r.customer_key: r.customer_id for r in w.known_keys(house, "dim_customers").collect()}
        now = {r.customer_key: r.customer_id for r in w.star(house).customers.collect()}
        assert sorted(known) == list(range(1, len(known) + 1))
        assert now.items() <= known.items()
        if run != "one":
            assert earlier.items() <= known.items()
        earlier = known
    assert column(w.star(house).customers, "customer_key") and len(now) == len(known)


def test_stable_keys_of_repeated_and_missing_identities(spark):
    rows = [(None, "a"), (None, "b"), (1, "c"), (1, "c"), (2, "d")]
    first = stable_key(spark.createDataFrame(rows, "id int, x string"), ["id"], ["id"], "key", None)
    known = spark.createDataFrame(first.select("id", OCCURRENCE, "key").collect(), f"id int, {OCCURRENCE} int, key int")
    more = spark.createDataFrame([*rows, (1, "z"), (0, "e")], "id int, x string")
    second = {(r.id, r.occurrence): r.key for r in stable_key(more, ["id"], ["id"], "key", known).collect()}
    assert {(r.id, r.occurrence): r.key for r in first.collect()}.items() <= second.items()
    assert sorted(second.values()) == list(range(1, 8)) and second[0, 1] == 6 and second[1, 3] == 7


def test_stable_keys_of_hot_identities(spark, hot):
    frame = spark.range(60).selectExpr("cast(if(id < 40, 7, id) as int) as id", "cast(id as string) as x")
    first = stable_key(frame.where("x < '3'"), ["id"], ["id"], "key", None)
    known = spark.createDataFrame(first.select("id", OCCURRENCE, "key").collect(), f"id int, {OCCURRENCE} int, key int")
    second = stable_key(frame, ["id"], ["id"], "key", known).collect()
    assert sorted(r.key for r in second) == list(range(1, 61))
    assert {(r.id, r.occurrence, r.key) for r in known.collect()} <= {(r.id, r.occurrence, r.key) for r in second}


def test_hot_keys_of_the_stored_view(spark, silver_house, hot):
    """A business key with many rows of its dimension: the view visits their parts, the rows are those of a plain join."""
    house = silver_house
    located = house.table("silver", "erp_loc_a101")
    rows = located.collect()
    rows += [r for r in rows if r.cid.endswith("7")] * 9 + [r for r in rows if r.cid.endswith("3")] * 2
    house.replace("silver", "erp_loc_a101", spark.createDataFrame(rows, located.schema), "many")
    w.publish_gold(house, "one")
    star = w.star(house)
    live = w.live_generation(house)
    parts = house.table("gold", f"dim_customers_hot__{live}").collect()
    assert parts and all(r.parts >= 2 for r in parts) and not spark.catalog.tableExists(f"{house.name('gold', 'dim_products_hot')}__{live}")
    plan = star.facts._jdf.queryExecution().executedPlan().toString()
    assert "customers_visit" in plan
    sales = house.table("silver", "crm_sales_details")
    products, customers = star.products.select("product_number", "product_key"), star.customers.select("customer_id", "customer_key")
    joined = sales.join(products, F.col("sls_prd_key") == F.col("product_number"), "left").join(customers, F.col("sls_cust_id") == F.col("customer_id"), "left")
    assert bag(star.facts) == bag(gold.renamed(joined, gold.SALES_NAMES))
    assert bag(house.table("gold", "fact_sales")) == bag(star.facts)


def test_dimensions_are_measured_while_they_are_stored(spark, small):
    """What a lookup needs to know of its side costs no job once the side has been stored."""
    lake = Lake(spark, small)
    customers, products = lake.dimensions
    sales = lake.clean("crm_sales_details")
    spark.sparkContext.setJobGroup("measuring", "measuring")
    try:
        sizes = [measure(d) for d in (customers, products)]
        gold.fact_sales(sales, products, customers)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("measuring")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    assert [s[0] for s in sizes] == [customers.count(), products.count()]


# --- loads


def test_a_resumed_load_does_only_what_is_left(spark, house, small, tmp_path):
    lake = Lake(spark, small)
    paths = write_feeds(lake, str(tmp_path / "in"))
    broken = tmp_path / "broken.csv"
    broken.write_text("id,cat,subcat,maintenance\nA,b\n")
    with pytest.raises(Exception):
        w.run_steps(house, w.load_steps(house, {**paths, "erp_px_cat_g1v2": str(broken)}, AS_OF, RUN_TS), "run")
    log = {(r.layer, r.table_name): r.status for r in w.run_log(house, "run").collect()}
    assert log.pop(("bronze", "erp_px_cat_g1v2")) == "failed" and log.pop(("silver", "erp_px_cat_g1v2")) == "skipped"
    assert set(log.values()) == {"loaded"} and len(log) == 10
    before = {key: folders(tmp_path, *key) for key in log}
    w.run_steps(house, w.load_steps(house, paths, AS_OF, RUN_TS), "run")
    assert {key: folders(tmp_path, *key) for key in log} == before
    for table in schemas.SILVER:
        assert bag(house.table("silver", table).drop(schemas.AUDIT_COLUMN)) == bag(lake.clean(table))
    done = w.run_log(house, "run").where("status = 'loaded'").groupBy("layer", "table_name").count().collect()
    assert len(done) == 12 and {r["count"] for r in done} == {1}


def test_steps_need_each_other(spark, house):
    rows = spark.createDataFrame([("A", "x")], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    with pytest.raises(ValueError, match="nothing builds"):
        w.run_steps(house, {"a": w.Step("bronze", "erp_loc_a101", lambda: rows, ["b"])}, "r")
    with pytest.raises(ValueError, match="wait for each other"):
        w.run_steps(house, {n: w.Step("bronze", "erp_loc_a101", lambda: rows, [m]) for n, m in (("a", "b"), ("b", "a"))}, "r")


def test_rejects_belong_to_the_load_that_is_live(spark, house, small, tmp_path):
    paths = write_feeds(Lake(spark, small), str(tmp_path / "in"))
    dirty = tmp_path / "az.csv"
    dirty.write_text("cid,bdate,gen\nA,1970-01-01,M\nB,not a date,F\nC\n")
    for _ in range(2):
        w.load_bronze(house, {**paths, "erp_cust_az12": str(dirty)}, "again", max_rejects=10)
    assert sorted(column(house.table("audit", "rejected_lines"), "rejected_line")) == ["B,not a date,F", "C"]
    # a table that is not replaced shows no rejects, and its log still counts them
    dirty.write_text(f"cid,bdate,gen\nA,1970-01-01,{'M' * 60}\nB,not a date,F\n")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        w.load_bronze(house, {**paths, "erp_cust_az12": str(dirty)}, "late", max_rejects=10)
    assert house.table("audit", "rejected_lines").where("run_id = 'late'").isEmpty()
    failed = w.run_log(house, "late").where("status = 'failed'").first()
    assert (failed.table_name, failed.rejected_count, failed.error_category) == ("erp_cust_az12", 1, "value_too_long")


def test_expire_spares_a_load_in_progress(spark, house, tmp_path):
    rows = spark.createDataFrame([("A", "x")], schemas.struct(schemas.BRONZE["erp_loc_a101"]))
    w._run(house, "bronze", {"erp_loc_a101": lambda: rows}, "a")
    going = house.stage("bronze", "erp_loc_a101", rows, "going")
    assert house.expire("bronze", "erp_loc_a101", keep=0) == 0
    assert {f.rpartition("-")[0] for f in folders(tmp_path, "bronze", "erp_loc_a101")} == {"run-a", "run-going"}
    assert house.expire("bronze", "erp_loc_a101", keep=0, dead_after=dt.timedelta(seconds=-5)) == 1
    assert {f.rpartition("-")[0] for f in folders(tmp_path, "bronze", "erp_loc_a101")} == {"run-a"}
    assert house.spark.catalog.tableExists(going.name)  # the folder is gone, the name is the writer's to drop


def test_errors_have_a_category(spark):
    class Chained(RuntimeError):
        pass

    error = Chained("[TASK_WRITE_FAILED] x Caused by: [FAILED_READ_FILE.NO_HINT] y Caused by: [MALFORMED_RECORD_IN_PARSING.WITHOUT_SUGGESTION] z")
    assert errors.conditions(error)[-1].startswith("MALFORMED") and errors.category(error) == "malformed_line"
    assert errors.category(ValueError("plain")) == "unknown"
    with pytest.raises(Exception) as caught:
        spark.sql("SELECT 1/0 FROM nowhere_at_all")
    assert errors.described(caught.value)[0::3] == ("TABLE_OR_VIEW_NOT_FOUND", "missing_input")


# --- whole lines


def test_any_read_notices_a_malformed_line(spark, tmp_path):
    path = tmp_path / "az.csv"
    columns = schemas.BRONZE["erp_cust_az12"]
    for bad in ("B,not a date,F", "D,1971-01-01", "E,1971-01-01,F,more"):
        path.write_text(f"cid,bdate,gen\nA,1970-01-01,M\n{bad}\n")
        for read in (lambda df: df.count(), lambda df: df.select("gen").collect(), lambda df: df.select("cid").distinct().collect()):
            with pytest.raises(Exception, match="MALFORMED_RECORD") as caught:
                read(read_feed(spark, str(path), columns))
            assert bad in str(caught.value)
            assert errors.category(caught.value) == "malformed_line"


def test_line_numbers_of_a_file_in_pieces(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    wanted = set()
    for name, n, end in (("a.csv", 400, "\n"), ("b.csv", 150, "\r\n"), ("c.csv", 0, "\n")):
        lines = ["cid,bdate,gen"] + [f"K{i},{'no date' if i % 37 == 5 else '1970-01-01'},M" for i in range(n)]
        (folder / name).write_text(end.join(lines) + end, newline="")
        wanted |= {(name, k, x) for k, x in enumerate(lines, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        numbered = numbered_lines(spark, str(folder)).withColumn("name", F.element_at(F.split("file", "/"), -1))
        assert {(r.name, r.line_number, r.line) for r in numbered.collect()} == wanted
        assert numbered_lines(spark, str(folder)).select("file").distinct().count() == 3
        found = rejected_places(spark, str(folder), schemas.BRONZE["erp_cust_az12"])
        places = {(r.file.rpartition("/")[2], r.line_number, r.rejected_line) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert places == {x for x in wanted if "no date" in x[2]}


# --- audits


def scans(df, path):
    return len(re.findall(rf"FileScan [^\n]*{path}", df._jdf.queryExecution().executedPlan().toString()))


def test_an_audit_reads_each_table_once(spark, silver_house, monkeypatch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plans = []
    real = audit.stash
    monkeypatch.setattr(audit, "stash", lambda df, label: plans.append(df) or real(df, label))
    run = audit.Audit(audit.clean_checks(AS_OF), lambda t: silver_house.table("silver", t))
    for table, plan in zip(audit.clean_checks(AS_OF), plans):
        assert scans(plan, f"silver/{table}") == 1
        assert sum(scans(plan, f"silver/{t}") for t in schemas.SILVER) == 1
    assert not sum(scans(run.results(), f"silver/{t}") for t in schemas.SILVER)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_offending_rows_are_those_of_the_counts(spark, house, small):
    lake = Lake(spark, small)
    for table in schemas.BRONZE:
        house.replace("bronze", table, lake.raw(table), "raw")
    results = {(r.table_name, r.check_name): r.failing_rows for r in w.check_layer(house, "bronze", AS_OF, "checks", keep_rows=True).collect()}
    for table, own in audit.raw_checks(AS_OF).items():
        rows = house.table("audit", f"bronze_{table}_rows")
        names = rows.select(F.explode(F.split(audit.FAILED, ",")).alias("n")).groupBy("n").count().collect()
        found = {r.n: r["count"] for r in names}
        for check in [*own.rows, *own.refers]:
            assert found.get(check, 0) == results[table, check], (table, check)
        assert rows.drop(audit.FAILED).exceptAll(house.table("bronze", table)).isEmpty()
    assert results["crm_cust_info", "missing_or_repeated_id"] == quality.bad_customer_ids(house.table("bronze", "crm_cust_info")).count()
    assert results["crm_cust_info", "superseded_rows"] == quality.superseded_customers(house.table("bronze", "crm_cust_info")).count()


def test_audit_of_empty_tables(house):
    results = w.check_layer(house, "silver", AS_OF, "checks", keep_rows=True).collect()
    assert results and {(r.checked_rows, r.failing_rows) for r in results} == {(0, 0)}


# --- fact and marts


def test_both_keys_in_one_shuffle_of_the_facts(spark, small, hot):
    lake = Lake(spark, small)
    sales = spark.createDataFrame(lake.clean("crm_sales_details").collect(), lake.clean("crm_sales_details").schema)
    products, customers = lake.products, lake.customers
    got = gold.fact_sales(sales, products, customers)
    plan = gold.with_both_keys(sales, products, customers)._jdf.queryExecution().executedPlan().toString()
    whole = [x for x in re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*\n?[^\n]*", plan) if "sls_ord_num" in x]
    assert len(whole) <= 1
    spark.conf.set("spark.orefold.broadcastBytes", str(1 << 30))
    assert measure(products)[1] < 1 << 30
    assert bag(got) == bag(gold.fact_sales(sales, products, customers))


def test_flat_lines_are_the_flat_facts(spark, small):
    lake = Lake(spark, small)
    flat = marts.flat_lines(lake.clean("crm_sales_details"), lake.customers, lake.products)
    assert flat.columns == marts.flat_sales(lake.facts, lake.customers, lake.products).columns == list(schemas.MARTS["flat_sales"])
    assert bag(flat) == bag(marts.flat_sales(lake.facts, lake.customers, lake.products))
    lost = quality.lines_without_customer(lake.clean("crm_sales_details"), lake.customers, lake.products)
    assert bag(lost) == bag(quality.facts_without_customer(lake.facts, lake.customers))


def test_parts_of_a_mart_are_rebuilt_alone(spark, small):
    lake = Lake(spark, small)
    facts, groups = lake.fact_columns("order_number", "product_key", "quantity", "sales_amount"), ("category", "product_line")
    parts = marts.partial_sales(facts, lake.products, "product_key", groups, parts=8)
    assert bag(marts.merged_sales(parts, groups)) == bag(marts.sales_by_product_group(facts, lake.products).select(*groups, "lines", "orders", "quantity", "sales_amount"))
    # orders of one part change: the other parts stay as they were
    of_part = F.pmod(F.xxhash64("order_number"), F.lit(8)) == 3
    changed = facts.withColumn("quantity", F.when(of_part, F.col("quantity") + 1).otherwise(F.col("quantity")))
    again = marts.partial_sales(changed.where(of_part), lake.products, "product_key", groups, parts=8)
    mixed = parts.where("part <> 3").unionByName(again)
    assert column(again.select("part").distinct(), "part") == [3]
    want = marts.sales_by_product_group(changed, lake.products).select(*groups, "lines", "orders", "quantity", "sales_amount")
    assert bag(marts.merged_sales(mixed, groups)) == bag(want)


def test_sales_feed_joins_what_it_reads(spark, small):
    """Texts are made of the columns after lines and orders have met, so the shuffle carries none."""
    plan = Lake(spark, small).raw("crm_sales_details")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("SO") < plan.index("Join Inner")
    assert "concat" not in plan[plan.index("Join Inner") :]


def test_flat_sales_look_up_first_what_shuffles_the_lines(spark):
    """Long rows of a broadcast side are added after the shuffle; of two shuffled sides the one with shorter rows comes first."""
    product = {"product_key": 1, "product_number": "P1", **{c: None for c in marts.PRODUCT_COLUMNS if c != "product_number"}}
    customer = {"customer_key": 1, "customer_id": 1, **{c: None for c in marts.CUSTOMER_COLUMNS if c != "customer_id"}}
    types = {**schemas.GOLD["dim_products"], **schemas.GOLD["dim_customers"]}

    def table(rows, key):
        names = [key, *(marts.PRODUCT_COLUMNS if key == "product_key" else marts.CUSTOMER_COLUMNS)]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.struct({n: types[n] for n in names}))

    short = [{**product, "product_key": i, "product_number": f"P{i}"} for i in range(3)]
    long = [{**customer, "customer_key": i, "customer_id": i // 2, "first_name": "n" * 400} for i in range(40)]
    customers, products = table(long, "customer_key"), table(short, "product_key")
    silver = {**schemas.BRONZE["crm_sales_details"], **{d: "date" for d in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}}
    lines = [(f"SO{i}", f"P{i % 5}" if i % 6 else None, i if i % 7 else None, None, None, None, i, 1, i) for i in range(30)]
    sales = spark.createDataFrame(lines, schemas.struct(silver))
    facts = gold.fact_sales(sales, products, customers)

    def order(flat, *keys):
        """The keys as they stand in the plan, the last join first."""
        joins = [x for x in flat._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
        return [next(k for k in keys if k in x) for x in joins[:2]]

    results = []
    # neither side fits, only the products fit, only the customers fit (after their names are cut), both fit
    cut = customers.withColumn("first_name", F.lit(None).cast("string")).limit(1)
    for limit, side, last_first in ((0, customers, ["customer", "product"]), (2000, customers, ["product", "customer"]), (60, cut, ["customer", "product"]), (1 << 20, customers, None)):
        spark.conf.set("spark.orefold.broadcastBytes", str(limit))
        try:
            flats = marts.flat_lines(sales, side, products), marts.flat_sales(gold.fact_sales(sales, products, side), side, products)
            if last_first:
                assert order(flats[0], "product", "customer") == last_first, limit
                assert order(flats[1], "product", "customer") == last_first, limit
            assert bag(flats[0]) == bag(flats[1])
            results += [bag(flats[0])] if side is customers else []
        finally:
            spark.conf.unset("spark.orefold.broadcastBytes")
    assert results[0] == results[1] == results[2] and facts.count() == sum(results[0].values())
