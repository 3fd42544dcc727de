"""Stored layers: tables, atomic full refresh, load jobs, run log.

Every attempt to load a table writes a folder of its own; only a finished one becomes
the table. The star schema goes live in one step: both dimensions and the fact view are
written aside as a generation, checked, and then named by one row of
``audit.generations``, which is what ``star`` reads.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.operators.skew import aside, hot_keys, measure, short_list
from orefold.plans import audit, errors, gold, marts, quality, silver
from orefold.operators.ordering import OCCURRENCE, number_within
from orefold.session import hadoop_path, limit, shuffles_dropped, stash
from orefold.sources.flatfiles import read_feed, read_feed_tolerant

# Load order of the two jobs.
BRONZE_ORDER = ("crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_loc_a101", "erp_cust_az12", "erp_px_cat_g1v2")
SILVER_ORDER = ("crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")
GOLD_TABLES = ("dim_customers", "dim_products")
# Failing rows that a check of the star schema may have before it is refused.
STAR_LIMITS = {"repeated_customer_key": 0, "repeated_product_key": 0}
# A load that began longer ago than this is taken for dead by ``expire``.
DEAD_AFTER = dt.timedelta(days=2)


class PublishRefused(RuntimeError):
    """A generation that failed its checks; the old one stays live."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Warehouse:
    """Layers under one root folder, registered in the session's catalog.

    ``prefix`` goes in front of the namespaces, so several can share a catalog.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        # appends to one table from several threads would share its temporary folder
        self._appending = threading.Lock()

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create(self) -> None:
        """Namespaces and empty tables; existing ones stay."""
        for layer in (*schemas.LAYERS, "audit"):
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'")
        for layer, tables in schemas.TABLES.items():
            for table, columns in tables.items():
                if (layer, table) != ("gold", "fact_sales"):
                    self._create_table(self.name(layer, table), columns, self._folder(layer, table, "empty"))
        self._create_table(self.name("audit", "run_log"), schemas.RUN_LOG, f"{self.root}/audit/run_log")
        self._create_table(self.name("audit", "check_results"), schemas.CHECK_RESULTS, f"{self.root}/audit/check_results")
        self._create_table(self.name("audit", "generations"), schemas.GENERATIONS, f"{self.root}/audit/generations")
        # partitioned by load, so that a load done again replaces its lines
        rejects = self.name("audit", "rejected_by_load")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {rejects} ({schemas.ddl(schemas.REJECTED_LINES)}) USING parquet"
            f" PARTITIONED BY (run_id, table_name) LOCATION '{self.root}/audit/rejected_by_load'"
        )
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {self.name('audit', 'rejected_lines')} AS SELECT {', '.join(schemas.REJECTED_LINES)} FROM {rejects}")

    def _folder(self, layer: str, table: str, run: str) -> str:
        return f"{self.root}/{layer}/{table}/run-{run}"

    def _create_table(self, name: str, columns: dict[str, str], folder: str) -> None:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.ddl(columns)}) USING parquet OPTIONS (compression 'zstd') LOCATION '{folder}'")

    def replace(self, layer: str, table: str, df: DataFrame | Sequence[DataFrame], run_id: str) -> int:
        """Full refresh; returns the row count, taken while writing.

        The rows go to a folder of their own, new for every attempt, through a table
        of the declared types, which refuses values that do not fit. Only then does
        the real table point to the new folder, so readers see the old or the new
        rows. A failed attempt leaves the old ones and takes its folder away.
        """
        staged = self.stage(layer, table, df, run_id)
        self._drop(staged.name)
        self.go_live(layer, table, staged)
        self._unmark(layer, table, staged.attempt)
        return staged.rows

    def stage(self, layer: str, table: str, df: DataFrame | Sequence[DataFrame], run_id: str, mark: str | None = None) -> Staged:
        """Write ``df`` beside a table, as a table of its own; ``mark`` is part of its name.

        Several are written one after the other, and what one has shuffled goes before the next.
        A file tells as long as the attempt is not finished that its folder is in use.
        """
        mark = mark or uuid.uuid4().hex
        attempt, name = f"{run_id}-{mark}", f"{self.name(layer, table)}__{mark}"
        folder = self._folder(layer, table, attempt)
        columns = schemas.TABLES[layer][table]
        files, marker = hadoop_path(self.spark, self._marker(layer, table, attempt))
        files.create(marker, True).close()
        self._create_table(name, columns, folder)
        staged = Staged(name, folder, attempt, 0)
        try:
            rows = 0
            for part in [df] if isinstance(df, DataFrame) else df:
                seen = Observation()
                counted = part.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
                with shuffles_dropped(self.spark):
                    counted.write.insertInto(name)
                rows += seen.get["rows"]
        except BaseException:
            self.discard(layer, table, staged)
            raise
        return staged._replace(rows=rows)

    def discard(self, layer: str, table: str, staged: Staged) -> None:
        """Take a staged table and its folder away."""
        self._drop(staged.name)
        files, path = hadoop_path(self.spark, staged.folder)
        files.delete(path, True)
        self._unmark(layer, table, staged.attempt)

    def go_live(self, layer: str, table: str, staged: Staged) -> None:
        target = self.name(layer, table)
        self.spark.sql(f"ALTER TABLE {target} SET LOCATION '{staged.folder}'")
        self.spark.catalog.refreshTable(target)

    def _marker(self, layer: str, table: str, attempt: str) -> str:
        return f"{self.root}/{layer}/{table}/loading-{attempt}"

    def _unmark(self, layer: str, table: str, attempt: str) -> None:
        files, path = hadoop_path(self.spark, self._marker(layer, table, attempt))
        files.delete(path, False)

    def _drop(self, name: str) -> None:
        """The files stay: the table is external."""
        self.spark.sql(f"DROP TABLE {name}")

    def expire(self, layer: str, table: str, keep: int = 1, dead_after: dt.timedelta = DEAD_AFTER) -> int:
        """Delete the files of older runs; returns how many folders went.

        The live rows stay, and those of the ``keep`` last other runs that the log
        knows as loaded, for readers that began before the last refresh. The order is
        the log's, since stores need not keep times of folders. What a load is writing
        stays too, unless it began more than ``dead_after`` ago.
        """
        details = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)}").where("col_name = 'Location'")
        files, live = hadoop_path(self.spark, details.first().data_type)
        listed = list(files.listStatus(live.getParent()))
        folders = [s.getPath() for s in listed if s.getPath().getName().startswith("run-")]
        oldest = (dt.datetime.now(dt.timezone.utc) - dead_after).timestamp() * 1000
        markers = {s.getPath().getName().removeprefix("loading-"): s for s in listed if s.getPath().getName().startswith("loading-")}
        loading = {attempt for attempt, s in markers.items() if s.getModificationTime() >= oldest}
        log = self.table("audit", "run_log").where((F.col("layer") == layer) & (F.col("table_name") == table) & (F.col("status") == "loaded"))
        # one row per run of this table that still has a folder, at most as many as there are folders
        runs = {p.getName().removeprefix("run-").rpartition("-")[0] for p in folders} - {""}
        last = log.where(F.col("run_id").isin(*runs)).groupBy("run_id").agg(F.max("ended_at").alias("at")).orderBy(F.desc("at")).collect() if runs else []
        current = live.getName().removeprefix("run-").rpartition("-")[0]
        kept = [r.run_id for r in last if r.run_id != current][:keep]
        spared = {f"run-{attempt}" for attempt in loading} | {live.getName()}
        gone = [p for p in folders if p.getName() not in spared and p.getName().removeprefix("run-").rpartition("-")[0] not in kept]
        for path in gone:
            files.delete(path, True)
            mark = path.getName().rpartition("-")[2]
            if layer == "gold" and mark != "empty":  # a generation that can no longer be read
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}__{mark}")
        for attempt in markers.keys() - loading:
            self._unmark(layer, table, attempt)
        return len(gone)

    def log(self, entries: list[tuple]) -> None:
        """Append one entry per loaded table to the run log."""
        self.append("run_log", self.spark.createDataFrame(entries, schemas.struct(schemas.RUN_LOG)))

    def append(self, table: str, rows: DataFrame) -> None:
        """Add a few rows to a table of the audit layer, all of them in one file."""
        with self._appending:
            rows.coalesce(1).write.insertInto(self.name("audit", table))


class Staged(NamedTuple):
    """A table written aside: its name, folder, attempt and rows."""

    name: str
    folder: str
    attempt: str
    rows: int


def _entry(run_id: str, layer: str, table: str, started: dt.datetime, status: str, rows: int | None = None, rejected: int | None = None, failure: BaseException | None = None) -> tuple:
    """A row of the run log for a load that ends now."""
    ended = _now()
    name, state, message, category = errors.described(failure) if failure else (None, None, None, None)
    return run_id, layer, table, started, ended, int((ended - started).total_seconds()), rows, rejected, status, name, state, message, category


def _run(
    warehouse: Warehouse, layer: str, steps: Mapping[str, Callable[[], DataFrame | Sequence[DataFrame]]], run_id: str,
    rejected: Callable[[str], int] | None = None, afterwards: Callable[[str], None] | None = None,
) -> DataFrame:
    """Refresh tables in order; the first failure is raised. ``afterwards`` is called when a table is live.

    Each table is logged as soon as it is done, so a driver that dies leaves a trace
    of what is already live.
    """
    for table, build in steps.items():
        started = _now()
        rows, failure = None, None
        try:
            rows = warehouse.replace(layer, table, build(), run_id)
            if afterwards:
                afterwards(table)
        except Exception as error:
            failure = error
            raise
        finally:
            status = "failed" if failure else "loaded"
            warehouse.log([_entry(run_id, layer, table, started, status, rows, rejected(table) if rejected else None, failure)])
    return run_log(warehouse, run_id)


@dataclass(frozen=True)
class Step:
    """A table to load, and the steps that must have been loaded before."""

    layer: str
    table: str
    build: Callable[[], DataFrame]
    needs: Sequence[str] = ()


def run_steps(warehouse: Warehouse, steps: Mapping[str, Step], run_id: str, at_once: int = 4) -> DataFrame:
    """Load tables in the order of their needs, independent ones side by side; returns the run's log.

    A failure stops what needs the table, not the rest, and is raised when nothing more
    can run. Called again with the same run id, tables that the log knows as loaded are
    left as they are, so only what failed or was never reached is done.
    """
    unknown = {n for s in steps.values() for n in s.needs} - steps.keys()
    if unknown:
        raise ValueError(f"steps that nothing builds: {sorted(unknown)}")
    logged = run_log(warehouse, run_id).where("status = 'loaded'").select("layer", "table_name").distinct().collect()
    loaded = {(r.layer, r.table_name) for r in logged}
    done = {name for name, s in steps.items() if (s.layer, s.table) in loaded}
    waiting = {name: s for name, s in steps.items() if name not in done}
    running: dict[Future, str] = {}
    failures: list[BaseException] = []
    with ThreadPoolExecutor(at_once) as pool:
        while True:
            for name in [n for n, s in waiting.items() if done.issuperset(s.needs)]:
                step = waiting.pop(name)
                load = inheritable_thread_target(warehouse.spark)(lambda s=step: _run(warehouse, s.layer, {s.table: s.build}, run_id))
                running[pool.submit(load)] = name
            if not running:
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if future.exception() is None:
                    done.add(name)
                else:
                    failures.append(future.exception())
    if waiting:
        warehouse.log([_entry(run_id, s.layer, s.table, _now(), "skipped") for s in waiting.values()])
    if failures:
        raise failures[0]
    if waiting:
        raise ValueError(f"steps that wait for each other: {sorted(waiting)}")
    return run_log(warehouse, run_id)


def load_steps(warehouse: Warehouse, paths: Mapping[str, str], as_of: dt.date, run_ts: dt.datetime) -> dict[str, Step]:
    """Raw and cleaned tables; a cleaned one needs its raw one only."""
    steps = {}
    for table in BRONZE_ORDER:
        steps[f"bronze.{table}"] = Step("bronze", table, lambda t=table: read_feed(warehouse.spark, paths[t], schemas.BRONZE[t]))
        clean = lambda t=table: with_load_time(silver.clean(t, warehouse.table("bronze", t), as_of), run_ts)
        steps[f"silver.{table}"] = Step("silver", table, clean, (f"bronze.{table}",))
    return steps


def new_run_id() -> str:
    return uuid.uuid4().hex


def load_bronze(
    warehouse: Warehouse, paths: Mapping[str, str], run_id: str, max_rejects: int | None = None
) -> DataFrame:
    """Load the six extracts as they are; returns the run's log.

    A malformed line fails the load, unless ``max_rejects`` allows some: those lines
    go to ``audit.rejected_lines`` once the table is live, in place of those of an earlier
    load under the same run id, and the log has their number beside the rows'.
    """
    counts: dict[str, int] = {}
    lines: dict[str, DataFrame] = {}

    def read(table: str) -> DataFrame:
        columns = schemas.BRONZE[table]
        if max_rejects is None:
            return read_feed(warehouse.spark, paths[table], columns)
        good, rejected = read_feed_tolerant(warehouse.spark, paths[table], columns, max_rejects)
        lines[table], counts[table] = rejected, rejected.count()
        return good

    def keep_lines(table: str) -> None:
        if table in lines:
            warehouse.spark.sql(f"ALTER TABLE {warehouse.name('audit', 'rejected_by_load')} DROP IF EXISTS PARTITION (run_id = '{run_id}', table_name = '{table}')")
            folder = f"{warehouse.root}/audit/rejected_by_load/attempt-{uuid.uuid4().hex}"
            lines[table].write.parquet(folder)
            warehouse.spark.sql(
                f"ALTER TABLE {warehouse.name('audit', 'rejected_by_load')} ADD PARTITION (run_id = '{run_id}', table_name = '{table}') LOCATION '{folder}'"
            )

    return _run(warehouse, "bronze", {t: lambda t=t: read(t) for t in BRONZE_ORDER}, run_id, lambda t: counts.get(t, 0), keep_lines)


def with_load_time(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One load time for all rows of a run."""
    return df.withColumn(schemas.AUDIT_COLUMN, F.lit(run_ts).cast("timestamp"))


def load_silver(warehouse: Warehouse, as_of: dt.date, run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Clean the six stored raw tables; returns the run's log."""

    def cleaned(table: str) -> DataFrame:
        return with_load_time(silver.clean(table, warehouse.table("bronze", table), as_of), run_ts)

    return _run(warehouse, "silver", {t: lambda t=t: cleaned(t) for t in SILVER_ORDER}, run_id)


class Star(NamedTuple):
    """The star schema of one generation."""

    facts: DataFrame
    customers: DataFrame
    products: DataFrame


def known_keys(warehouse: Warehouse, dimension: str) -> DataFrame | None:
    """The key map of the live generation, or one made from its dimension if it was published without."""
    live = live_generation(warehouse)
    if live is None:
        return None
    name, identity, _ = gold.KEYS[dimension]
    stored = f"{warehouse.name('gold', f'{dimension}_keys')}__{live}"
    if warehouse.spark.catalog.tableExists(stored):
        return warehouse.spark.table(stored)
    rows = warehouse.table("gold", f"{dimension}__{live}").select(name, *identity)
    return number_within(rows, identity, [name], OCCURRENCE)


def publish_gold(warehouse: Warehouse, run_id: str, limits: Mapping[str, int] = STAR_LIMITS, stable_keys: bool = False) -> DataFrame:
    """Write both dimensions and the fact view aside, check them, and make them live together; returns the run's log.

    ``limits`` has, by check of ``quality.gate``, how many rows may fail. Where more do,
    nothing that readers see has changed: the generation is taken away, the log has it
    as refused, the results of the checks are stored, and ``PublishRefused`` is raised.

    The fact stays a view: nothing of its size is copied. The dimensions do not
    change until the next run, so their measured sizes decide here which of them
    the view broadcasts.

    With ``stable_keys`` a row keeps the surrogate key of earlier publishes, and new rows
    get the next ones; the map of all keys is a part of the generation. Otherwise keys
    are given anew in the dimension's order.
    """
    table, generation = warehouse.table, uuid.uuid4().hex
    customers = [table("silver", t) for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")]
    products = [table("silver", t) for t in ("crm_prd_info", "erp_px_cat_g1v2")]
    builds = {"dim_customers": lambda: gold.dim_customers(*customers), "dim_products": lambda: gold.dim_products(*products)}
    if stable_keys:
        attributes = {"dim_customers": lambda: gold.customer_attributes(*customers), "dim_products": lambda: gold.product_attributes(*products)}
        builds = {}
        for dimension, build in attributes.items():
            known = known_keys(warehouse, dimension)
            rows = stash(gold.keyed(build(), dimension, known), "dimension")
            builds[dimension] = lambda rows=rows: rows
            builds[f"{dimension}_keys"] = lambda rows=rows, d=dimension, known=known: gold.key_map(rows, d, known)
    staged: dict[str, Staged] = {}
    begun: dict[str, dt.datetime] = {}
    view = f"{warehouse.name('gold', 'fact_sales')}__{generation}"
    try:
        for name, build in builds.items():
            begun[name] = _now()
            staged[name] = warehouse.stage("gold", name, build(), run_id, generation)
        for name, rows in _hot_parts(warehouse, generation):
            begun[name] = _now()
            staged[name] = warehouse.stage("gold", name, rows, run_id, generation)
        _fact_view(warehouse, generation, view, staged)
        new = _star_of(warehouse, generation)
        results = quality.gate(*new, checks=limits.keys())
        found = {r.check_name: r.failing_rows for r in store_results(warehouse, run_id, "gold", results).collect()}
        failing = {check: found[check] for check, most in limits.items() if found[check] > most}
        if failing:
            raise PublishRefused(", ".join(f"{check}: {rows} rows" for check, rows in failing.items()))
    except BaseException as failure:
        warehouse.spark.sql(f"DROP VIEW IF EXISTS {view}")
        for name, one in staged.items():
            warehouse.discard("gold", name, one)
        status = "refused" if isinstance(failure, PublishRefused) else "failed"
        warehouse.log([_entry(run_id, "gold", name, begun[name], status, staged[name].rows if name in staged else None, None, failure) for name in begun])
        raise
    # from here on ``star`` reads the new generation; the names in the catalog follow
    warehouse.append("generations", warehouse.spark.createDataFrame([(generation, run_id, _now(), "live")], schemas.struct(schemas.GENERATIONS)))
    for name, one in staged.items():
        warehouse.go_live("gold", name, one)
        warehouse._unmark("gold", name, one.attempt)
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW {warehouse.name('gold', 'fact_sales')} AS SELECT * FROM {view}")
    warehouse.log([_entry(run_id, "gold", name, begun[name], "loaded", one.rows) for name, one in staged.items()])
    return run_log(warehouse, run_id)


# Business key, surrogate key and the sales column that looks it up, by dimension in the order of the fact's joins.
_LOOKUPS = {"dim_products": ("product_number", "product_key", "sls_prd_key"), "dim_customers": ("customer_id", "customer_key", "sls_cust_id")}


def _is_small(warehouse: Warehouse, generation: str, dimension: str) -> bool:
    columns = _LOOKUPS[dimension][:2]
    return measure(warehouse.table("gold", f"{dimension}__{generation}").select(*columns))[1] <= limit(warehouse.spark, "broadcastBytes")


def _hot_parts(warehouse: Warehouse, generation: str) -> Iterator[tuple[str, DataFrame]]:
    """For a dimension too large to broadcast with a business key too frequent for one task: its rows by numbered part, and the parts of each such key.

    Rows of such a key are dealt by their number among them, others have part 0.
    """
    for dimension, (key, surrogate, _) in _LOOKUPS.items():
        if _is_small(warehouse, generation, dimension):
            continue
        rows = warehouse.table("gold", f"{dimension}__{generation}").select(key, surrogate)
        hot = hot_keys(rows.where(F.col(key).isNotNull()), [key])
        if hot is None:
            continue
        most = max(1, limit(warehouse.spark, "hotGroupRows"))
        listed = hot.select(F.col(aside(key)).alias("__hot"))
        found = rows.join(listed, F.col(key) == F.col("__hot"), "left")
        counts = found.where("__hot is not null").groupBy("__hot").agg(F.greatest(F.lit(2), F.ceil(F.count("*") / most)).cast("int").alias("parts"))
        counts = stash(counts, "parts")
        sized = rows.join(short_list(counts), F.col(key) == F.col("__hot"), "left")
        # by its number, so that no part of a key is empty
        dealt = number_within(sized.where("__hot is not null"), [key], [surrogate], "__number")
        ordinary = sized.where("__hot is null").select(key, surrogate, F.lit(0).alias("part"))
        yield f"{dimension}_parts", ordinary.unionByName(dealt.select(key, surrogate, F.pmod(F.col("__number") - 1, F.col("parts")).cast("int").alias("part")))
        yield f"{dimension}_hot", counts.select(F.col("__hot").alias(key), "parts")


def _fact_view(warehouse: Warehouse, generation: str, view: str, stored: Collection[str]) -> None:
    """The fact over the dimensions of one generation; a line whose key is dealt in parts visits each of them once."""
    columns = ", ".join(f"{old} AS {new}" for new, old in gold.SALES_NAMES.items())
    source = f"SELECT * FROM {warehouse.name('silver', 'crm_sales_details')}"
    for dimension, (key, surrogate, line) in _LOOKUPS.items():
        name, hint = warehouse.name("gold", dimension), ""
        match = f"{dimension}.{key} = {line}"
        if f"{dimension}_parts" in stored:
            source = (
                f"SELECT /*+ BROADCAST(hot) */ lines.*, {dimension}_visit FROM ({source}) AS lines LEFT JOIN {name}_hot__{generation} AS hot ON hot.{key} = {line}"
                f" LATERAL VIEW explode(sequence(0, coalesce(hot.parts, 1) - 1)) visits AS {dimension}_visit"
            )
            name, match = f"{name}_parts", f"{match} AND {dimension}.part = {dimension}_visit"
        elif _is_small(warehouse, generation, dimension):
            hint = f"/*+ BROADCAST({dimension}) */"
        source = f"SELECT {hint} lines.*, {dimension}.{surrogate} FROM ({source}) AS lines LEFT JOIN {name}__{generation} AS {dimension} ON {match}"
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM ({source})")


def _star_of(warehouse: Warehouse, generation: str) -> Star:
    return Star(*[warehouse.table("gold", f"{t}__{generation}") for t in ("fact_sales", *GOLD_TABLES)])


def live_generation(warehouse: Warehouse) -> str | None:
    live = warehouse.table("audit", "generations").where("state = 'live'").orderBy(F.desc("published_at")).first()
    return None if live is None else live.generation


def star(warehouse: Warehouse) -> Star:
    """The live star schema: fact view and dimensions of one generation, whatever is published meanwhile."""
    live = live_generation(warehouse)
    if live is None:
        raise LookupError("no star schema has been published")
    return _star_of(warehouse, live)


def publish_marts(warehouse: Warehouse, as_of: dt.date, run_id: str, only: Sequence[str] | None = None) -> DataFrame:
    """Store the marts over the published star schema, all or some; returns the run's log.

    The totals by product group are merged from their stored parts, which must be stored first.
    """
    facts, customers, products = star(warehouse)
    groups = ("category", "product_line")
    steps = {
        "flat_sales": lambda: marts.flat_parts(warehouse.table("silver", "crm_sales_details"), customers, products),
        "sales_by_product_group_parts": lambda: marts.partial_sales(facts, products, "product_key", groups),
        "sales_by_product_group": lambda: marts.merged_sales(warehouse.table("mart", "sales_by_product_group_parts"), groups),
        "sales_by_customer_group": lambda: marts.sales_by_customer_group(facts, customers),
        "customer_profile": lambda: marts.customer_profile(customers, as_of),
    }
    return _run(warehouse, "mart", {t: build for t, build in steps.items() if only is None or t in only}, run_id)


def store_results(warehouse: Warehouse, run_id: str, layer: str, results: DataFrame) -> DataFrame:
    """Add check results to ``audit.check_results``; returns those of this run and layer."""
    known = {"run_id": F.lit(run_id), "checked_at": F.lit(_now()), "layer": F.lit(layer)}
    columns = [known.get(c, F.col(c) if c in results.columns else F.lit(None)).cast(schemas.struct(schemas.CHECK_RESULTS)[c].dataType).alias(c) for c in schemas.CHECK_RESULTS]
    warehouse.append("check_results", results.select(*columns))
    stored = warehouse.table("audit", "check_results")
    return stored.where((F.col("run_id") == run_id) & (F.col("layer") == layer))


def check_gold(warehouse: Warehouse, run_id: str) -> DataFrame:
    """Run the star-schema checks on what is published and store their results; returns the run's."""
    return store_results(warehouse, run_id, "gold", quality.gate(*star(warehouse)))


def check_layer(warehouse: Warehouse, layer: str, as_of: dt.date, run_id: str, keep_rows: bool = False) -> DataFrame:
    """Run all checks of the raw or cleaned tables, each table read once, and store the results; returns the run's.

    ``keep_rows`` also stores the offending rows: table ``audit.<layer>_<table>_rows`` has
    those of the last such run, with the names of the checks that each of them fails.
    """
    checks = {"bronze": audit.raw_checks, "silver": audit.clean_checks}[layer](as_of)
    run = audit.Audit(checks, lambda t: warehouse.table(layer, t))
    if keep_rows:
        for table in checks:
            rows = run.offending(table)
            folder = f"{warehouse.root}/audit/{layer}_{table}_rows/run-{run_id}-{uuid.uuid4().hex}"
            rows.write.parquet(folder)
            name = warehouse.name("audit", f"{layer}_{table}_rows")
            columns = {**schemas.TABLES[layer][table], audit.FAILED: "note"}
            warehouse._create_table(name, columns, folder)
            warehouse.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            warehouse.spark.catalog.refreshTable(name)
    return store_results(warehouse, run_id, layer, run.results())


def run_log(warehouse: Warehouse, run_id: str | None = None) -> DataFrame:
    log = warehouse.table("audit", "run_log")
    return log if run_id is None else log.where(F.col("run_id") == run_id)


def batch_times(log: DataFrame) -> DataFrame:
    """Start, end and whole duration of each layer of each run."""
    whole = F.timestamp_diff("SECOND", F.min("started_at"), F.max("ended_at")).cast("int")
    return log.groupBy("run_id", "layer").agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        whole.alias("seconds"),
        F.count("*").alias("tables"),
        F.sum("row_count").alias("row_count"),
    )
