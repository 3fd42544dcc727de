"""All checks of a layer as one job: a table is read once for all of its checks.

The rows of a table are grouped by its key, and every check is a conditional count per
group, combined before the shuffle; so one pass gives the counts of the row checks, the
keys that are missing or repeated, and the set of keys that other tables refer to. What
it leaves, a row per key, is stored, and everything else is read from there.

The offending rows can be kept aside: one filter per table, each row with the names of
the checks it fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import cleaning as c
from orefold.operators.joins import left_lookup
from orefold.plans.quality import OLDEST_BIRTH
from orefold.plans.silver import sales_measures
from orefold.session import stash

FAILED = "failed_checks"
RESULT = ("table_name", "check_name", "checked_rows", "failing_rows")


@dataclass(frozen=True)
class TableChecks:
    """``rows``: failing condition by check. ``key`` groups the rows; unless ``key_check``
    is None, a repeated key fails it, and so does a missing one if ``key_required``.
    ``superseded`` counts rows beyond the first of their key. ``refers`` has, by check, a
    value and the table whose keys must contain it; a missing value refers to nothing.
    """

    key: Column
    rows: Mapping[str, Column]
    key_check: str | None = None
    key_required: bool = True
    superseded: str | None = None
    refers: Mapping[str, tuple[Column, str]] = field(default_factory=dict)


def _strange(text: str, labels: Mapping[str, tuple[str, ...]]) -> Column:
    return c.label_of(c.code_form(F.col(text)), labels).isNull()


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _still_disagree() -> Column:
    repaired = sales_measures()
    return c.measures_disagree(repaired["sls_sales"], F.col("sls_quantity"), repaired["sls_price"])


def _late() -> Column:
    order = F.col("sls_order_dt")
    return (order > F.col("sls_ship_dt")) | (order > F.col("sls_due_dt"))


def _odd_birth(as_of: dt.date) -> Column:
    return (F.col("bdate") < F.lit(OLDEST_BIRTH)) | (F.col("bdate") > F.lit(as_of))


_TEXTS = ("cat", "subcat", "maintenance")
_MEASURES = ("sls_sales", "sls_quantity", "sls_price")


def raw_checks(as_of: dt.date) -> dict[str, TableChecks]:
    """The checks of the raw tables, referred tables first."""
    untrimmed = {f"untrimmed_{what}_name": c.untrimmed(F.col(f"cst_{what}name")) for what in ("first", "last")}
    dates = {f"bad_{d}_date": c.date_key_suspect(F.col(f"sls_{d}_dt")) for d in ("order", "ship", "due")}
    return {
        "erp_px_cat_g1v2": TableChecks(
            F.col("id"), {"missing_id": F.col("id").isNull(), "untrimmed_text": _any([c.untrimmed(F.col(t)) for t in _TEXTS])}, "repeated_id", key_required=False
        ),
        "crm_sales_details": TableChecks(
            F.col("sls_prd_key"),
            {
                "nonpositive_order_date": F.col("sls_order_dt") <= 0,
                **dates,
                "late_order": _late(),
                "bad_measures": c.measures_disagree(*map(F.col, _MEASURES)),
                "measures_beyond_repair": _still_disagree(),
            },
        ),
        "crm_cust_info": TableChecks(
            F.col("cst_id"),
            {**untrimmed, "unknown_gender": _strange("cst_gndr", c.CRM_GENDER_LABELS), "unknown_marital_status": _strange("cst_marital_status", c.MARITAL_LABELS)},
            "missing_or_repeated_id",
            superseded="superseded_rows",
        ),
        "crm_prd_info": TableChecks(
            F.col("prd_id"),
            {
                "bad_cost": F.col("prd_cost").isNull() | (F.col("prd_cost") < 0),
                "unknown_line": _strange("prd_line", c.PRODUCT_LINE_LABELS),
                "reversed_version": F.col("prd_end_dt") < F.col("prd_start_dt"),
            },
            "missing_or_repeated_id",
            refers={
                "unknown_category": (c.category_id(F.col("prd_key")), "erp_px_cat_g1v2"),
                "never_sold": (c.product_number(F.col("prd_key")), "crm_sales_details"),
            },
        ),
        "erp_cust_az12": TableChecks(F.col("cid"), {"odd_birth_date": _odd_birth(as_of), "unknown_gender": _strange("gen", c.ERP_GENDER_LABELS)}, "missing_or_repeated_id"),
        "erp_loc_a101": TableChecks(F.col("cid"), {"unknown_country": c.country(F.col("cntry")) == c.UNKNOWN}, "missing_or_repeated_id"),
    }


def clean_checks(as_of: dt.date) -> dict[str, TableChecks]:
    """The checks of the cleaned tables: what cleaning should have mended, and what it cannot."""
    raw = raw_checks(as_of)

    def unknown(column: str) -> Column:
        return F.col(column) == c.UNKNOWN

    current = F.when(F.col("prd_end_dt").isNull(), F.col("prd_key"))
    customers = raw["crm_cust_info"]
    names = {k: v for k, v in customers.rows.items() if k.startswith("untrimmed")}
    missing = {f"missing_{d}_date": F.col(f"sls_{d}_dt").isNull() for d in ("order", "ship", "due")}
    return {
        "erp_px_cat_g1v2": raw["erp_px_cat_g1v2"],
        "crm_sales_details": TableChecks(F.col("sls_prd_key"), {**missing, "late_order": _late(), "bad_measures": c.measures_disagree(*map(F.col, _MEASURES))}),
        "crm_cust_info": TableChecks(
            F.col("cst_id"),
            {**names, "unknown_gender": unknown("cst_gndr"), "unknown_marital_status": unknown("cst_marital_status")},
            "missing_or_repeated_id",
            superseded="superseded_rows",
        ),
        "crm_prd_info": TableChecks(
            current,
            {"bad_cost": F.col("prd_cost").isNull() | (F.col("prd_cost") < 0), "unknown_line": unknown("prd_line"), "reversed_version": F.col("prd_end_dt") < F.col("prd_start_dt")},
            "repeated_current_version",
            key_required=False,
            refers={"unknown_category": (F.col("cat_id"), "erp_px_cat_g1v2"), "never_sold": (F.col("prd_key"), "crm_sales_details")},
        ),
        "erp_cust_az12": TableChecks(F.col("cid"), {"odd_birth_date": _odd_birth(as_of), "unknown_gender": unknown("gen")}, "missing_or_repeated_id"),
        "erp_loc_a101": TableChecks(F.col("cid"), {"unknown_country": unknown("cntry")}, "missing_or_repeated_id"),
    }


_KEY, _ROWS = "__key", "__rows"


def _referring(df: DataFrame, checks: TableChecks, groups: Mapping[str, DataFrame]) -> DataFrame:
    """``df`` with a boolean column per reference check."""
    for check, (value, table) in checks.refers.items():
        keys = groups[table].where(F.col(_KEY).isNotNull()).select(F.col(_KEY).alias("__known"), F.lit(True).alias(f"__has_{check}"))
        found = left_lookup(df.withColumn("__value", value), keys, "__value", "__known")
        failing = F.col("__value").isNotNull() & F.col(f"__has_{check}").isNull()
        df = found.withColumn(check, failing).drop("__value", f"__has_{check}")
    return df


def _conditions(checks: TableChecks) -> dict[str, Column]:
    return {**checks.rows, **{check: F.col(check) for check in checks.refers}}


def grouped(df: DataFrame, checks: TableChecks, groups: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key: its rows, and how many of them fail each row check."""
    marked = _referring(df, checks, groups)
    counts = [F.count_if(condition).alias(name) for name, condition in _conditions(checks).items()]
    return marked.groupBy(checks.key.alias(_KEY)).agg(F.count("*").alias(_ROWS), *counts)


def _bad_key(checks: TableChecks) -> Column:
    repeated = F.col(_KEY).isNotNull() & (F.col(_ROWS) > 1)
    return repeated | F.col(_KEY).isNull() if checks.key_required else repeated


def totals(table: str, checks: TableChecks, groups: DataFrame) -> DataFrame:
    """The result rows of one table, from its rows per key."""
    sums = {name: F.sum(name) for name in _conditions(checks)}
    if checks.key_check:
        sums[checks.key_check] = F.count_if(_bad_key(checks))
    if checks.superseded:
        sums[checks.superseded] = F.sum(F.col(_ROWS) - 1)
    found = groups.agg(F.coalesce(F.sum(_ROWS), F.lit(0)).alias("checked_rows"), *[F.coalesce(s, F.lit(0)).alias(name) for name, s in sums.items()])
    return found.unpivot(["checked_rows"], list(sums), "check_name", "failing_rows").select(F.lit(table).alias("table_name"), *RESULT[1:])


def offending(df: DataFrame, checks: TableChecks, groups: Mapping[str, DataFrame], own: DataFrame) -> DataFrame:
    """The rows that fail some check, with ``failed_checks``, the names in the order of the checks.

    A row whose key is missing or repeated fails the key check; which of equal keys is
    the right one is not decided here, so all their rows are kept.
    """
    columns = df.columns
    marked = _referring(df, checks, groups)
    conditions = _conditions(checks)
    if checks.key_check:
        bad = own.where(_bad_key(checks) & F.col(_KEY).isNotNull()).select(F.col(_KEY).alias("__bad"), F.lit(True).alias("__repeated"))
        marked = left_lookup(marked.withColumn("__own", checks.key), bad, "__own", "__bad")
        failing = F.col("__repeated").isNotNull()
        conditions[checks.key_check] = failing | F.col("__own").isNull() if checks.key_required else failing
    names = F.filter(F.array(*[F.when(condition, name) for name, condition in conditions.items()]), lambda x: x.isNotNull())
    return marked.withColumn(FAILED, F.array_join(names, ",")).where(F.col(FAILED) != "").select(*columns, FAILED)


class Audit:
    """The checks of one layer; every table is scanned once, on construction."""

    def __init__(self, checks: Mapping[str, TableChecks], table: Callable[[str], DataFrame]):
        self.checks, self.table = checks, table
        self.groups: dict[str, DataFrame] = {}
        for name, own in checks.items():
            self.groups[name] = stash(grouped(table(name), own, self.groups), "audit")

    def results(self) -> DataFrame:
        """``table_name``, ``check_name``, ``checked_rows`` and ``failing_rows`` of every check."""
        return reduce(DataFrame.unionByName, [totals(name, own, self.groups[name]) for name, own in self.checks.items()])

    def offending(self, table: str) -> DataFrame:
        return offending(self.table(table), self.checks[table], self.groups, self.groups[table])
