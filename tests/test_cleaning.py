"""Truth tables of the cleaning rules, NULL included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orefold.functions import cleaning as c

D = dt.date


def apply(spark, rule, rows, schema):
    columns = [F.col(part.split()[0]) for part in schema.split(",")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, i int")
    return [r[0] for r in df.select(rule(*columns).alias("out"), "i").orderBy("i").select("out").collect()]


TEXT = {
    "marital_status": (c.marital_status, {"S": "Single", " m ": "Married", "M": "Married", "Single": "n/a", "": "n/a", None: "n/a"}),
    "crm_gender": (c.crm_gender, {" f": "Female", "M": "Male", "Female": "n/a", "x": "n/a", None: "n/a"}),
    "erp_gender": (c.erp_gender, {"F": "Female", "female ": "Female", " Male": "Male", "m": "Male", "": "n/a", None: "n/a"}),
    "product_line": (
        c.product_line,
        {"M ": "Mountain", "r": "Road", "S": "Other Sales", "t ": "Touring", "Q": "n/a", "": "n/a", None: "n/a"},
    ),
    "country": (
        c.country,
        {"DE": "Germany", " US": "United States", "USA ": "United States", "us": "us", " France ": "France", "  ": "n/a", "": "n/a", None: "n/a"},
    ),
    "without_prefix": (c.without_prefix, {"NASAW1": "AW1", "AW1": "AW1", "nasAW1": "nasAW1", "NAS": "", "XNAS1": "XNAS1", None: None}),
    "without_hyphens": (c.without_hyphens, {"AW-0-1": "AW01", "AW": "AW", "-": "", None: None}),
    "category_id": (c.category_id, {"AC-HE-DOME-2B": "AC_HE", "CO": "CO", "": "", None: None}),
    "product_number": (c.product_number, {"AC-HE-DOME-2B": "DOME-2B", "AC-HE-": "", "AC": "", None: None}),
    "trimmed": (c.trimmed, {"  a b ": "a b", "\ta": "\ta", "": "", None: None}),
    "untrimmed": (c.untrimmed, {" a": True, "a ": True, "a": False, "": False, None: None}),
}


@pytest.mark.parametrize("name", TEXT)
def test_text_rules(spark, name):
    rule, table = TEXT[name]
    assert apply(spark, rule, [(k,) for k in table], "v string") == list(table.values())


def test_date_from_key(spark):
    table = {
        20101229: D(2010, 12, 29),
        20120229: D(2012, 2, 29),
        20130229: None,
        19000229: None,
        20000229: D(2000, 2, 29),
        20101301: None,
        20100001: None,
        20100100: None,
        20100431: None,
        10000101: D(1000, 1, 1),
        99991231: D(9999, 12, 31),
        0: None,
        5489: None,
        201012290: None,
        -2010122: None,
        -20101229: None,
        None: None,
    }
    assert apply(spark, c.date_from_key, [(k,) for k in table], "v int") == list(table.values())


def test_date_key_suspect(spark):
    table = {20101229: False, 0: True, -1: True, 5489: True, 20500102: True, 18991231: True, 20130229: False, None: None}
    assert apply(spark, c.date_key_suspect, [(k,) for k in table], "v int") == list(table.values())


def test_not_after(spark):
    table = {D(2025, 12, 31): D(2025, 12, 31), D(2026, 1, 1): None, D(1900, 1, 1): D(1900, 1, 1), None: None}
    rule = lambda v: c.not_after(v, F.lit(D(2025, 12, 31)))
    assert apply(spark, rule, [(k,) for k in table], "v date") == list(table.values())


def test_known_cost(spark):
    assert apply(spark, c.known_cost, [(5,), (-5,), (0,), (None,)], "v int") == [5, -5, 0, 0]


# sales, quantity, price -> repaired sales, repaired price
MEASURES = [
    ((20, 2, 10), (20, 10)),
    ((None, 2, 10), (20, 10)),
    ((0, 2, 10), (20, 10)),
    ((-20, 2, 10), (20, 10)),
    ((21, 2, 10), (20, 10)),
    ((20, 2, -10), (20, 10)),
    ((20, 2, None), (20, 10)),
    ((21, 2, None), (21, 10)),
    ((-21, 2, None), (None, -10)),
    ((20, 2, 0), (0, 10)),
    ((-20, 2, -10), (20, -10)),
    ((None, 2, None), (None, None)),
    ((20, 0, None), (20, None)),
    ((20, None, 10), (20, 10)),
    ((None, None, 10), (None, 10)),
]


def test_measure_repair(spark):
    rows = [m for m, _ in MEASURES]
    schema = "s int, q int, p int"
    assert apply(spark, c.repaired_sales, rows, schema) == [e[0] for _, e in MEASURES]
    assert apply(spark, c.repaired_price, rows, schema) == [e[1] for _, e in MEASURES]


def test_measures_disagree(spark):
    rows = [(20, 2, 10), (21, 2, 10), (None, 2, 10), (20, None, 10), (20, 2, None), (0, 0, 0), (-20, 2, -10), (20, -2, -10)]
    assert apply(spark, c.measures_disagree, rows, "s int, q int, p int") == [False] + [True] * 7


def test_preferred_gender(spark):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male"), (None, None), ("n/a", "n/a")]
    assert apply(spark, c.preferred_gender, rows, "a string, b string") == ["Male", "Female", "n/a", "Male", "n/a", "n/a"]


@pytest.mark.parametrize("rule", [c.country, c.without_hyphens, c.trimmed])
def test_repeating_a_rule_changes_nothing(spark, rule):
    rows = [("DE",), (" US",), (" A-B ",), ("",), (None,)]
    once = apply(spark, rule, rows, "v string")
    assert apply(spark, rule, [(v,) for v in once], "v string") == once


def test_decoding_a_label_loses_it(spark):
    assert apply(spark, c.marital_status, [("Single",)], "v string") == ["n/a"]
