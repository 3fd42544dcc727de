"""The cleaning rules, one ``Column -> Column`` function each.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes found in the source systems and the labels they stand for.
UNKNOWN = "n/a"
MARITAL_LABELS = {"Single": ("S",), "Married": ("M",)}
CRM_GENDER_LABELS = {"Female": ("F",), "Male": ("M",)}
ERP_GENDER_LABELS = {"Female": ("F", "FEMALE"), "Male": ("M", "MALE")}
PRODUCT_LINE_LABELS = {
    "Mountain": ("M",),
    "Road": ("R",),
    "Other Sales": ("S",),
    "Touring": ("T",),
}
COUNTRY_LABELS = {"Germany": ("DE",), "United States": ("US", "USA")}
ERP_ID_PREFIX = "NAS"
EARLIEST_DATE_KEY, LATEST_DATE_KEY = 19000101, 20500101


def trimmed(text: Column) -> Column:
    """Blanks off both ends; tabs and other white space stay."""
    return F.trim(text)


def code_form(text: Column) -> Column:
    """A code as it is looked up: no outer blanks, upper case."""
    return F.upper(F.trim(text))


def label_of(code: Column, labels: Mapping[str, tuple[str, ...]]) -> Column:
    """Label whose codes contain ``code``; NULL when none does."""
    found = None
    for label, codes in labels.items():
        hit = code.isin(*codes)
        found = F.when(hit, label) if found is None else found.when(hit, label)
    return found


def decode(text: Column, labels: Mapping[str, tuple[str, ...]], default: str = UNKNOWN) -> Column:
    """Label for a code in any case and padding; NULL and strangers get ``default``."""
    return F.coalesce(label_of(code_form(text), labels), F.lit(default))


def marital_status(text: Column) -> Column:
    return decode(text, MARITAL_LABELS)


def crm_gender(text: Column) -> Column:
    return decode(text, CRM_GENDER_LABELS)


def erp_gender(text: Column) -> Column:
    return decode(text, ERP_GENDER_LABELS)


def product_line(text: Column) -> Column:
    return decode(text, PRODUCT_LINE_LABELS)


def country(text: Column) -> Column:
    """Spell out known codes, keep other names trimmed. Codes are case-sensitive."""
    name = F.trim(text)
    return F.coalesce(label_of(name, COUNTRY_LABELS), F.nullif(name, F.lit("")), F.lit(UNKNOWN))


def without_prefix(text: Column, prefix: str = ERP_ID_PREFIX) -> Column:
    rest = F.substr(text, F.lit(len(prefix) + 1))
    return F.when(text.startswith(prefix), rest).otherwise(text)


def without_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def category_id(product_key: Column) -> Column:
    """First five characters, hyphens as underscores: the ERP category id."""
    return F.translate(F.substring(product_key, 1, 5), "-", "_")


def product_number(product_key: Column) -> Column:
    """From the seventh character on: the key sales lines use."""
    return F.substr(product_key, F.lit(7))


def whole_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer division rounding towards zero; NULL for a zero divisor."""
    return F.call_function("div", dividend, F.nullif(divisor, F.lit(0))).cast("int")


def date_from_key(key: Column) -> Column:
    """yyyymmdd number to date; NULL unless it has eight digits and names a real day.

    Plain integer arithmetic: on invalid input it is some sixty times faster than
    parsing the digits as text, which raises and catches an error per bad row.
    """
    year = whole_quotient(key, F.lit(10000))
    month = whole_quotient(key, F.lit(100)) % 100
    day = key % 100
    month_end = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    shaped = key.between(10_000_000, 99_999_999) & month.between(1, 12) & (day >= 1)
    return F.when(shaped, F.when(day <= month_end, F.make_date(year, month, day)))


def date_key_suspect(key: Column) -> Column:
    """Not positive, not eight characters long, or outside the business range."""
    return (
        (key <= 0)
        | (F.length(key.cast("string")) != 8)
        | (key > LATEST_DATE_KEY)
        | (key < EARLIEST_DATE_KEY)
    )


def not_after(date: Column, as_of: Column) -> Column:
    """Dates later than ``as_of`` become NULL."""
    return F.when(date > as_of, F.lit(None)).otherwise(date)


def known_cost(cost: Column) -> Column:
    """Missing cost counts as zero; negative costs are left alone."""
    return F.coalesce(cost, F.lit(0))


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Keep a positive amount that does not contradict quantity times |price|.

    A comparison with a missing price is no contradiction.
    """
    expected = quantity * F.abs(price)
    return F.when((sales > 0) & F.coalesce(sales == expected, F.lit(True)), sales).otherwise(expected)


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Keep a positive price, else derive one from the amount as delivered."""
    return F.when(price > 0, price).otherwise(whole_quotient(sales, quantity))


def preferred_gender(crm: Column, erp: Column) -> Column:
    """The CRM value unless unknown, then the ERP value."""
    return F.coalesce(F.nullif(crm, F.lit(UNKNOWN)), erp, F.lit(UNKNOWN))


def untrimmed(text: Column) -> Column:
    return text != F.trim(text)


def measures_disagree(sales: Column, quantity: Column, price: Column) -> Column:
    """Any measure missing or not positive, or amount other than quantity times price."""
    doubt = sales != quantity * price
    for measure in (sales, quantity, price):
        doubt = doubt | measure.isNull() | (measure <= 0)
    return doubt
