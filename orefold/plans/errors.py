"""What went wrong in a load, as stable codes instead of a message.

An error's message names Spark's error conditions in brackets, from the outermost (a
task failed) to the cause (a value could not be parsed). The category goes by the
innermost condition that a rule knows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import PySparkException

# Categories and the conditions that belong to them, by their first part.
CATEGORIES: Mapping[str, tuple[str, ...]] = {
    "malformed_line": ("MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD", "CANNOT_PARSE_TIMESTAMP", "CAST_INVALID_INPUT"),
    "value_too_long": ("EXCEED_LIMIT_LENGTH",),
    "number_too_large": ("ARITHMETIC_OVERFLOW", "CAST_OVERFLOW", "CAST_OVERFLOW_IN_TABLE_INSERT", "NUMERIC_VALUE_OUT_OF_RANGE"),
    "missing_input": ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"),
    "missing_column": ("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND"),
    "unreadable_file": ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER"),
    "raised_by_rule": ("USER_RAISED_EXCEPTION",),
}
UNKNOWN = "unknown"
_CONDITION = re.compile(r"\[([A-Z][A-Z0-9_]*(?:\.[A-Z][A-Z0-9_]*)*)\]")


def conditions(error: BaseException) -> list[str]:
    """Every condition the error names, outermost first."""
    found = []
    if isinstance(error, PySparkException) and error.getCondition():
        found.append(error.getCondition())
    for link in (error, error.__cause__):
        found += _CONDITION.findall(str(link)) if link is not None else []
    return list(dict.fromkeys(found))


def category(error: BaseException) -> str:
    for condition in reversed(conditions(error)):
        for name, known in CATEGORIES.items():
            if condition.split(".")[0] in known:
                return name
    return UNKNOWN


def described(error: BaseException) -> tuple[str, str | None, str, str]:
    """Class, SQLSTATE, message and category, as the run log keeps them."""
    known = isinstance(error, PySparkException)
    name = (known and error.getCondition()) or type(error).__name__
    return name, error.getSqlState() if known else None, str(error), category(error)
