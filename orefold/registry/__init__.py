"""Every query by name, with the SQL that gives the expected rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orefold.registry import audits, checks, jobs, relational, rules, tables
from orefold.registry.lake import Lake
from orefold.registry.oracle import statement


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Lake], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Lake(spark, folder))


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (tables, rules, relational, checks, jobs, audits):
        for name, (plan, sql) in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} registered twice")
            found[name] = Query(name, plan, None if sql is None else statement(sql))
    return found
