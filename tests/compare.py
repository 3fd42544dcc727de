"""Compare every registered query with its DuckDB result.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return db


def difference(df, db, sql: str) -> str | None:
    """None when schema and rows agree; both sides are small in tests."""
    expected = db.execute(sql)
    kinds = {d[0]: str(d[1]) for d in expected.description}
    ours = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if kinds != ours:
        return f"schema: spark {ours} duckdb {kinds}"
    names = sorted(ours)
    place = [list(kinds).index(n) for n in names]
    wanted = Counter(tuple(r[i] for i in place) for r in expected.fetchall())
    got = Counter(tuple(r) for r in df.select(*names).collect())
    if wanted == got:
        return None
    missing, extra = wanted - got, got - wanted
    return f"rows: {sum(missing.values())} missing, {sum(extra.values())} extra, e.g. {list(missing)[:2]} / {list(extra)[:2]}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from orefold.registry import all_queries
    from orefold.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failures = 0
    for name, query in all_queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = difference(query.run(spark, folder), db, query.sql)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    sys.exit(1 if failures else 0)
