"""Run every query next to its SQL twin and compare names, types and values."""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, datetime):
        return value.isoformat()
    return repr(value)


def _family(name: str) -> str:
    name = name.lower().split("(")[0]
    return {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}.get(name, name)


def compare(spark_frame, relation) -> list[str]:
    """Differences between a Spark frame and a DuckDB relation, empty if none."""
    problems = []
    names = sorted(spark_frame.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} vs {sorted(relation.columns)}"]
    ours = {field.name: _family(field.dataType.simpleString()) for field in spark_frame.schema}
    theirs = {name: _family(str(kind)) for name, kind in zip(relation.columns, relation.types)}
    for name in names:
        if ours[name] != theirs[name]:
            problems.append(f"type of {name}: {ours[name]} vs {theirs[name]}")
    left = sorted(tuple(_cell(row[name]) for name in names) for row in spark_frame.collect())
    at = [relation.columns.index(name) for name in names]
    right = sorted(tuple(_cell(row[position]) for position in at) for row in relation.fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    if left != right:
        different = [pair for pair in zip(left, right) if pair[0] != pair[1]][:2]
        problems.append(f"values differ, e.g. {different}")
    return problems


if __name__ == "__main__":
    from conftest import session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, connection, failed = session(), connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = run(spark, sf_dir)
            if name in oracles:
                problems = compare(frame, connection.sql(oracles[name]))
            else:
                problems = [] if frame.collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok':4} {name} [{kind}] {time.time() - started:.2f}s {problems or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()
