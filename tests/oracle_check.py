"""Run catalogue queries next to their SQL and compare columns, types and values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "string": "VARCHAR",
    "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    frame = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    for name, kind in frame.dtypes:
        wanted = SPARK_TO_DUCK.get(kind, kind.upper())
        if types[name] != wanted:
            problems.append(f"type of {name}: {kind} vs {types[name]}")
    ours = [tuple(r) for r in frame.collect()]
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    mine, other = _rows(frame.columns, ours), _rows(names, theirs)
    if mine != other:
        shown = [(a, b) for a, b in zip(mine, other) if a != b][:3]
        problems.append(f"values differ ({sorted(names)}): {shown}")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = build_session(master="local[8]", partitions=8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf)
    oracle = entry.oracle_sql()
    failed = 0
    for key, run in entry.queries().items():
        if wanted and key not in wanted:
            continue
        began = time.time()
        try:
            if key in oracle:
                found = compare(session, database, sf, run, oracle[key])
                state = "ok" if not found else "DIFF"
            else:
                found, state = [f"{run(session, sf).count()} rows"], "rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            found, state = [f"{type(error).__name__}: {str(error)[:1500]}"], "ERROR"
        failed += state in ("DIFF", "ERROR")
        print(f"{state:5} {key:24} {time.time() - began:6.2f}s {' | '.join(found)}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))
