"""Runs queries and compares them with their SQL in DuckDB."""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

from suite import ORACLES, QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return repr(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "float": "FLOAT"}


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    """``ok``, ``rows only`` or a description of the first difference, and the row count."""
    df = QUERIES[name](spark, sf_dir)
    left = normalised(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "rows only", len(left[1])
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    right = normalised(names, result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}", len(left[1])
    bad = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema
           if _TYPES.get(f.dataType.simpleString(), "?") != kinds[f.name]]
    if bad:
        return f"types {bad}", len(left[1])
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}", len(left[1])
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"values {a} / {b}"[:500], len(left[1])
    return "ok", len(left[1])


def main(sf_dir: str, only: list[str]) -> int:
    from speechset.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            verdict, rows = compare(spark, con, name, sf_dir)
        except Exception as failure:
            verdict, rows = f"{type(failure).__name__}: {str(failure)[:1500]}", -1
        failed += verdict not in ("ok", "rows only")
        print(f"{name:32s} {rows:6d} rows {time.time() - start:6.2f} s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
