"""Runs queries and their SQL equivalents side by side.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _family(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return "int"
    if pa.types.is_floating(t):
        return "float"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_decimal(t):
        return f"decimal{t.scale}"
    return str(t)


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return str(v)


def rows_of(t: pa.Table) -> list[tuple]:
    names = sorted(t.column_names)
    columns = [t.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def compare(ours: pa.Table, theirs: pa.Table) -> list[str]:
    problems = []
    a, b = sorted(ours.column_names), sorted(theirs.column_names)
    if a != b:
        return [f"columns {a} != {b}"]
    for n in a:
        x, y = _family(ours.schema.field(n).type), _family(theirs.schema.field(n).type)
        if x != y:
            problems.append(f"type of {n}: {ours.schema.field(n).type} / {theirs.schema.field(n).type}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    x, y = rows_of(ours), rows_of(theirs)
    if x != y:
        in_x, in_y = set(x), set(y)
        only_a = [r for r in x if r not in in_y][:3]
        only_b = [r for r in y if r not in in_x][:3]
        problems.append(f"values differ: ours {only_a} theirs {only_b}")
    return problems


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from orelayer.session import build_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, found, sqls, failed = duck(sf), queries(), oracle_sql(), []
    for name in argv[1:] or found:
        start = time.time()
        try:
            ours = found[name](spark, sf).toArrow()
            if name in sqls:
                theirs = con.sql(sqls[name]).to_arrow_table()
                problems = compare(ours, theirs)
            else:
                problems = []
            note = "" if name in sqls else " (no SQL)"
        except Exception as error:  # report and go on
            problems, note, ours = [f"{type(error).__name__}: {str(error)[:1500]}"], "", None
        took = time.time() - start
        state = "FAIL" if problems else "ok"
        print(f"{state:4} {name:28} {ours.num_rows if ours is not None else '-':>8} rows {took:6.2f}s{note}", flush=True)
        for p in problems:
            print("     ", p[:1800], flush=True)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
