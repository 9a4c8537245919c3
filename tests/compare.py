"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

Usage: python tests/compare.py [sf or folder] [key prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")
EXACT = bool(os.environ.get("EXACT"))  # compare doubles bit by bit
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(root: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet')")
    return con


def plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return f"{decimal.Decimal(value).normalize():f}" if value else "0"
    if isinstance(value, float):
        return repr(value) if EXACT else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


def type_notes(df, description) -> list[str]:
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {d[0]: str(d[1]) for d in description}
    notes = []
    for name, kind in ours.items():
        want = KIND.get(kind, kind.upper().replace(" ", ""))
        got = theirs.get(name, "absent").replace(" ", "")
        if want != got and not kind.startswith(("array", "struct")):
            notes.append(f"{name}: {want} vs {got}")
    return notes


def check(spark, con, key, fn, sql, root):
    start = time.time()
    df = fn(spark, str(root))
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL", took
    cur = con.execute(sql)
    description = cur.description
    want = cur.fetchall()
    a, b = rows_of(df.columns, got), rows_of([d[0] for d in description], want)
    notes = type_notes(df, description)
    if a == b:
        return not notes, f"{len(got)} rows {notes or ''}", took
    if a[0] != b[0]:
        return False, f"columns {a[0]} vs {b[0]}", took
    sa, sb = set(a[1]), set(b[1])
    return False, (f"{len(got)} vs {len(want)} rows; only spark {sorted(sa - sb)[:2]} "
                   f"only sql {sorted(sb - sa)[:2]} {notes or ''}"), took


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tiffin.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    prefixes = tuple(sys.argv[2:])
    root = Path(sf) if "/" in sf else DATA / f"sf{sf}"
    spark, con, sql = build_session(cores=8), connect(root), oracle_sql()
    bad = 0
    for key, fn in queries().items():
        if prefixes and not key.startswith(prefixes):
            continue
        try:
            ok, note, took = check(spark, con, key, fn, sql.get(key), root)
        except Exception as exc:  # report and go on
            ok, note, took = False, f"{type(exc).__name__}: {str(exc)[:600]}", 0
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {key:34s} {took:6.2f}s {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
