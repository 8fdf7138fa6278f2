"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if x is None:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, int):
        return x
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return 0.0 if x == 0 else float(f"{x:.9g}")
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t0
    if sql is None:
        return None, took, f"rows only: {sum(got.values())}"
    t0 = time.time()
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rows(cols, rel.fetchall())
    duck_took = time.time() - t0
    if sorted(cols) != sorted(df.columns):
        return False, took, f"columns {sorted(df.columns)} != {sorted(cols)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    types = {d[0]: str(d[1]) for d in rel.description}
    if got == want:
        loose = [f"{c}:{kinds[c]}/{types[c]}" for c in cols if not same_type(kinds[c], types[c])]
        return True, took, f"{sum(got.values())} rows, duckdb {duck_took:.1f}s {' '.join(loose)}"
    more, less = got - want, want - got
    return False, took, (
        f"rows {sum(got.values())} vs {sum(want.values())}; only spark {sum(more.values())} "
        f"{list(more)[:3]}; only duckdb {sum(less.values())} {list(less)[:3]}"
    )


def same_type(spark_type: str, duck_type: str) -> bool:
    pairs = {
        "bigint": ("BIGINT",), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR", "JSON"),
        "boolean": ("BOOLEAN",), "float": ("FLOAT",), "date": ("DATE",), "smallint": ("SMALLINT",),
    }
    return duck_type in pairs.get(spark_type, (duck_type,))


def main(argv):
    import __spark_entry__ as entry
    from bedside.session import build

    sf = os.environ.get("SF", "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    conf = {}
    if os.environ.get("SLICE"):
        conf["spark.bedside.sliceRows"] = os.environ["SLICE"]
    spark = build("8", 8, **conf)
    con = duck(sf_dir)
    q, o = entry.queries(), entry.oracle_sql()
    names = [n for n in q if not argv or any(n.startswith(a) for a in argv)]
    bad = []
    for n in names:
        try:
            ok, took, note = compare(spark, con, n, q[n], o.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, took, note = False, 0.0, f"{type(e).__name__}: {str(e)[:1500]}"
        if ok is False:
            bad.append(n)
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {n} {took:.2f}s {note[:1700]}", flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} fine; failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
