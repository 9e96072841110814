"""Run a registered query on Spark and its SQL on DuckDB and compare the rows.

As a script:  python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (float(f"{v:.9g}") + 0.0)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "as_tuple"):
        return ("decimal", str(v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))
    return [columns[i] for i in order], out


def differences(spark_df, con, sql):
    cols, rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    ocols, orows = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} != {ocols}", len(rows)
    if len(rows) != len(orows):
        return f"rows {len(rows)} != {len(orows)}: e.g. {rows[:2]} / {orows[:2]}", len(rows)
    bad = [(a, b) for a, b in zip(rows, orows) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ: {cols} {bad[0]}", len(rows)
    return None, len(rows)


def main(argv):
    from docloom.session import build_session
    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__checkpoint__dir=f"file:{tempfile.mkdtemp(prefix='docloom-oracle-')}")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(qs)
    failed = 0
    for name in names:
        t = time.time()
        try:
            df = qs[name](spark, folder)
            if name in sqls:
                diff, n = differences(df, con, sqls[name])
            else:
                diff, n = None, len(df.collect())
        except Exception as e:  # report and go on with the next query
            diff, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += diff is not None
        mark = "ok  " if diff is None else "FAIL"
        print(f"{mark} {name} rows={n} {'oracle' if name in sqls else 'rows-only'} {time.time() - t:.2f}s {diff or ''}"[:1500], flush=True)
    print(f"{len(names)} queries, {failed} failed")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
