"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return f"{float(value):.9g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[bool, str]:
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = _rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lack = [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} rows against {len(want)}; only here {extra}; only there {lack}"
    types = {n: str(t[1]) for n, t in zip(names, found.description)}
    return True, f"{len(got)} rows {types}"


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("checks")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con, sqls = session(), connect(folder), oracle_sql()
    for name, run in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                df = run(spark, folder)
                ok, note = compare(df, con, sqls[name])
            else:
                n = run(spark, folder).count()
                ok, note = n > 0, f"{n} rows, no SQL"
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {time.time() - start:6.1f}s {note[:900]}", flush=True)
