"""Runs registered queries on Spark and their SQL in DuckDB and compares the results.

    python -m tests.oracle [sf] [name ..]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return [(v is None, str(type(v)), v if not isinstance(v, float) or not math.isnan(v) else 0)
            for v in row]


def differences(con, df, sql: str) -> list[str]:
    cursor = con.execute(f"DESCRIBE {sql}")
    kinds = {r[0]: r[1] for r in cursor.fetchall()}
    names = sorted(df.columns)
    out = []
    if names != sorted(kinds):
        return [f"columns {names} / {sorted(kinds)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            out.append(f"type of {name}: {kind} / {kinds[name]}")
    listed = ", ".join('"' + n + '"' for n in names)
    want = [tuple(r) for r in con.execute(f"SELECT {listed} FROM ({sql})").fetchall()]
    have = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(want) != len(have):
        out.append(f"rows {len(have)} / {len(want)}")
    want.sort(key=_key)
    have.sort(key=_key)
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {bad[0][0]} / {bad[0][1]}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from siltline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("oracle", 8, **{"spark.sql.shuffle.partitions": "8",
                                          "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        begun = time.time()
        try:
            df = query(spark, folder)
            found = differences(con, df, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
            rows = ""
        except Exception as e:  # report and go on with the next query
            found, rows = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        failed += bool(found) and name in sql
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - begun:.1f}s {'; '.join(found)}{rows}",
              flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
