"""Run registered queries next to their SQL in DuckDB and compare whole results.

    python tools/check_sql.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from docquarry.catalog import catalog  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    found, bad = catalog(), 0
    for name, run in found.runs.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            mine = rows(df.columns, df.collect())
            spent = time.time() - start
            if name not in found.sql:
                print(f"ROWS  {name} {len(mine)} rows {spent:.2f}s", flush=True)
                continue
            result = con.execute(found.sql[name])
            columns = [d[0] for d in result.description]
            types = {d[0]: str(d[1]) for d in result.description}
            theirs = rows(columns, result.fetchall())
        except Exception as error:
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        same = (sorted(columns) == sorted(df.columns) and len(mine) == len(theirs)
                and all(close(x, y) for a, b in zip(mine, theirs) for x, y in zip(a, b)))
        kinds = " ".join(f"{f.name}:{f.dataType.simpleString()}/{types.get(f.name)}"
                         for f in df.schema.fields)
        print(f"{'ok   ' if same else 'DIFF '} {name} {len(mine)} rows {spent:.2f}s {kinds}",
              flush=True)
        if not same:
            bad += 1
            print("   columns", sorted(df.columns), sorted(columns), len(mine), len(theirs))
            for a, b in [(a, b) for a, b in zip(mine, theirs) if a != b][:3]:
                print("   ", a, "\n   ", b)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
