"""Compare registered queries with their SQL twins.

    python tests/oracle_check.py [sf_dir] [query …]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v + 0.0 if isinstance(v, float) else v) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """Empty when rows, column names and types agree exactly."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    expected_rows = found.fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString())
        if want != types[f.name] and not (want == "VARCHAR" and types[f.name] in ('"NULL"', "STRING")):
            out.append(f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}")
    order = sorted(names)
    picks = [names.index(n) for n in order]
    expected = Counter(_key(tuple(r[i] for i in picks)) for r in expected_rows)
    actual = Counter(_key(tuple(r[n] for n in order)) for r in df.collect())
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        out.append(f"{sum(actual.values())} vs {sum(expected.values())} rows; "
                   f"{sum(extra.values())} only in Spark, {sum(missing.values())} only in SQL")
        out += [f"  {order}"]
        out += [f"  + {r}" for r in sorted(extra, key=str)[:3]] + [f"  - {r}" for r in sorted(missing, key=str)[:3]]
    return out


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, bad, oracles = connect(sf_dir), 0, e.oracle_sql()
    for name, run in e.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
                verdict = "FAIL" if found else "ok"
            else:
                found, verdict = [], f"rows={df.count()}"
        except Exception as error:
            found, verdict = [f"{type(error).__name__}: {str(error)[:1500]}"], "ERROR"
        bad += verdict in ("FAIL", "ERROR")
        print(f"{verdict:8} {name} {time.time() - began:.1f}s", *found, sep="\n    " if found else " ", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
