"""Run registered queries next to their SQL twins and compare: python -m suite.check SF_DIR [NAME ...]"""

import glob
import os
import sys
import time

import duckdb

from rateflow.session import local_session
from suite import oracles, queries


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).rsplit(".", 1)[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return ("num", round(v + 0.0, 9))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", float(v))
    return (type(v).__name__, str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir, name):
    """None when equal, else a description of the difference."""
    started = time.time()
    df = queries.ALL[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    if name not in oracles.ALL:
        return took, len(got), "rows only"
    cursor = con.execute(oracles.ALL[name])
    wanted_names = [c[0] for c in cursor.description]
    wanted = cursor.fetchall()
    if sorted(df.columns) != sorted(wanted_names):
        return took, len(got), f"columns {sorted(df.columns)} vs {sorted(wanted_names)}"
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    duck = {c[0]: str(c[1]) for c in cursor.description}
    odd = [(f.name, f.dataType.simpleString(), duck[f.name]) for f in df.schema.fields
           if types.get(f.dataType.simpleString()) != duck[f.name]]
    a, b = rows_of(df.columns, got), rows_of(wanted_names, wanted)
    if a != b:
        left = [r for r in a if r not in set(b)][:2]
        right = [r for r in b if r not in set(a)][:2]
        return took, len(got), f"DIFFERS rows {len(a)} vs {len(b)}\n   spark {left}\n   sql   {right}"
    return took, len(got), f"equal, types {odd}" if odd else None


def main(sf_dir, names):
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(queries.ALL):
        try:
            took, n, problem = compare(spark, con, sf_dir, name)
        except Exception as e:
            took, n, problem = 0, 0, f"FAILED {str(e)[:500]}"
        bad += problem is not None and problem != "rows only"
        print(f"{name:26s} {n:7d} {took:6.2f}s  {problem or 'ok'}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
