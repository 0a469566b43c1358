"""Run registered queries next to their SQL twins.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "date": "DATE",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def differences(spark, con, sf: str, query, oracle: str) -> list[str]:
    df = query(spark, sf)
    names = sorted(df.columns)
    ours = Counter(map(tuple, df.select(*names).collect()))
    columns = ", ".join(f'"{n}"' for n in names)
    twin = f"SELECT {columns} FROM ({oracle}) twin"
    theirs = Counter(con.execute(twin).fetchall())
    found = []
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle}").fetchall()}
    if sorted(described) != names:
        found.append(f"columns {names} / {sorted(described)}")
    for name, kind in df.dtypes:
        expected = TYPES.get(kind, kind.upper())
        if described.get(name, "").replace(" ", "") != expected:
            found.append(f"type of {name}: {kind} / {described.get(name)}")
    if ours != theirs:
        found.append(
            f"rows {ours.total()} / {theirs.total()},"
            f" only ours {list((ours - theirs).items())[:2]},"
            f" only theirs {list((theirs - ours).items())[:2]}"
        )
    if not ours:
        found.append("no rows")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidelog.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(args.sf), 0
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        begin, twins = time.time(), oracle_sql()
        try:
            if name not in twins:
                rows = query(spark, args.sf).count()
                print(f"--- {name} {time.time() - begin:.1f}s no SQL twin; {rows} rows", flush=True)
                continue
            found = differences(spark, con, args.sf, query, twins[name])
        except Exception as e:  # report every query, not only the first failure
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - begin:.1f}s", *found, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
