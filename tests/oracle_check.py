"""Run queries against their SQL counterparts: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path[:0] = [str(Path(__file__).resolve().parent.parent)]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def oracle_rows(sf_dir: str, sql: str):
    with duckdb.connect() as db:
        for name in TABLES:
            path = Path(sf_dir) / f"{name}.parquet"
            if path.exists():
                db.execute(f"create view {name} as select * from read_parquet('{path}')")
        found = db.execute(sql)
        return sorted_rows([d[0] for d in found.description], found.fetchall())


def spark_rows(frame):
    return sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from paneflow.session import local_session

    sf, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    failed = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        mine = spark_rows(query(spark, sf_dir))
        took = time.time() - began
        began = time.time()
        theirs = oracle_rows(sf_dir, oracle_sql()[name])
        same = mine == theirs
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name:26} {len(mine[1]):8} rows "
              f"{took:7.2f}s  sql {time.time() - began:6.2f}s", flush=True)
        if not same:
            print("   ", mine[0], theirs[0], len(theirs[1]))
            for left, right in zip(mine[1], theirs[1]):
                if left != right:
                    print("   ", left, "\n   ", right)
                    break
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
