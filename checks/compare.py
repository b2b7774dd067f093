"""Run queries and their SQL side by side: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from corpusmill.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            got = result.collect()
        except Exception as error:
            failed += 1
            print(f"{name}: ERROR {str(error)[:500]}", flush=True)
            continue
        spent = time.time() - start
        if name not in ORACLES:
            print(f"{name}: {len(got)} rows in {spent:.1f} s, no SQL", flush=True)
            continue
        start = time.time()
        database = duckdb.connect()
        for table in TABLES:
            database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        try:
            cursor = database.execute(ORACLES[name])
            wanted, columns = cursor.fetchall(), [c[0] for c in cursor.description]
        except Exception as error:
            failed += 1
            print(f"{name}: SQL ERROR {str(error)[:500]}", flush=True)
            continue
        mine, theirs = bag(result.columns, got), bag(columns, wanted)
        same = sorted(columns) == sorted(result.columns) and mine == theirs
        failed += not same
        verdict = "equal" if same else "DIFFERENT"
        print(f"{name}: {verdict}, {len(got)} / {len(wanted)} rows, {spent:.1f} s, SQL {time.time() - start:.1f} s", flush=True)
        if not same:
            print("   only here:", [str(r)[:300] for r in list((mine - theirs))[:2]])
            print("   only SQL :", [str(r)[:300] for r in list((theirs - mine))[:2]], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
