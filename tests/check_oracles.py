"""Compare registered queries with their SQL: ``python tests/check_oracles.py [dir] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry
from tests.support import connect, difference, session


def main(sf_dir: str, wanted: list[str]) -> int:
    spark, db = session(), connect(sf_dir)
    oracle = spark_entry.oracle_sql()
    bad = 0
    for name, query in spark_entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - started
            if name not in oracle:
                print(f"{name:32} {took:6.2f}s {len(got):7} rows, no SQL")
                continue
            problem = difference(got, db.sql(oracle[name]).df())
        except (duckdb.Error, Exception) as error:
            took, problem, got = time.time() - started, f"{type(error).__name__}: {str(error)[:900]}", []
        bad += problem is not None
        print(f"{name:32} {took:6.2f}s {len(got):7} rows {problem or 'ok'}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]) > 0)
