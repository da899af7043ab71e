"""Run queries against their SQL: ``check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences, open_duckdb  # noqa: E402
from session import local_session  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = local_session()
    connection = open_duckdb(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in names or queries:
        start = time.time()
        result = queries[name](spark, sf_dir)
        found = differences(result, connection, oracles[name])
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:28}{time.time() - start:7.2f}s", *found, flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
