"""Compare registered queries with their SQL: python tests/run_oracle.py [sf_dir] [name prefix ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tickloom.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("oracle", master="local[8]")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                diff = compare(df, con, oracles[name])
            else:
                rows = df.count()
                diff = None if rows else "no rows"
        except Exception as exc:  # noqa: BLE001
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += diff is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{bad} failures")
    spark.stop()


if __name__ == "__main__":
    main()
