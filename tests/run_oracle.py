"""Compare every registered query with its DuckDB twin (or just run it).

Usage: python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

from ontime.session import get_spark  # noqa: E402


def main() -> int:
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sql:
                ok, msg = compare(df, con, sql[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only {n}"
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
            if os.environ.get("TB"):
                traceback.print_exc()
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
