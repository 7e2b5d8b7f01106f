"""Run every registered query against its DuckDB oracle.

    python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from postlake.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", extra={"spark.postlake.scanPartitions": "8"})
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        if name in sqls:
            try:
                ok, msg = compare(df, con, sqls[name])
            except Exception as e:  # noqa: BLE001
                ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        else:
            n = df.count()
            ok, msg = True, f"rows-only: {n} rows"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
