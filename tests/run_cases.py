"""Check catalog queries from the command line: run_cases.py [sf_dir] [key prefix ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from panelwright.catalog import CASES
from panelwright.session import local_session
from tests.compare import connect, mismatch

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(sf)
    bad = 0
    for key, c in CASES.items():
        if wanted and not any(key == w or key.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = c.query(spark, sf)
            result = mismatch(df, con, c.sql) if c.sql else (None if df.collect() else "no rows")
        except Exception as e:  # report and go on
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None
        print(f"{'FAIL' if result else 'ok  '} {key:32s} {time.time() - t:6.2f}s {'' if c.sql else '(rows only) '}{result or ''}", flush=True)
    print(f"{bad} failed")
