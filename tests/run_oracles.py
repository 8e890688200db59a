"""Run registered queries against their oracles: python tests/run_oracles.py SF_DIR [name part…]"""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402
from docspark.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                diff = differences(df, con, oracles[name])
            else:
                diff = None if df.count() >= 0 else "no rows"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1200]}"
        took = time.time() - start
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {took:6.2f}s {name}{'' if name in oracles else ' (rows only)'}"
              f"{': ' + diff if diff else ''}", flush=True)
    print("failures:", bad)
    sys.exit(1 if bad else 0)
