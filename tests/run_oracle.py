"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import compare, duck_connect, duck_run, type_diff  # noqa: E402

from venuelens.session import checkpoint_dir, get_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[8]", 8)
    checkpoint_dir(spark)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    stats = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols, rows = df.columns, df.collect()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            traceback.print_exc(limit=3)
            stats["error"] = stats.get("error", 0) + 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows-only  {len(rows)} rows  {ts:.2f}s")
            stats["rows-only"] = stats.get("rows-only", 0) + 1
            continue
        try:
            dcols, drows = duck_run(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCK-ERROR {str(e)[:300]}")
            stats["duck-error"] = stats.get("duck-error", 0) + 1
            continue
        st, detail = compare(cols, rows, dcols, drows)
        td = type_diff(df.schema, con, sqls[name])
        if td:
            detail = f"types {td} " + detail
            st = "typediff" if st == "exact" else st
        stats[st] = stats.get(st, 0) + 1
        print(f"{name:32s} {st:9s} {len(rows):7d} rows {ts:6.2f}s {detail[:400]}")
    print(stats)


if __name__ == "__main__":
    main()
