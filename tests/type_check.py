"""Compare column types of every registered query with its DuckDB oracle: python tests/type_check.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import duck_connect, type_diff  # noqa: E402

def main():
    from venuelens.session import checkpoint_dir, get_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", 4)
    checkpoint_dir(spark)
    con = duck_connect(sf_dir)
    sqls = E.registry.oracle_sql()
    bad = 0
    for name, fn in E.registry.queries().items():
        if name not in sqls:
            continue
        df = fn(spark, sf_dir)
        diff = type_diff(df.schema, con, sqls[name])
        if diff:
            bad += 1
            print(f"{name:30s} {diff}")
    print("queries with type differences:", bad)


if __name__ == "__main__":
    main()
