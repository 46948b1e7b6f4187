"""Run every registered query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402
from shelfcast.session import build_session  # noqa: E402
from tests.compare import connect, differences  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), spark_entry.oracle_sql(), 0
    for name, query in spark_entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problems = differences(df, con, oracle[name])
                note = f"{len(con.execute(oracle[name]).fetchall())} rows"
            else:
                problems, note = [], f"{df.count()} rows, no SQL"
        except Exception as exc:  # report and go on to the next query
            problems, note = [f"{type(exc).__name__}: {str(exc)[:600]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:26} {time.time() - begin:6.2f}s {note}", *problems,
              sep=" | " if problems else " ", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
