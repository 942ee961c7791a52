"""Compare queries with their SQL: ``python -m checks.run [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

from checks.catalog import QUERIES, SQL
from checks.compare import differences, duck
from readframe.session import session


def main(sf_dir: str, names: list[str]) -> int:
    spark = session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problem = differences(df, con, SQL[name])
                verdict = "ok" if problem is None else f"DIFFERENT {problem}"
            else:
                verdict = f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:900]}"
        bad += not verdict.startswith(("ok", "rows"))
        print(f"{name:26s} {time.time() - began:6.2f}s {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    sys.exit(1 if main(sf, args) else 0)
