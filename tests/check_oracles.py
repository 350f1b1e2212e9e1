"""Compare every registered query with its SQL at one scale: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from compare import differences, duck  # noqa: E402

from tracklens.session import local_session  # noqa: E402
from tracklens.workload import all_queries  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = local_session(cpus="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, build in all_queries.QUERIES.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            df = build(spark, sf_dir)
            sql = all_queries.ORACLES.get(name)
            problem = differences(df, con, sql) if sql else None
            note = "ok" if sql else f"no sql, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - t0:6.2f}s  {problem or note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
