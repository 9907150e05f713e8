"""Run queries against the oracle and print times: ``python tests/check_all.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from oracle_check import connect, differences  # noqa: E402


def main(scale: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="review-signals-check-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{scale}"
    connection, oracle = connect(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            result = run(spark, sf_dir)
            if name in oracle:
                problems = differences(result, connection, oracle[name])
            else:
                problems = [] if result.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - a report over all queries, each failure is shown
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
            if names:
                traceback.print_exc()
        failed += bool(problems)
        verdict = "ok  " if not problems else "FAIL"
        print(f"{verdict} {name:28s} {time.time() - started:6.2f}s {'' if name in oracle else '(rows only)'}", *problems,
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*(sys.argv[1:] or ["0.01"])))
