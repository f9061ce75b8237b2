"""Compare every registered query with its SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    sql = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = oracle.differences(run(spark, sf), con, sql[name])
            else:
                n = len(run(spark, sf).collect())
                problem = None if n else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
