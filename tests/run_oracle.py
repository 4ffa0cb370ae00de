"""``python -m tests.run_oracle [folder] [query ...]``: all queries against their SQL, with times."""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.oracle import connect, differences


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(folder), oracle_sql(), 0
    chosen = sys.argv[2:] or list(queries())
    for name in chosen:
        began = time.time()
        try:
            df = queries()[name](spark, folder)
            found = differences(df, connection, oracles[name]) if name in oracles else [] * len(df.collect())
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.2f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print("failures:", bad)
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
