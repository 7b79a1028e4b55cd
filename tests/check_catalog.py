"""Run catalog queries against their SQL: python tests/check_catalog.py [folder] [query ...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = oracle.connect(folder), entry.oracle_sql(), []
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = function(spark, folder)
            problem = oracle.difference(df, connection, sqls[name]) if name in sqls else None
            note = problem or ("equal" if name in sqls else f"rows {df.count()}")
        except Exception as error:  # report and go on with the next query
            problem = note = f"{type(error).__name__}: {str(error)[:400]}"
        if problem:
            bad.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
