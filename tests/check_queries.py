"""Run every driver query against its SQL and print what differs.

    python tests/check_queries.py FOLDER [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from compare import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from milepost.catalog import ORACLE, QUERIES  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                found = differences(df, con, ORACLE[name])
                n = "" if found else con.execute(f"SELECT count(*) FROM ({ORACLE[name]})").fetchone()[0]
            else:
                found, n = [], f"{df.count()} rows only"
        except Exception as e:
            found = ["".join(traceback.format_exception_only(e))[:1500]]
            n = ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {n} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ")
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
