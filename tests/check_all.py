"""All registered queries against their SQL: python tests/check_all.py [sf] [query ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from compare import differences, duck

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
only = sys.argv[2:]
sf_dir = f"/root/testdata/sf{sf}"
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf_dir)
oracle = entry.oracle_sql()
bad = 0
for name, query in entry.queries().items():
    if name not in oracle or only and name not in only:
        continue
    start = time.time()
    try:
        found = differences(query(spark, sf_dir), con, oracle[name])
    except Exception as error:
        found = [f"{type(error).__name__}: {str(error)[:1500]}"]
    bad += bool(found)
    print(f"{'FAIL' if found else 'ok  '} {name:32s} {time.time() - start:6.2f}s", *found, sep="\n       " if found else " ", flush=True)
print(f"{bad} differ")
