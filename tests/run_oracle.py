"""Run every query against its SQL: python tests/run_oracle.py [sf_dir] [key ...]"""

import os
import sys
import tempfile
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from catalog_marts.session import get_session  # noqa: E402
from tests.oracle_check import connect, spark_rows, sql_rows  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--master local[8] --driver-memory 8g pyspark-shell")
spark = get_session(partitions=8, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")})
spark.sparkContext.setLogLevel("ERROR")
con, oracle, bad = connect(sf_dir), oracle_sql(), []
for key, query in queries().items():
    if len(sys.argv) > 2 and key not in sys.argv[2:]:
        continue
    start = time.perf_counter()
    got = spark_rows(query(spark, sf_dir))
    seconds = time.perf_counter() - start
    if key not in oracle:
        print(f"    {key:32s} {len(got[1]):7d} rows {seconds:6.2f}s, no SQL", flush=True)
        continue
    want = sql_rows(con, oracle[key])
    ok = got == want
    print(f"{'ok ' if ok else 'BAD'} {key:32s} {len(got[1]):7d} rows {seconds:6.2f}s", flush=True)
    if not ok:
        bad.append(key)
        print("   columns", got[0], want[0], len(want[1]))
        diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
        for a, b in diff:
            print("   spark", a)
            print("   sql  ", b)
sys.exit(1 if bad else 0)
