"""Throughput at the reference's intended input size.

Builds (once) a lineitem of COPIES x sf0.1 rows by repetition with shifted
order and supplier keys under $SCALE_DIR (default /tmp/tessera-scale), then
times the flagship and reports rows / elapsed / 1000 (k rows per second).

usage: python tools/scale_bench.py [copies]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.plans.pnl import topn_pnl_per_day  # noqa: E402
from tessera.session import get_session  # noqa: E402

SRC = "/root/testdata/sf0.1"


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 25
    root = os.environ.get("SCALE_DIR", "/tmp/tessera-scale")
    out_dir = os.path.join(root, f"x{copies}")
    spark = get_session("local[8]", app="tessera-scale", shuffle_partitions=32, extra={"spark.driver.memory": "16g"})
    li_path = os.path.join(out_dir, "lineitem.parquet")
    if not os.path.exists(li_path):
        li = spark.read.parquet(os.path.join(SRC, "lineitem.parquet"))
        big = li.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
            *[(F.col(c) + F.col("_copy") * 10_000_000).alias(c) if c in ("l_orderkey", "l_suppkey") else F.col(c)
              for c in li.columns])
        big.repartition(32).write.parquet(li_path)
    rows = spark.read.parquet(li_path).count()
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        topn_pnl_per_day(spark, out_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    best = sorted(times)[1]
    print(json.dumps({"query": "topn_pnl_per_day", "rows": rows, "median_sec": round(best, 3),
                      "krows_per_sec": round(rows / best / 1000, 1), "copies": copies}))
    spark.stop()


if __name__ == "__main__":
    main()
