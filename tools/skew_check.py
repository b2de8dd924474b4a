"""Evidence for the hot-key design: give one user a third of all events and
compare the largest per-task shuffle input of a plain per-key window with
the skew-safe scan (read from Spark's event log in a scratch folder).

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.scan import keyed_scan  # noqa: E402
from tessera.session import get_session  # noqa: E402

PARTS = int(os.environ.get("SKEW_PARTS", "16"))


def max_task_records(log_dir: str) -> int:
    import zstandard
    best = 0
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.zstd")):
        raw = open(f, "rb").read()
        try:
            text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
        except zstandard.ZstdError:
            text = raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                best = max(best, int(m.get("Total Records Read", 0)))
    return best


def run(mode: str, sf_dir: str) -> dict:
    log_dir = tempfile.mkdtemp(prefix=f"tessera-skew-{mode}-")
    spark = get_session("local[8]", app=f"skew-{mode}", shuffle_partitions=PARTS,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    hot = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
                    "ts", "event_id", "value")
    n = hot.count()
    if mode == "plain":
        w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
        out = hot.select("*", F.sum("value").over(w).alias("run_sum"))
    else:
        out = keyed_scan(hot, ["user_id"], [F.col("ts"), F.col("event_id")], "value", chunk_rows=n // PARTS)
    out.write.format("noop").mode("overwrite").save()
    spark.stop()
    return {"mode": mode, "rows": n, "hot_key_rows": n // 3, "max_rows_one_task": max_task_records(log_dir)}


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    for m in ("plain", "scan"):
        print(json.dumps(run(m, sf)))
