"""Task failures and retries: the skew-safe scan and the admission fold give
the same answer when the first attempt of half the tasks fails, and run
when executors cannot import the package."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, Window, functions as F
    from tessera.operators.scan import keyed_scan
    from tessera.operators.admission import sliding_admission

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("long")
    def flaky(x):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return x

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("k"),
                     "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("value")).repartition(8)
    bad = base.withColumn("value", flaky("value"))
    got = keyed_scan(bad, ["k"], [F.col("ts"), F.col("event_id")], "value", lags=2, chunk_rows=40)
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    want = base.select("*", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run_sum"),
                       F.lag("value", 2).over(w).alias("lag2"))
    cols = ["k", "event_id", "run_sum", "lag2"]
    a = sorted(map(tuple, got.select(*cols).collect()))
    b = sorted(map(tuple, want.select(*cols).collect()))
    assert a == b, "scan differs after retries"

    t = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).cast("double")
    adm_bad = sliding_admission(bad.withColumn("t", flaky(t.cast("long")).cast("double")), "k", "t", "event_id", 2, 3600)
    adm_ok = sliding_admission(base.withColumn("t", t), "k", "t", "event_id", 2, 3600)
    assert sorted(map(tuple, adm_bad.collect())) == sorted(map(tuple, adm_ok.collect())), "admission differs"
    print("RETRIES-OK")
""")


def test_results_survive_task_retries(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT.format(root=ROOT))
    # run from a folder where the package is not importable: executors must
    # receive the Python they run by value
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=900, cwd=tmp_path)
    assert "RETRIES-OK" in out.stdout, out.stderr[-3000:]
