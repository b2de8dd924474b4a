"""Streaming forms equal their batch forms over several micro-batches."""

import os
import random
import tempfile
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tessera.functions.dates import epoch_seconds, tumbling_index
from tessera.operators import changelog as kv
from tessera.operators.admission import sliding_admission
from tessera.operators.joins import band_match
from tessera.plans import pnl
from tessera.streaming import rules

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def event_dir(spark):
    """The sf0.001 events split into one parquet folder per day, written in
    day order so the file source replays them in event-time order."""
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, d in enumerate(days):
        ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(os.path.join(root, "in", f"day={i:03d}"))
    return root, ev.schema


def stream_of(spark, root, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(os.path.join(root, "in")))


def run_to_end(df, root, name, mode="append"):
    got = []

    def sink(batch, _bid):
        got.extend(map(tuple, batch.collect()))

    q = (df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", os.path.join(root, "ckpt", name)).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.lastProgress is not None
    return got


def test_admission_stream_equals_batch(spark, event_dir):
    root, schema = event_dir
    s = stream_of(spark, root, schema).withColumn("t", epoch_seconds(F.col("ts")))
    out = rules.admission_stream(s, "user_id", "t", "event_id", 2, 86400)
    got = sorted(run_to_end(out, root, "admission"))
    b = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("t", epoch_seconds(F.col("ts")))
    want = sorted(map(tuple, sliding_admission(b, "user_id", "t", "event_id", 2, 86400).collect()))
    assert len(got) == len(want) and got == want


def test_admission_stream_with_state_timeout(spark, event_dir):
    root, schema = event_dir
    s = stream_of(spark, root, schema).withColumn("t", epoch_seconds(F.col("ts"))) \
        .withColumn("et", F.col("ts").cast("timestamp"))
    out = rules.admission_stream(s, "user_id", "t", "event_id", 2, 86400, event_time="et", delay="1 day")
    got = sorted(run_to_end(out, root, "admission_timeout"))
    b = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("t", epoch_seconds(F.col("ts")))
    want = sorted(map(tuple, sliding_admission(b, "user_id", "t", "event_id", 2, 86400).collect()))
    assert got == want


def test_drift_match_stream_equals_batch(spark, event_dir):
    root, schema = event_dir

    def sides(df):
        base = df.select("event_id", "user_id", "event_type", "ts",
                         (F.get_json_object("props", "$.k").cast("bigint") % 10).alias("code"),
                         tumbling_index(epoch_seconds(F.col("ts")), 86400).alias("w"))
        i = base.where("event_type = 'signup'").select(F.col("event_id").alias("issue_id"), "user_id", "code",
                                                      F.col("ts").cast("timestamp").alias("issue_ts"),
                                                      F.col("w").alias("issue_window"))
        a = base.where("event_type = 'purchase'").select(F.col("event_id").alias("attempt_id"), "user_id", "code",
                                                        F.col("ts").cast("timestamp").alias("attempt_ts"),
                                                        F.col("w").alias("attempt_window"))
        return i, a

    si, sa = sides(stream_of(spark, root, schema))
    got = sorted(run_to_end(rules.drift_match_stream(si, sa, 86400, 1, "3 days"), root, "drift"))
    bi, ba = sides(spark.read.parquet(f"{SMALL}/events.parquet"))
    want = sorted(map(tuple, band_match(bi, ba.drop("attempt_ts"), ["user_id", "code"], "issue_window",
                                        "attempt_window", 1)
                      .select("issue_id", "attempt_id", "user_id", "code", "issue_window", "attempt_window")
                      .collect()))
    assert got == want


def test_changelog_stream_equals_batch(spark, event_dir):
    root, schema = event_dir
    state_dir = os.path.join(root, "kv")

    def to_log(df):
        is_del = F.col("event_type") == "error"
        return df.select(F.col("event_id").alias("seq"), F.concat(F.lit("user:"), "user_id").alias("key"),
                         F.when(is_del, "DELETE").otherwise("SET").alias("flag"),
                         F.when(is_del, F.lit(None)).otherwise(F.col("props")).alias("value"))

    q = (to_log(stream_of(spark, root, schema)).writeStream.foreachBatch(rules.changelog_sink(state_dir, 30))
         .option("checkpointLocation", os.path.join(root, "ckpt", "kv")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    batches = {f: {int(n.split("=")[1]) for n in os.listdir(os.path.join(state_dir, f)) if n.startswith("batch=")}
               for f in ("delta", "base")}
    assert len(batches["delta"]) > 3 and 0 < len(batches["base"]) < len(batches["delta"])
    got = sorted(map(tuple, rules.live_state(rules.changelog_state(spark, state_dir)).select("key", "seq", "value").collect()))
    want = sorted(map(tuple, kv.current_state(to_log(spark.read.parquet(f"{SMALL}/events.parquet"))).collect()))
    assert got == want


def test_running_pnl_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="tessera-pnl-")
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    trades = pnl.trades_from_lineitem(li)
    for flag in ("A", "N", "R"):
        trades.where(F.col("country") == flag).write.parquet(os.path.join(root, "in", f"part={flag}"))
    s = (spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", "true")
         .parquet(os.path.join(root, "in")))
    latest = {}

    def sink(batch, _bid):
        for r in batch.collect():
            latest[(r.trade_date, r.trader_id)] = r.pnl

    q = (rules.running_pnl(s, "10000 days", asset_class="O").writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    want = {(r.trade_date, r.trader_id): r.pnl
            for r in pnl.daily_trader_pnl(pnl.compute_pnl(pnl.filter_trades(trades, asset_class="O"))).collect()}
    assert latest == want


def test_csv_mean_stream(spark):
    root = tempfile.mkdtemp(prefix="tessera-csv-")
    os.makedirs(os.path.join(root, "in"))
    with open(os.path.join(root, "in", "readings.csv"), "w") as f:
        f.write("inner,outer\n4.5,1.0\n7.25,0.5\n-2.0,3.0\n")
    got = run_to_end(rules.csv_column_mean(spark, os.path.join(root, "in"), "inner double, outer double", "inner"),
                     root, "csv", mode="complete")
    assert abs(got[-1][0] - 3.25) < 1e-9


def test_changelog_sink_needs_its_earlier_snapshot(spark):
    state_dir = tempfile.mkdtemp(prefix="tessera-kv-")
    handle = rules.changelog_sink(state_dir)
    cols = "seq long, key string, flag string, value string"
    with pytest.raises(RuntimeError):
        handle(spark.createDataFrame([(1, "k", "SET", "{}")], cols), 5)
    handle(spark.createDataFrame([(4, "k", "SET", "4"), (9, "gone", "DELETE", None)], cols), 0)
    handle(spark.createDataFrame([(3, "k", "SET", "3"), (8, "gone", "SET", "8"), (6, "new", "SET", "6")], cols), 1)
    state = rules.live_state(rules.changelog_state(spark, state_dir))
    assert sorted((r.key, r.seq, r.value) for r in state.collect()) == [("k", 4, "4"), ("new", 6, "6")]


def test_changelog_batches_write_their_changes_only(spark):
    rng = random.Random(2)
    state_dir = tempfile.mkdtemp(prefix="tessera-kv-")
    handle, cols, log, seq = rules.changelog_sink(state_dir, 200), "seq long, key string, flag string, value string", [], 0
    size = lambda folder: spark.read.parquet(os.path.join(state_dir, folder)).count()
    for batch in range(8):
        rows = []
        for _ in range(400 if batch == 0 else 60):
            seq += 1
            rows.append((seq, f"k{rng.randint(0, 900)}", *rng.choice([("SET", str(seq)), ("SET", str(seq)), ("DELETE", None)])))
        rng.shuffle(rows)
        log += rows
        frame = spark.createDataFrame(rows, cols)
        handle(frame, batch)
        assert size(f"delta/batch={batch}") == len({r[1] for r in rows})
        want = sorted(map(tuple, kv.current_state(spark.createDataFrame(log, cols)).collect()))
        for _ in range(2):  # the same after the batch is run again
            got = rules.live_state(rules.changelog_state(spark, state_dir)).select("key", "seq", "value").collect()
            assert sorted(map(tuple, got)) == want
            handle(frame, batch)
    snapshots = sorted(os.listdir(os.path.join(state_dir, "base")))
    assert 2 <= len(snapshots) <= 4
    old = rules.live_state(rules.changelog_state(spark, state_dir, 3)).select("key", "seq", "value").collect()
    assert sorted(map(tuple, old)) == sorted(map(tuple, kv.current_state(spark.createDataFrame(log[:580], cols)).collect()))


def test_missing_rates_of_a_joined_append(spark):
    root = tempfile.mkdtemp(prefix="tessera-join-")
    rng, want = random.Random(3), []
    cols = "id int, cur string"
    for n in range(4):
        rows = [(i, rng.choice(["EUR", "USD", "???", None])) for i in range(10 * n + 5)]
        want.append((len(rows), sum(c not in ("EUR", "USD") for _, c in rows)))
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(os.path.join(root, "in", f"part={n}"))
    lookup = spark.createDataFrame([("EUR", 1.1), ("USD", 1.0)], "cur string, rate double")
    rates = rules.BatchRates("joined")
    spark.streams.addListener(rates)
    try:
        def stream():
            return (spark.readStream.schema(cols).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
                    .parquet(os.path.join(root, "in")))

        q = rules.write_joined(stream(), lookup, ["cur"], os.path.join(root, "out"), os.path.join(root, "ckpt"), rates)
        q.awaitTermination(300)
        for _ in range(100):  # the listener runs beside the query
            if len(rates.batches) == 4:
                break
            time.sleep(0.1)
        assert sorted(rates.batches.values()) == sorted(want)
        out = spark.read.parquet(os.path.join(root, "out"))
        assert (out.count(), out.where("not _matched and rate is null").count()) == tuple(map(sum, zip(*want)))
        twice = lookup.unionByName(lookup.where("cur = 'EUR'"))
        q = rules.write_joined(stream(), twice, ["cur"], os.path.join(root, "out2"), os.path.join(root, "ckpt2"), rates)
        with pytest.raises(StreamingQueryException, match="several of .*EUR"):
            q.awaitTermination(300)
    finally:
        spark.streams.removeListener(rates)
