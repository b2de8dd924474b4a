"""Streaming operators. Each reuses the batch transform so that a stream
fed the same rows in event-time order produces the batch result."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.admission import OUT_SCHEMA, admit, micros
from ..operators.changelog import SET
from ..operators.joins import unique_lookup
from ..plans.pnl import compute_pnl, filter_trades

STATE_SCHEMA = "admitted array<long>"


# K1 ------------------------------------------------------------ admission
def admission_stream(stream: DataFrame, key: str, ts_seconds: str, event_id: str, limit: int,
                     window: float, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Per-key state: the admitted timestamps still inside the window (at most
    ``limit``). Rows of one key inside a micro-batch are folded in (ts, id)
    order; across micro-batches the input must arrive in event-time order.

    With ``event_time`` (a timestamp column) the stream gets a watermark and
    each key's state expires once the watermark passes its last event plus
    the window, when every stored timestamp has left the window anyway, so
    state is bounded by the keys active within a window."""
    timed = event_time is not None

    def fold(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if timed and state.hasTimedOut:
            state.remove()
            return
        held = np.array(state.get[0] if state.exists else [], np.int64)
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values(["ts", "id"], kind="mergesort")
        allowed, remaining, retry, held = admit(micros(rows["ts"]), held, limit, int(micros(window)))
        state.update((held.tolist(),))
        if timed:
            state.setTimeoutTimestamp(int((float(rows["ts"].max()) + window) * 1000))
        yield pd.DataFrame({"key": rows["key"].to_numpy(), "ts": rows["ts"].to_numpy(), "id": rows["id"].to_numpy(),
                            "allowed": allowed, "remaining": remaining, "retry_after": retry})

    cols = [F.col(key).cast("string").alias("key"), F.col(ts_seconds).cast("double").alias("ts"),
            F.col(event_id).cast("long").alias("id")]
    if timed:
        prepared = stream.withWatermark(event_time, delay).select(*cols, event_time)
        timeout = GroupStateTimeout.EventTimeTimeout
    else:
        prepared = stream.select(*cols)
        timeout = GroupStateTimeout.NoTimeout
    return prepared.groupBy("key").applyInPandasWithState(fold, OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


# K2 ------------------------------------------------- arriving CSV, mean
def csv_column_mean(spark, directory: str, schema, column: str) -> DataFrame:
    s = spark.readStream.schema(schema).option("header", True).csv(directory)
    return s.agg(F.avg(column).alias(f"mean_{column}"))


# K3 ---------------------------------------------- filter and append chunks
def filter_append(stream: DataFrame, condition, path: str, checkpoint: str, trigger_once: bool = True):
    w = stream.where(condition).writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if trigger_once else w).start()


# K4 -------------------------------------- stream-static lookup join, misses
def lookup_stream(stream: DataFrame, lookup: DataFrame, keys) -> DataFrame:
    """Left join of each micro-batch to a static lookup; ``_matched`` marks hits. A key that the lookup holds twice fails
    the batch that meets it, and names the key: its rows would be written twice."""
    return stream.join(unique_lookup(lookup, keys), list(keys), "left") \
                 .withColumn("_matched", F.coalesce("_matched", F.lit(False)))


class BatchRates(StreamingQueryListener):
    """Rows written and rows without a match of every micro-batch, taken from the batches' own observed metrics."""

    def __init__(self, name: str):
        self.name, self.batches = name, {}

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and row["rows_written"]:
            self.batches[event.progress.batchId] = (row["rows_written"], row["missing"])

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def write_joined(stream: DataFrame, lookup: DataFrame, keys, path: str, checkpoint: str, rates: BatchRates,
                 trigger_once: bool = True):
    """Append the joined micro-batches to ``path``; ``rates`` learns the rows and misses of each as it is written. Its
    owner has registered it with ``spark.streams.addListener``."""
    joined = lookup_stream(stream, lookup, keys).observe(
        rates.name, F.count(F.lit(1)).alias("rows_written"), F.count_if(~F.col("_matched")).alias("missing"))
    w = joined.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if trigger_once else w).start()


# K5 ----------------------------------------------- running per-key totals
def running_pnl(trades: DataFrame, watermark: str = "2 days", **equals) -> DataFrame:
    """Streaming (day, trader) PnL totals in update mode; the watermark on the
    trade day bounds the state kept for closed days."""
    p = compute_pnl(filter_trades(trades, **equals)).withColumn("trade_ts", F.col("trade_date").cast("timestamp"))
    return p.withWatermark("trade_ts", watermark).groupBy("trade_ts", "trade_date", "trader_id") \
            .agg(F.sum("pnl").alias("pnl")).drop("trade_ts")


# K6 ------------------------------------------- change log via foreachBatch
STATE = "key string, seq long, value string, deleted boolean, batch int"


def changelog_sink(state_dir: str, least_rows: int = 10_000):
    """``foreachBatch`` function that keeps the state of a change log.

    A batch writes the last change of each of its keys to ``state_dir/delta/batch=<id>``. When the deltas since the last
    snapshot hold as many rows as that snapshot (``least_rows`` at least), they are merged into a new one under
    ``state_dir/base/batch=<id>``: over time a few rows are written per change, however large the state is. Both are
    written anew, in the same place and from earlier data only, when a batch id is run again. Deleted keys stay as
    tombstones (``deleted``), so that a late change cannot revive them; ``live_state`` leaves them out. A batch whose
    predecessor is missing raises."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id > 0 and _deltas(spark, f"{state_dir}/delta/batch={batch_id - 1}") is None:
            raise RuntimeError(f"no state before batch {batch_id} in {state_dir}")
        last = batch.groupBy("key").agg(F.max_by(F.struct("seq", "flag", "value"), F.col("seq")).alias("c"))
        gone = ~F.coalesce(F.col("c.flag") == SET, F.lit(False))
        last.select("key", "c.seq", F.when(~gone, F.col("c.value")).alias("value"), gone.alias("deleted")) \
            .write.mode("overwrite").parquet(f"{state_dir}/delta/batch={batch_id}")
        base, pending = _parts(spark, state_dir, batch_id, batch_id)
        if pending.count() >= max(least_rows, base.count() if base is not None else 0):
            _merged(base, pending).write.mode("overwrite").parquet(f"{state_dir}/base/batch={batch_id}")

    return handle


def changelog_state(spark, state_dir: str, upto: int | None = None) -> DataFrame:
    """(key, seq, value, deleted) after batch ``upto``, or after all."""
    return _merged(*_parts(spark, state_dir, upto, None if upto is None else upto + 1))


def _deltas(spark, path: str) -> DataFrame | None:
    """The rows under a folder, with their batch; None where there is no such folder."""
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException:
        return None


def _parts(spark, state_dir: str, upto: int | None, before: int | None) -> tuple[DataFrame | None, DataFrame]:
    """(newest snapshot of a batch below ``before``, the deltas after it up to ``upto``)."""
    base, since = _deltas(spark, f"{state_dir}/base"), None
    if base is not None:
        since = base.where(F.col("batch") < before if before is not None else F.lit(True)).agg(F.max("batch")).first()[0]
    pending = _deltas(spark, f"{state_dir}/delta")
    if since is not None:
        pending = pending.where(F.col("batch") > since)
    if upto is not None:
        pending = pending.where(F.col("batch") <= upto)
    return (None if since is None else base.where(F.col("batch") == since)), pending


def _merged(base: DataFrame | None, pending: DataFrame) -> DataFrame:
    """The row of the largest seq of each key; of equal ones that of the later batch."""
    rows = pending if base is None else base.unionByName(pending)
    return (rows.groupBy("key").agg(F.max_by(F.struct("seq", "value", "deleted"), F.struct("seq", "batch")).alias("r"))
            .select("key", "r.seq", "r.value", "r.deleted"))


def live_state(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(~F.col("deleted")).drop("deleted")


# K7 --------------------------------------------- stream-stream drift match
def drift_match_stream(issues: DataFrame, attempts: DataFrame, width: int, drift: int,
                       delay: str = "1 day") -> DataFrame:
    """Inner stream-stream join on (user_id, code) with the window-index band
    plus an event-time range so both sides' state is purged by watermarks.
    Inputs: issues(issue_id, user_id, code, issue_ts, issue_window),
    attempts(attempt_id, user_id, code, attempt_ts, attempt_window)."""
    i = issues.withWatermark("issue_ts", delay).alias("i")
    a = attempts.withWatermark("attempt_ts", delay).alias("a")
    span = F.expr(f"INTERVAL {(drift + 1) * width} SECONDS")
    cond = ((F.col("i.user_id") == F.col("a.user_id")) & (F.col("i.code") == F.col("a.code"))
            & (F.abs(F.col("i.issue_window") - F.col("a.attempt_window")) <= drift)
            & (F.col("a.attempt_ts") >= F.col("i.issue_ts") - span)
            & (F.col("a.attempt_ts") <= F.col("i.issue_ts") + span))
    return i.join(a, cond, "inner").select("issue_id", "attempt_id", F.col("i.user_id").alias("user_id"),
                                           F.col("i.code").alias("code"), "issue_window", "attempt_window")
