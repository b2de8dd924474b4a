"""Sliding-window admission (rate limiting) as an ordered fold per key.

The rule: an event is admitted when fewer than ``limit`` admitted events lie
in the last ``window`` seconds, an event exactly ``window`` old included;
blocked events are not counted. So the next event admitted is the first one
after the last admitted that lies more than ``window`` after the
``limit``-th last admitted: it is found by binary search over the sorted
times, and blocked events are never visited. What is left of the limit, and
the whole seconds until the oldest admitted event leaves the window, follow
as array expressions. Times are integer microseconds.

Whether an event is admitted depends on earlier decisions, so the fold is
sequential within a key's timeline. But when a key's previous event is more
than ``window`` seconds older, no admitted event is in the window: the
timeline splits there into independent segments. The batch form finds those
idle gaps with two skew-safe scans (previous time, then a running count of
gap starts), hash-partitions by (key, segment), sorts inside partitions and
folds Arrow batches with ``mapInPandas``; what is carried between batches is
at most ``limit`` times, so memory stays bounded. A hot key is spread over as
many tasks as it has idle gaps.

A segment with more than ``slice_rows`` events (a key that is never idle) is
cut into slices that are folded at the same time, each from a guess of the
admitted times that reach into it: none at first, then what the slice before
it left. A round folds anew only the slices whose guess has changed, and ends
when none has; then every guess is what its predecessor left, so by induction
from the first slice all are right. Two runs of decisions mostly meet after
some events, and few rounds are needed. Where they do not meet, later rounds
fold only the first changed slice of a segment, so that no more events are
folded than ``SPECULATED`` + 2 times all, however the decisions depend on one
another. A round returns one row per slice; only the last pass writes
decisions. The streaming form uses the same ``admit``.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .scan import BROADCAST_CHUNKS, CHUNK_ROWS, chunked, keyed_scan, large_keys

#: Rounds in which all changed slices are folded; after them, the first of each segment.
SPECULATED = 4
#: What names a slice; ``name`` is the key, empty where it is NULL.
SLICE = ["nokey", "name", "seg", "slice"]

OUT_SCHEMA = "key string, ts double, id long, allowed boolean, remaining int, retry_after long"


def micros(seconds) -> np.ndarray:
    return np.round(np.asarray(seconds, np.float64) * 1e6).astype(np.int64)


def admit(times: np.ndarray, held: np.ndarray, limit: int, window: int):
    """Fold sorted ``times`` (microseconds) after the admitted times ``held``.

    Returns (allowed, remaining, retry_after seconds, the last ``limit``
    admitted times)."""
    admitted, chosen, nxt = held.tolist(), [], 0
    while nxt < len(times):
        if limit <= 0:
            break
        if len(admitted) >= limit:
            nxt = max(nxt, int(np.searchsorted(times, admitted[-limit] + window, "right")))
            if nxt >= len(times):
                break
        chosen.append(nxt)
        admitted.append(int(times[nxt]))
        nxt += 1
    allowed = np.zeros(len(times), bool)
    allowed[chosen] = True
    admitted = np.array(admitted, np.int64)
    before = len(held) + np.cumsum(allowed) - allowed
    gone = np.searchsorted(admitted, times - window, "left")
    inside = before - np.minimum(gone, before)
    remaining = np.where(allowed, limit - inside - 1, 0).astype(np.int32)
    oldest = admitted[np.minimum(gone, max(0, len(admitted) - 1))] if len(admitted) else times
    retry = np.where(allowed, 0, (oldest - (times - window)) // 1_000_000 + 1)
    return allowed, remaining, retry, admitted[-limit:] if limit > 0 else admitted[:0]


def fold_sorted(batches: Iterator[pd.DataFrame], limit: int, window: float) -> Iterator[pd.DataFrame]:
    """Fold rows already sorted by (key, segment, ts, id) in the partition;
    nothing is carried over to a new (key, segment)."""
    last, held, none = None, None, np.zeros(0, np.int64)
    span = int(micros(window))
    for pdf in batches:
        if not len(pdf):
            continue
        keys = pdf["key"].fillna("").to_numpy(), pdf["key"].isna().to_numpy(), pdf["seg"].to_numpy()
        fresh = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        starts = np.flatnonzero(fresh).tolist() + [len(pdf)]
        times = micros(pdf["ts"])
        parts = []
        for a, b in zip(starts[:-1], starts[1:]):
            now = tuple(k[a] for k in keys)
            *out, held = admit(times[a:b], held if now == last else none, limit, span)
            parts.append(out)
            last = now
        allowed, remaining, retry = (np.concatenate(c) for c in zip(*parts))
        yield pd.DataFrame({"key": pdf["key"], "ts": pdf["ts"], "id": pdf["id"], "allowed": allowed,
                            "remaining": remaining, "retry_after": retry})


def idle_segments(events: DataFrame, window: float) -> DataFrame:
    """Add ``seg``: the number of idle gaps (previous event of the key more
    than ``window`` seconds earlier) up to each event. Both steps are
    skew-safe scans, so a hot key is never gathered into one task here."""
    prev = keyed_scan(events, ["key"], [F.col("ts"), F.col("id")], "ts", lags=1, running=False, prefix="_p_")
    gap = F.rint(F.col("ts") * 1e6) - F.rint(F.col("_p_lag1") * 1e6)  # whole microseconds, as in the fold
    starts = prev.select("key", "ts", "id", F.coalesce(gap > round(window * 1e6), F.lit(True)).cast("int").alias("_start"))
    seg = keyed_scan(starts, ["key"], [F.col("ts"), F.col("id")], "_start", prefix="_s_")
    return seg.select("key", "ts", "id", F.col("_s_run_sum").cast("long").alias("seg"))


def _fold_slices(rows: DataFrame, states: DataFrame, limit: int, window: float, decide: bool) -> DataFrame:
    """Fold each slice after its ``held`` times: its decisions, or one row with the admitted times it leaves."""
    span = int(micros(window))

    def fold(events: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if decide:
            events = events.sort_values(["ts", "id"], kind="mergesort")
        held = np.asarray(state["held"].iloc[0], np.int64)
        times = micros(events["ts"]) if decide else np.sort(micros(events["ts"]))
        allowed, remaining, retry, left = admit(times, held, limit, span)
        if decide:
            return pd.DataFrame({"key": events["key"], "ts": events["ts"], "id": events["id"], "allowed": allowed,
                                 "remaining": remaining, "retry_after": retry})
        return pd.DataFrame({**{c: [state[f"of_{c}"].iloc[0]] for c in SLICE}, "fresh": [left.tolist()]})

    schema = OUT_SCHEMA if decide else "nokey boolean, name string, seg long, slice int, fresh array<long>"
    columns = SLICE + (["key", "ts", "id"] if decide else ["ts"])
    arriving = states.select(*[F.col(c).alias(f"of_{c}") for c in SLICE], "held").groupBy(*[f"of_{c}" for c in SLICE])
    return rows.select(*columns).groupBy(*SLICE).cogroup(arriving).applyInPandas(fold, schema)


def settle(rows: DataFrame, limit: int, window: float) -> tuple[DataFrame, int]:
    """The admitted times that reach into each slice (``held``) and the rounds it took to settle them."""
    span = int(micros(window))
    none = F.array().cast("array<long>")
    segment = Window.partitionBy("nokey", "name", "seg").orderBy("slice")
    states = cut_lineage(rows.groupBy(*SLICE).agg(F.rint(F.min("ts") * 1e6).cast("long").alias("first"), F.count(F.lit(1)).alias("n"))
                         .select(*SLICE, "first", none.alias("held"), F.lit(None).cast("array<long>").alias("left"),
                                 F.lit(True).alias("due")))
    slices = due = states.count()
    rounds = 0
    while due:
        rounds += 1
        again = states.where("due")
        own = again.select(*SLICE)
        if due < slices:
            rows_due = rows.join(F.broadcast(own) if due <= BROADCAST_CHUNKS else own, SLICE, "left_semi")
        else:
            rows_due = rows
        folded = states.join(_fold_slices(rows_due, again, limit, window, False), SLICE, "left") \
            .withColumn("left", F.coalesce("fresh", "left"))
        # of what the slice before left, the times that are still in the window at this slice's first event
        reach = F.filter(F.coalesce(F.lag("left").over(segment), none), lambda t: t >= F.col("first") - span)
        changed = folded.withColumn("arriving", reach).withColumn("due", F.col("arriving") != F.col("held"))
        if rounds >= SPECULATED:
            before = F.coalesce(F.max("due").over(segment.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
            changed = changed.withColumn("due", F.col("due") & ~before)
        states = cut_lineage(changed.select(*SLICE, "first", F.when(F.col("due"), F.col("arriving")).otherwise(F.col("held")).alias("held"),
                                            "left", "due"))
        due = states.where("due").count()
    return states, rounds


def slice_segments(hot: DataFrame, slice_rows: int) -> DataFrame | None:
    """The rows of long segments with the columns of ``SLICE``, those of others with a NULL slice; None where none is long."""
    cut = chunked(hot, ["key", "seg"], [F.col("ts"), F.col("id")], slice_rows)
    return None if cut is None else cut.select("key", "ts", "id", F.col("key").isNull().alias("nokey"),
                                               F.coalesce("key", F.lit("")).alias("name"), "seg", F.col("_chunk").alias("slice"))


def sliding_admission(df: DataFrame, key: str, ts_seconds: str, event_id: str, limit: int,
                      window: float, partitions: int | None = None, split_idle: bool = True,
                      slice_rows: int = CHUNK_ROWS) -> DataFrame:
    """Columns: key, ts, id, allowed, remaining, retry_after.
    ``split_idle`` cuts each key's timeline at idle gaps, and what is still
    longer than ``slice_rows`` into slices (both exact, see module doc), so
    hot keys fold in parallel."""
    cols = df.select(F.col(key).cast("string").alias("key"), F.col(ts_seconds).cast("double").alias("ts"),
                     F.col(event_id).cast("long").alias("id"))

    def plain(rows: DataFrame) -> DataFrame:
        # no fixed count unless asked: AQE may then merge small partitions
        parted = rows.repartition(partitions, "key", "seg") if partitions else rows.repartition("key", "seg")
        return parted.sortWithinPartitions("key", "seg", "ts", "id").mapInPandas(
            lambda it: fold_sorted(it, limit, window), OUT_SCHEMA)

    if not split_idle:
        return plain(cols.withColumn("seg", F.lit(0).cast("long")))
    large = cut_lineage(large_keys(cols, ["key"], slice_rows).select("_k"))
    keys = large.count()
    segments = idle_segments(cols, window)
    if not keys:
        return plain(segments)
    # only the rows of large keys are written, since each round reads them
    large = F.broadcast(large) if keys <= BROADCAST_CHUNKS else large
    packed = segments.withColumn("_k", F.struct(F.col("key").alias("c0")))
    hot = cut_lineage(packed.join(large, "_k", "left_semi").select("key", "ts", "id", "seg"))
    rest = packed.join(large, "_k", "left_anti").select("key", "ts", "id", "seg")
    sliced = slice_segments(hot, slice_rows)
    if sliced is None:
        return plain(rest.unionByName(hot))
    long = sliced.where(F.col("slice").isNotNull())
    states, _ = settle(long, limit, window)
    rest = rest.unionByName(sliced.where(F.col("slice").isNull()).select("key", "ts", "id", "seg"))
    return plain(rest).unionByName(_fold_slices(long, states, limit, window, True))
