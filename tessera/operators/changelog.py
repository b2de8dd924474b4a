"""Change-log (key -> JSON value) state as set operations.

Log rows: ``(seq, key, flag SET|DELETE, value JSON)``. State = last write
per key with tombstones removed. ``max_by`` is a partial aggregate, so a key
written a billion times is reduced map-side before the shuffle.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import field_present, field_token, literal_token, record_checksum
from ..session import checkpoint_dir

SET, DELETE = "SET", "DELETE"
FLAGS = (SET, DELETE)


def current_state(log: DataFrame) -> DataFrame:
    last = log.groupBy("key").agg(F.max_by(F.struct("seq", "flag", "value"), F.col("seq")).alias("_r"))
    return last.where(F.col("_r.flag") == SET).select("key", F.col("_r.seq").alias("seq"),
                                                      F.col("_r.value").alias("value"))


def point_get(state: DataFrame, requested: DataFrame, default: str = "{}") -> DataFrame:
    """``requested`` has a ``key`` column; returns key, value (or default), exists."""
    s = state.select("key", "value", F.lit(True).alias("_hit"))
    j = requested.select("key").join(s, "key", "left")
    return j.select("key", F.coalesce("value", F.lit(default)).alias("value"),
                    F.coalesce("_hit", F.lit(False)).alias("exists"))


def prefix_scan(state: DataFrame, prefix: str) -> DataFrame:
    return state.where(F.col("key").startswith(prefix)).orderBy("key")


def range_scan(state: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("key") >= start)
    if end is not None:
        cond = cond & (F.col("key") <= end)
    return state.where(cond).orderBy("key")


def field_query(state: DataFrame, field: str, json_value: str, indexed: Sequence[str]) -> DataFrame:
    """Keys whose value has ``field`` equal (type-aware) to the JSON literal."""
    if field not in indexed:
        raise ValueError(f"Field {field!r} is not indexed. Indexed fields: {list(indexed)}")
    return state.where(field_token(F.col("value"), field) == literal_token(json_value)).orderBy("key")


def stats(log: DataFrame, state: DataFrame, indexed: Sequence[str]) -> DataFrame:
    has_field = F.lit(False)
    for f in indexed:
        has_field = has_field | F.coalesce(field_present(F.col("value"), f), F.lit(False))
    st = state.agg(F.count(F.lit(1)).alias("live_keys"), F.count_if(has_field).alias("indexed_keys"))
    return st.select("live_keys", log.agg(F.count(F.lit(1))).scalar().alias("log_rows"), "indexed_keys")


def apply_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Set-based insert/update/delete: base (key, seq, value[, deleted])
    full-outer joined with the last change per key. The larger seq wins, so
    an older change that arrives late alters nothing. Deletes drop the key;
    where ``base`` has a ``deleted`` column they stay as tombstones with
    their seq, so that a late SET cannot revive the key."""
    last = changes.groupBy("key").agg(F.max_by(F.struct("seq", "flag", "value"), F.col("seq")).alias("_c"))
    j = base.join(last, "key", "full_outer")
    newer = F.col("_c").isNotNull() & (F.col("seq").isNull() | (F.col("_c.seq") > F.col("seq")))
    gone = newer & ~F.coalesce(F.col("_c.flag") == SET, F.lit(False))
    seq = F.when(newer, F.col("_c.seq")).otherwise(F.col("seq")).alias("seq")
    value = F.when(newer, F.col("_c.value")).otherwise(F.col("value")).alias("value")
    if "deleted" not in base.columns:
        return j.where(~gone).select("key", seq, value)
    deleted = F.when(newer, gone).otherwise(F.col("deleted"))
    return j.select("key", seq, F.when(~deleted, value).alias("value"), deleted.alias("deleted"))


def compact(log: DataFrame, upto_seq: int | None = None, path: str | None = None) -> str:
    """Write the live rows (state up to ``upto_seq``) to a NEW snapshot
    folder under the shared checkpoint directory, clustered by key so that
    parquet min/max statistics prune point and range reads. Returns the path."""
    spark = log.sparkSession
    if upto_seq is not None:
        log = log.where(F.col("seq") <= upto_seq)
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/kv-snapshot-{uuid.uuid4().hex}"
    current_state(log).repartitionByRange("key").sortWithinPartitions("key").write.mode("error").parquet(path)
    return path


def read_compacted(snapshot_path: str, log: DataFrame, after_seq: int) -> DataFrame:
    """Reader switched to the snapshot; later log rows merge on top."""
    base = log.sparkSession.read.parquet(snapshot_path)
    return apply_changes(base, log.where(F.col("seq") > after_seq))


def audit(log: DataFrame) -> DataFrame:
    """Per record: recomputed checksum and the first problem found, if any
    (missing key, unknown flag, checksum mismatch when a stored one exists)."""
    crc = record_checksum(F.col("flag"), F.col("key"), F.col("value"))
    stored = F.col("checksum") if "checksum" in log.columns else crc
    status = (F.when(F.col("key").isNull() | (F.col("key") == ""), "missing_key")
               .when(~F.col("flag").isin(*FLAGS), "unknown_flag")
               .when(stored != crc, "checksum_mismatch")
               .otherwise("ok"))
    return log.select("seq", "key", crc.alias("crc"), status.alias("status"))


def assign_ids(rows: DataFrame, start_after: int, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """Auto-increment ids ``start_after + 1 ..`` in ``order`` (a total order),
    without a global window: range-partition on the order, number rows
    inside each partition, and offset each partition by the row counts of
    the partitions before it (a table with one row per partition, so its
    broadcast is bounded by the partition count). Checkpointed so the ids
    stay fixed if tasks are re-run."""
    from pyspark.sql import Window
    from ..session import cut_lineage
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(rows.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = local.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (F.lit(start_after) + F.col("_off") + F.col("_rn")).cast("bigint")) \
              .drop("_pid", "_rn", "_off")
