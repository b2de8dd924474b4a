"""Ordered-series operators per key, all built on the skew-safe scan."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .scan import CHUNK_ROWS, keyed_scan, large_keys


def max_drawdown(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """min over rows of (v - running max) / running max, per key."""
    s = keyed_scan(df, keys, order, value)
    dd = F.try_divide(F.col(value) - F.col("run_max"), F.col("run_max"))  # NULL, not an error, at 0
    return s.groupBy(*keys).agg(F.min(dd).alias("max_drawdown"))


def best_window_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str,
                    k: int) -> DataFrame:
    """Largest sum of ``k`` consecutive values per key (NULL when the key has
    fewer than ``k`` rows)."""
    s = keyed_scan(df, keys, order, value, lags=k - 1, running=False)
    total = F.col(value)
    for j in range(1, k):
        total = total + F.col(f"lag{j}")
    full = F.col("rn") >= k
    return s.groupBy(*keys).agg(F.max(F.when(full, total)).alias("max_k_sum"))


def longest_distinct_run(df: DataFrame, keys: Sequence[str], order: Sequence[Column], item: str,
                         chunk_rows: int | None = None) -> DataFrame:
    """Length of the longest run of consecutive rows with no repeated ``item``.

    The run ending at row r starts after the last earlier position of any item seen again up to r (a running max). Where
    no key is large, position, last position and running max are windows over one shuffle. The scans of large keys build
    on one another, so the rows of these keys alone are kept between them."""
    def longest(rows: DataFrame, start: Column) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max(F.col("rn") - start + 1).cast("bigint").alias("longest_run"))

    def chained(rows: DataFrame) -> DataFrame:
        pos = cut_lineage(keyed_scan(rows, keys, order, chunk_rows=chunk_rows).select(*keys, item, "rn"))
        again = cut_lineage(keyed_scan(pos, [*keys, item], [F.col("rn")], "rn", lags=1, running=False, prefix="_i_", chunk_rows=chunk_rows)
                     .select(*keys, "rn", F.coalesce(F.col("_i_lag1") + 1, F.lit(1)).alias("_start")))
        return longest(keyed_scan(again, keys, [F.col("rn")], "_start", prefix="_s_", chunk_rows=chunk_rows), F.col("_s_run_max"))

    def plain(rows: DataFrame) -> DataFrame:
        in_order = Window.partitionBy(*keys).orderBy(*order)
        pos = rows.select(*keys, F.col(item).alias("_item"), *order, F.row_number().over(in_order).cast("bigint").alias("rn"))
        last = F.lag("rn").over(Window.partitionBy(*keys, "_item").orderBy("rn"))
        start = F.max(F.coalesce(F.col("_last") + 1, F.lit(1))).over(Window.partitionBy(*keys).orderBy("rn"))
        return longest(pos.withColumn("_last", last).withColumn("_start", start), F.col("_start"))

    large = large_keys(df, keys, chunk_rows or CHUNK_ROWS)
    if large.isEmpty():
        return plain(df)
    known = cut_lineage(large.select("_k"))
    own = df.withColumn("_k", F.struct(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keys)]))
    small = plain(own.join(known, "_k", "left_anti").drop("_k"))
    return small.unionByName(chained(own.join(known, "_k", "left_semi").drop("_k")))


def change_points(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """Rows kept after dropping consecutive repeats (NULL-safe), per key."""
    s = keyed_scan(df, keys, order, value, lags=1, running=False)
    kept = (F.col("rn") == 1) | ~F.col(value).eqNullSafe(F.col("lag1"))
    return s.groupBy(*keys).agg(F.count_if(kept).alias("n_kept"))


def underwater_depth(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """sum over rows of max(0, min(max up to here, max from here on) - v);
    both maxima come from one skew-safe pass (running and suffix)."""
    both = keyed_scan(df, keys, order, value, suffix=True)
    depth = F.greatest(F.lit(0), F.least("run_max", "suf_max") - F.col(value))
    return both.groupBy(*keys).agg(F.sum(depth).cast("bigint").alias("depth"))
