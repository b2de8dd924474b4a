"""Skew-safe ordered scans per key (running aggregates and lags).

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. That is right for a key of moderate size, and
only such keys go that way here. The rows of a larger key are cut into chunks that follow one another in its order:

1. Keys with more than ``chunk_rows`` rows are found by a partial count. There are at most ``rows / chunk_rows`` of them.
2. Of their rows, those whose order value hashes to 0 are a sample; every 32nd of a key's sorted sample is a cut. A row's
   chunk is the number of cuts not after it: a function of the row alone, so no task failure can change it, and equal
   order values share a chunk.
3. First pass: one summary per chunk (count, sum, max, min by partial aggregates; its last values by a group limit that
   works on the map side). A window over the summaries gives what precedes and follows each chunk.
4. Second pass: one shuffle by (key, chunk), the local windows, and a join with the carry of the chunk.

Nothing but the cuts is checkpointed; the input is read once for the counts and once for the scan, and the rows of
large keys once each for sample and summaries. Where no key is large the scan is a plain window and its one shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of a key that one task takes.
CHUNK_ROWS = 1_000_000
#: Sampled rows per chunk.
SAMPLED = 32
#: Summaries that may be broadcast; each is a key and a few values.
BROADCAST_CHUNKS = 100_000

_UNB = Window.unboundedPreceding


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _packed(columns: Sequence[Column]) -> Column:
    """One value of several; parts that are NULL are equal to each other and come first."""
    return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])


def large_keys(df: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    """(_k, _n) of the keys with more rows than ``chunk_rows``."""
    return (df.groupBy(_packed(_cols(keys)).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > chunk_rows))


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk_rows: int) -> tuple[DataFrame, int] | None:
    """(_k, _cuts ascending) of every large key and the number of all cuts; None where no key is large."""
    large = large_keys(df, keys, chunk_rows)
    found = large.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows")).first()
    if not found["keys"]:
        return None
    chunks = found["keys"] + 2 * found["rows"] // chunk_rows
    rows = df.select(_packed(_cols(keys)).alias("_k"), _packed(order).alias("_at"))
    sample = (_join(rows, large.select("_k"), ["_k"], found["keys"])
              .where(F.pmod(F.xxhash64("_at"), F.lit(max(1, chunk_rows // SAMPLED))) == 0))
    nth = F.row_number().over(Window.partitionBy("_k").orderBy("_at"))
    cuts = (sample.withColumn("_nth", nth).where(F.col("_nth") % SAMPLED == 0)
            .groupBy("_k").agg(F.array_sort(F.collect_list("_at")).alias("_cuts")))
    return cut_lineage(cuts), chunks


def _join(big: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """``small`` is broadcast when its counted rows are few."""
    return big.join(F.broadcast(small) if rows <= BROADCAST_CHUNKS else small, on, how)


def _place(cuts: Column, at: Column) -> Column:
    """How many of the ascending ``cuts`` are not after ``at``: a binary search, 0 without cuts."""
    steps = F.sequence(F.ceil(F.log2(F.size(cuts) + F.lit(1))).cast("int"), F.lit(0), F.lit(-1))
    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), lambda low, s: F.when(
        F.get(cuts, low + F.pow(F.lit(2), s).cast("int") - 1) <= at, low + F.pow(F.lit(2), s).cast("int")).otherwise(low)))


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk_rows: int | None = None) -> DataFrame | None:
    """``df`` with ``_chunk``: the place of the row's chunk in its key, NULL in keys that are not large. None where no key is."""
    found = _cuts(df, list(keys), _cols(order), chunk_rows or CHUNK_ROWS)
    if found is None:
        return None
    cuts, chunks = found
    own = df.select("*", _packed(_cols(keys)).alias("_k"), _packed(_cols(order)).alias("_at"))
    place = F.when(F.col("_cuts").isNotNull(), _place(F.col("_cuts"), F.col("_at")))
    return _join(own, cuts, ["_k"], chunks, "left").select(*df.columns, place.alias("_chunk"))


def keyed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str | None = None,
               lags: int = 0, chunk_rows: int | None = None, prefix: str = "",
               running: bool = True, suffix: bool = False) -> DataFrame:
    """Add per-key ordered-scan columns to ``df``.

    ``order`` must be a total order inside each key (add a unique id), given as columns that ascend, NULL first.
    Always added: ``{prefix}rn`` (1-based position in the key).
    With ``value``: ``{prefix}run_sum``, ``run_max``, ``run_min``,
    ``run_cnt`` (non-null count) up to and including the row, and
    ``lag1..lag{lags}`` (value ``k`` rows earlier, NULL before the start).
    ``running=False`` skips the running aggregates (any value type).
    ``suffix=True`` also adds ``suf_sum``, ``suf_max``, ``suf_min`` over the
    row and everything after it in the key, from the same pass.
    Sums are combined chunk by chunk, so for floating-point values the last
    bits may differ from a strictly sequential sum; integer and DECIMAL sums
    are exact (money is DECIMAL throughout the library).
    Rows with a NULL in a key are a key like any other.
    """
    keys, order, p = list(keys), _cols(order), prefix
    chunk_rows = chunk_rows or CHUNK_ROWS
    run, suffix = value is not None and running, value is not None and suffix
    found = _cuts(df, keys, order, chunk_rows)
    if found is None:
        return df.select("*", *_local(_cols(keys), order, value, lags, p, run, suffix))

    cuts, chunks = found
    own = df.select("*", _packed(_cols(keys)).alias("_k"), _packed(order).alias("_at"))
    tagged = _join(own, cuts, ["_k"], chunks, "left").withColumn("_chunk", _place(F.col("_cuts"), F.col("_at"))).drop("_cuts")
    cut = _join(own, cuts, ["_k"], chunks).withColumn("_chunk", _place(F.col("_cuts"), F.col("_at")))
    local = tagged.select("*", *_local([F.col("_k"), F.col("_chunk")], order, value, lags, "_l_", run, suffix))
    out = _join(local, _carry(cut, value, lags, run, suffix), ["_k", "_chunk"], chunks, "left")

    def add(before: str, own: str) -> Column:
        return F.when(F.col(before).isNull(), F.col(own)).when(F.col(own).isNull(), F.col(before)) \
                .otherwise(F.col(before) + F.col(own))

    res = [add("_c_n", "_l_rn").alias(f"{p}rn")]
    if run:
        res += [add("_c_sum", "_l_run_sum").alias(f"{p}run_sum"), F.greatest("_c_max", "_l_run_max").alias(f"{p}run_max"),
                F.least("_c_min", "_l_run_min").alias(f"{p}run_min"), add("_c_cnt", "_l_run_cnt").alias(f"{p}run_cnt")]
    if suffix:
        res += [add("_f_sum", "_l_suf_sum").alias(f"{p}suf_sum"), F.greatest("_f_max", "_l_suf_max").alias(f"{p}suf_max"),
                F.least("_f_min", "_l_suf_min").alias(f"{p}suf_min")]
    for k in range(1, lags + 1 if value is not None else 1):
        # inside the chunk when k < local position; else so far back in the values before the chunk
        back = F.get(F.col("_c_tail"), F.size("_c_tail") - (F.lit(k) - F.col("_l_rn")) - 1)
        res.append(F.when(F.col("_l_rn") > k, F.col(f"_l_lag{k}")).otherwise(back).alias(f"{p}lag{k}"))
    return out.select(*df.columns, *res)


def _local(keys: list[Column], order: list[Column], value: str | None, lags: int, p: str, run: bool,
           suffix: bool) -> list[Column]:
    """The scan's columns by windows over ``keys``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    cols = [F.row_number().over(w).cast("bigint").alias(f"{p}rn")]
    if run:
        so_far = w.rowsBetween(_UNB, 0)
        cols += [f(value).over(so_far).alias(f"{p}run_{n}")
                 for n, f in (("sum", F.sum), ("max", F.max), ("min", F.min), ("cnt", F.count))]
    if suffix:
        rest = w.rowsBetween(0, Window.unboundedFollowing)
        cols += [f(value).over(rest).alias(f"{p}suf_{n}") for n, f in (("sum", F.sum), ("max", F.max), ("min", F.min))]
    if value is not None:
        cols += [F.lag(value, k).over(w).alias(f"{p}lag{k}") for k in range(1, lags + 1)]
    return cols


def _carry(rows: DataFrame, value: str | None, lags: int, run: bool, suffix: bool) -> DataFrame:
    """(_k, _chunk) with what lies before (``_c_``) and after (``_f_``) each chunk of the large keys."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if run or suffix:
        aggs += [F.sum(value).alias("_sum"), F.max(value).alias("_max"), F.min(value).alias("_min"), F.count(value).alias("_cnt")]
    summary = rows.groupBy("_k", "_chunk").agg(*aggs)
    if value is not None and lags:
        last = Window.partitionBy("_k", "_chunk").orderBy(F.desc("_at"))
        tail = (rows.select("_k", "_chunk", "_at", F.col(value).alias("_v")).withColumn("_nth", F.row_number().over(last))
                .where(F.col("_nth") <= lags).groupBy("_k", "_chunk")
                .agg(F.array_sort(F.collect_list(F.struct(F.negative("_nth").alias("nth"), F.col("_v").alias("v")))).alias("_tail")))
        summary = summary.join(tail.withColumn("_tail", F.col("_tail.v")), ["_k", "_chunk"])
    key = Window.partitionBy("_k").orderBy("_chunk")
    before, after = key.rowsBetween(_UNB, -1), key.rowsBetween(1, Window.unboundedFollowing)
    cols = [F.sum("_n").over(before).alias("_c_n")]
    if run:
        cols += [F.sum("_sum").over(before).alias("_c_sum"), F.max("_max").over(before).alias("_c_max"),
                 F.min("_min").over(before).alias("_c_min"), F.sum("_cnt").over(before).alias("_c_cnt")]
    if suffix:
        cols += [F.sum("_sum").over(after).alias("_f_sum"), F.max("_max").over(after).alias("_f_max"),
                 F.min("_min").over(after).alias("_f_min")]
    if value is not None and lags:
        cols.append(F.flatten(F.collect_list("_tail").over(key.rowsBetween(-lags, -1))).alias("_c_tail"))
    return summary.select("_k", "_chunk", *cols)
