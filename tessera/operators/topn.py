"""Top-N per group and sorted limits.

``row_number() <= n`` (and ``rank``/``dense_rank``) directly under a filter
lets Catalyst insert a partial ``WindowGroupLimit`` *before* the shuffle, so a
hot group is cut to ``n`` rows per map task and never travels whole.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank", method: str = "row_number") -> DataFrame:
    """Keep the best ``n`` rows per group; ``order`` must be a total order for
    ``row_number`` to be deterministic (add a key as the last tie-break)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, _RANKERS[method]().over(w))
    return ranked.where(F.col(rank_col) <= n)


def newest_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global sorted limit; planned as ``TakeOrderedAndProject`` (per-task
    top-n then merge), never a full sort."""
    return df.orderBy(*order).limit(n)


def position_slice(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    """Positional slice ``iloc[offset:offset+n]`` over an explicit order."""
    return df.orderBy(*order).offset(offset).limit(n)
