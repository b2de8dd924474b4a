"""Row validation with reason codes and an accept/reject split."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule (in order) whose *failure* condition holds,
    NULL when the row passes all. A NULL condition counts as passing."""
    out = F.lit(None).cast("string")
    for name, failed in reversed(list(rules)):
        out = F.when(F.coalesce(failed, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with a ``reason`` column)."""
    tagged = df.withColumn("reason", first_failure(rules))
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())
