"""Sinks: every write is one distributed job (no driver-side appends)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).text(path)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Attach named metrics computed during the same job that writes ``df``."""
    obs = Observation(name)
    return df.observe(obs, *[c.alias(k) for k, c in metrics.items()]), obs


def write_run_report(spark: SparkSession, report: dict, path: str) -> DataFrame:
    """One-row JSON report (values must be JSON-serialisable)."""
    row = spark.createDataFrame([(json.dumps(report, default=str, sort_keys=True),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)
    return row.select(F.from_json("value", "map<string,string>").alias("report"))
