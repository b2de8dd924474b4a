"""Parquet table access for the driver data set.

Columns are always named so that the parquet scan reads only what a query
uses (``ReadSchema`` in the plan) and filters reach ``PushedFilters``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
