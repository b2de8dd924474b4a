"""Connected components of an edge table, without collecting it anywhere.

Every partition of edges first shrinks to a spanning star forest. What is
left alternates large-star and small-star steps, each a partial minimum per
node and a join back, until only stars remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise

#: Edges that one task shrinks at a time.
CHUNK_EDGES = 1_000_000


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that each reaches) of the edges a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def stars() -> pa.RecordBatch:
        nodes, roots = local_labels(*(np.concatenate(x) for x in zip(*held)))
        off = nodes != roots
        return pa.record_batch([pa.array(nodes[off]), pa.array(roots[off])], ["a", "b"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= CHUNK_EDGES:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge (a, b)."""
    edges = materialise(edges.select("a", "b").where("a <> b"), "edges")
    total = edges.count()
    parts = max(1, -(-total // CHUNK_EDGES))
    stars = materialise(edges.repartition(parts).mapInArrow(_shrink, "a long, b long"), "stars")
    while True:
        # a > b in every row: finished when no b is an a and every a has one b
        rows, nodes = stars.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        if rows == nodes and (parts == 1 or stars.join(stars.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()):
            break
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large.where("a <> b"), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        stars = materialise(small, "small-star")
    roots = stars.select("b").distinct()
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component"))))
