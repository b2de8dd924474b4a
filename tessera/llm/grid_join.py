"""Operator 7: embedding near-duplicates by the epsilon grid order join.

Unit vectors are rotated to their principal axes (the second moments are
summed over all vectors; only that matrix reaches the driver). Each vector
lies in a grid cell of side epsilon on its leading principal dimensions, and
the vectors are sorted by cell: the epsilon grid order. The sorted sequence is
cut into blocks; blocks form intervals of ``FAN``, those intervals of ``FAN``
again, and so on. Intervals are joined recursively from the top: a pair of
intervals whose bounding boxes lie farther apart than epsilon holds no link
and is dropped, any other pair is replaced by the pairs of its parts. Pairs
of blocks that remain are compared in double precision.

Equal vectors are one vector with a multiplicity, so copies cost nothing. A
pair of blocks returns a number of links for each vector and, of its links,
at most about two for each vector, which join the same components; never all
its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are kept; vectors of different lengths do not
link; rows with the same id are one vector per distinct content, their links
are added and their components joined; a null id is returned with its links
and a null component; an empty table gives no rows; only the id and vector
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise
from .components import components, local_labels

#: Vectors of a block, rows of it compared at a time, parts of an interval.
BLOCK, STRIP, FAN = 4096, 512, 4
#: Leading principal dimensions of the grid and of the bounding boxes.
GRID_DIMS, BOX_DIMS = 4, 12
#: Keeps rounding from dropping a pair that lies exactly at the limit.
SLACK = 1e-6


def usable(vec: str):
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows over their length, in double precision, safe from overflow and underflow."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of an Arrow list column, one matrix per vector length."""
    offsets = column.offsets.to_numpy()
    flat = np.asarray(column.values, np.float64)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, unit_rows(flat[offsets[rows][:, None] + np.arange(size)])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Vector length -> its axes, greatest spread first, from the second moments of all vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, units in by_length(batch.column(0)):
                size = units.shape[1]
                held[size] = held.get(size, 0) + units.T @ units
        if held:
            yield pa.record_batch([pa.array(list(held), pa.int64()),
                                   pa.array([m.ravel().tolist() for m in held.values()], pa.list_(pa.float64()))], ["size", "moment"])

    parts = vectors.select("vec").mapInArrow(moments, "size long, moment array<double>")
    cells = parts.select("size", F.posexplode("moment").alias("at", "m")).groupBy("size", "at").agg(F.sum("m").alias("m"))
    axes: dict[int, list] = {}
    for r in sorted(cells.collect()):  # size x size numbers
        axes.setdefault(r["size"], []).append(r["m"])
    out = {}
    for size, m in axes.items():
        values, rotation = np.linalg.eigh(np.array(m).reshape(size, size))
        out[size] = rotation[:, np.argsort(-values)]
    return out


def projected(vectors: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """``vectors`` plus size, cells (grid places of the leading dimensions) and lead (leading coordinates)."""
    names = vectors.columns
    at = names.index("vec")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            lead = np.zeros((batch.num_rows, BOX_DIMS))
            for rows, units in by_length(batch.column(at)):
                size = units.shape[1]
                sizes[rows] = size
                turned = units @ axes[size][:, :BOX_DIMS]
                lead[rows, :turned.shape[1]] = turned
            cells = np.floor(lead[:, :GRID_DIMS] / epsilon).astype(np.int64)
            yield pa.record_batch([*batch.columns, pa.array(sizes), pa.array(cells.tolist(), pa.list_(pa.int64())),
                                   pa.array(lead.tolist(), pa.list_(pa.float64()))], [*names, "size", "cells", "lead"])

    return vectors.mapInArrow(run, f"{schema}, size long, cells array<long>, lead array<double>")


def grid_blocks(points: DataFrame, block: int) -> DataFrame:
    """``points`` (node, vec, many, size, cells, lead) plus ``block``, a run of the epsilon grid order.

    The order is a range sort; rows are numbered by the counts of the
    partitions before, so no task sees more than its own range.
    """
    order = ["size", "cells", "lead", "node"]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = points.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = materialise(ordered.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "grid-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_n = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    starts = parts_n.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("row") - F.shiftleft(F.col("part").cast("long"), 33)
    return held.join(starts, "part").withColumn("block", F.floor(place / block)).drop("part", "row", "start")


def block_pairs(blocks: DataFrame, epsilon: float, fan: int = FAN) -> DataFrame:
    """(x, y), x <= y: pairs of blocks whose bounding boxes come within epsilon, by joining intervals from the top."""
    dims = range(BOX_DIMS)
    corners = [F.min(F.col("lead")[d]).alias(f"lo{d}") for d in dims] + [F.max(F.col("lead")[d]).alias(f"hi{d}") for d in dims]
    corners += [F.min("size").alias("lo_size"), F.max("size").alias("hi_size")]
    level = materialise(blocks.groupBy(F.col("block").alias("i")).agg(*corners), "boxes")
    levels = [level]
    merged = [F.min(f"lo{d}").alias(f"lo{d}") for d in dims] + [F.max(f"hi{d}").alias(f"hi{d}") for d in dims]
    merged += [F.min("lo_size").alias("lo_size"), F.max("hi_size").alias("hi_size")]
    count = (level.agg(F.max("i")).first()[0] or 0) + 1
    while count > 1:
        levels.append(materialise(levels[-1].groupBy(F.floor(F.col("i") / fan).alias("i")).agg(*merged), "boxes"))
        count = -(-count // fan)
    pairs = levels[-1].select(F.col("i").alias("x"), F.col("i").alias("y"))
    limit = (epsilon + SLACK) ** 2
    for below in reversed(levels[:-1]):
        part = F.sequence(F.lit(0), F.lit(fan - 1))
        parts = (pairs.withColumn("p", F.explode(part)).withColumn("q", F.explode(part))
                 .select((F.col("x") * fan + F.col("p")).alias("x"), (F.col("y") * fan + F.col("q")).alias("y")).where("x <= y"))
        left = below.select(F.col("i").alias("x"), F.struct("*").alias("l"))
        right = below.select(F.col("i").alias("y"), F.struct("*").alias("r"))
        near = parts.join(left, "x").join(right, "y")
        gaps = [F.greatest(F.lit(0.0), F.col(f"l.lo{d}") - F.col(f"r.hi{d}"), F.col(f"r.lo{d}") - F.col(f"l.hi{d}")) for d in dims]
        apart = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
        same_size = (F.col("l.lo_size") <= F.col("r.hi_size")) & (F.col("r.lo_size") <= F.col("l.hi_size"))
        pairs = materialise(near.where(same_size & (apart <= limit)).select("x", "y"), "pairs")
    return pairs


def compare(nodes_a, units_a, many_a, nodes_b, units_b, many_b, cosine: float, same: bool):
    """(links of a's vectors, links of b's vectors, edges) between two blocks of one vector length."""
    links_a, links_b = np.zeros(len(nodes_a), np.int64), np.zeros(len(nodes_b), np.int64)
    label = np.tile(np.arange(len(nodes_a)), 2) if same else np.arange(len(nodes_a) + len(nodes_b))
    left, right = [], []
    for at in range(0, len(nodes_a), STRIP):
        near = units_a[at:at + STRIP] @ units_b.T >= cosine
        if same:
            near[np.arange(near.shape[0]), at + np.arange(near.shape[0])] = False
        links_a[at:at + STRIP] = near @ many_b
        if not same:
            links_b += many_a[at:at + STRIP] @ near
        while True:  # every component with an open link takes one of them, so each turn at least halves their number
            own, other = label[at:at + len(near)], label[len(nodes_a):]
            open_ = near & (own[:, None] != other[None, :])
            rows, cols = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
            if not len(rows):
                break
            chosen = np.unique(np.concatenate([own[rows], other[cols]]), return_index=True)[1]
            rows, cols = (np.concatenate([rows, open_[:, cols].argmax(0)])[chosen],
                          np.concatenate([open_[rows].argmax(1), cols])[chosen])
            left.append(nodes_a[at + rows])
            right.append(nodes_b[cols])
            nodes, roots = local_labels(label[at + rows], label[len(nodes_a) + cols])
            place = np.searchsorted(nodes, label)
            place[place == len(nodes)] = 0
            label = np.where(nodes[place] == label, roots[place], label)
    return links_a, links_b, np.concatenate(left or [nodes_a[:0]]), np.concatenate(right or [nodes_b[:0]])


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                    block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    rows = rows.withColumn("vec", F.when(usable("vec"), F.col("vec")))
    # equal vectors are one node, named by a number of its own
    content = F.transform("vec", lambda x: F.when(x == 0, F.lit(0).cast("float")).otherwise(x.cast("float"))) \
        if dict(vectors.dtypes)[vec_col] == "array<float>" else F.transform("vec", lambda x: x.cast("double") + F.lit(0.0))
    rows = rows.withColumn("vec", content)
    distinct = (rows.where("vec is not null").groupBy("vec")
                .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("many")))
    nodes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    axes = principal_axes(nodes)
    blocks = materialise(grid_blocks(projected(nodes.select("node", "vec", "many"), axes, epsilon), block), "blocks")
    pairs = block_pairs(blocks, epsilon)
    slim = blocks.select("block", "node", "many", "size", "vec")
    sides = (pairs.select("x", "y", F.col("x").alias("block"), F.lit(0).alias("side"))
             .unionByName(pairs.where("x < y").select("x", "y", F.col("y").alias("block"), F.lit(1).alias("side"))))
    dealt = slim.join(sides, "block").drop("block")

    def join(table: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        column = table.column("vec").combine_chunks()
        nodes, many, side = (table.column(c).to_numpy() for c in ("node", "many", "side"))
        same = table.column("x")[0] == table.column("y")[0]
        for rows, units in by_length(column):
            a = side[rows] == 0
            b = a if same else ~a
            if not a.any() or not b.any():
                continue
            na, nb = nodes[rows[a]], nodes[rows[b]]
            la, lb, left, right = compare(na, units[a], many[rows[a]], nb, units[b], many[rows[b]], cosine, bool(same))
            for ids, links in ((na, la), (nb, lb)):
                some = links > 0
                out[0].append(ids[some])
                out[1].append(ids[some])
                out[2].append(links[some])
            out[0].append(left)
            out[1].append(right)
            out[2].append(np.zeros(len(left), np.int64))
        kept = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({"a": kept[0], "b": kept[1], "links": kept[2]})

    found = materialise(dealt.groupBy("x", "y").applyInArrow(join, "a long, b long, links long"), "links")
    links = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("links = 0").select("a", "b"))
    # a component of nodes is named by the least id of its vectors
    named = nodes.select("vec", "node", "least", "many").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(links, "node", "left").join(names, "component").select(
        "vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"))
    placed = rows.join(known, "vec", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                                                    F.coalesce("component_id", "vec_id").alias("component_id"))
    # ids with several contents tie their components together
    tied = placed.where("vec_id is not null and vec_id <> component_id").select(F.col("vec_id").alias("a"), F.col("component_id").alias("b"))
    several = rows.where("vec_id is not null").groupBy("vec_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("vec_id")
    twice = components(tied.join(several, F.col("a") == F.col("vec_id")).select("a", "b"))
    out = placed.join(twice.select(F.col("node").alias("component_id"), F.col("component").alias("first")), "component_id", "left")
    component = F.coalesce("first", "component_id")
    return out.select("vec_id", "n_links", component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
