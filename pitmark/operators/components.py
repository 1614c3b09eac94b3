"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmark.operators.scratch import discard, write

#: Edges that a task contracts at once.
_CHUNK = 1_000_000


def contract(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest place reachable from each place over the links i - j."""
    at = np.arange(n)
    while True:
        low = np.minimum(at[i], at[j])
        new = at.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == at).all():
            return at
        at = new


def _forest(edges: DataFrame) -> DataFrame:
    """Each task's edges as stars around their smallest nodes: fewer edges with the same reach, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            u, v = (table[c].to_numpy() for c in ("u", "v"))
            nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
            root = contract(place[: len(u)], place[len(u) :], len(nodes))
            leaf = np.flatnonzero(root != np.arange(len(nodes)))
            kind = table.schema.field("u").type
            return pa.RecordBatch.from_arrays([pa.array(nodes[leaf], kind), pa.array(nodes[root[leaf]], kind)], names=["u", "v"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= _CHUNK:
                yield stars()
                held.clear()
        if held:
            yield stars()

    return edges.mapInArrow(run, edges.schema)


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half step: link every neighbour to the smallest node around.

    ``edges`` holds (u, v) with u > v. The large star looks at all neighbours
    of a node and relinks the larger ones; the small star looks at the smaller
    ones only. The minimum is an aggregate, so a hub with very many edges is
    reduced before the shuffle; the join that follows has an exchange on both
    sides, so that a skewed hub can be split.
    """
    around = edges.select("u", "v")
    if large:
        around = around.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node with an edge; component = smallest node reachable.

    Self loops, nulls and repeated edges are ignored. Edges are contracted
    within tasks first. Each round then writes two tables, one for each half
    step, deletes those before, and halves the depth of the trees at least; the
    loop ends when a round changes nothing (an order-free digest of the edges is
    compared, two numbers).
    """
    a, b = F.col(src), F.col(dst)
    some = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now, path = write(_forest(some).distinct(), "edges")
    before = None
    while True:
        digest = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest == before or digest[0] == 0:
            break
        before = digest
        large, between = write(_stars(now, True), "large")
        new, new_path = write(_stars(large, False), "small")
        discard(now.sparkSession, path, between)
        now, path = new, new_path
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
