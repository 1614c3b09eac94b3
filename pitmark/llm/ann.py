"""Nearest neighbours by vantage-point trees, one for each shard."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.llm.common import batch
from pitmark.llm.vectors import as_doubles, matrix, usable
from pitmark.operators.scratch import materialise

_TREE = pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("rings", pa.binary())])
_BEST = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_NONE = np.iinfo(np.int64).max
#: Keeps rounding from pruning what lies on a border.
_SLACK = 1e-9


@lru_cache(maxsize=65536)
def _inner(size: int, leaf: int) -> int:
    """Inner nodes of a tree over so many points: its shape follows from their number."""
    if size <= leaf:
        return 0
    inside = size // 2
    return 1 + _inner(inside, leaf) + _inner(size - 1 - inside, leaf)


def build(ids: np.ndarray, rows: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points in tree order and the rings of each inner node (near half from, to, far half from, to), nodes before their children.

    A node's first point is its vantage point: the one farthest from the node's
    mean. The nearer half of the others comes next, then the farther half; of
    both the distances where they begin and end are kept.
    """
    unit = rows / np.sqrt((rows * rows).sum(1, keepdims=True))
    order, rings = np.arange(len(ids)), []

    def split(lo: int, hi: int) -> None:
        if hi - lo <= leaf:
            return
        at = order[lo:hi]
        x = unit[at]
        first = int(((x - x.mean(0)) ** 2).sum(1).argmax())
        at[[0, first]] = at[[first, 0]]
        d = np.sqrt(np.maximum(0, 2 - 2 * (unit[at[1:]] @ unit[at[0]])))
        by = np.argsort(d, kind="stable")
        at[1:] = at[1:][by]
        inside = (hi - lo) // 2
        rings.append((d[by[0]], d[by[inside - 1]], d[by[min(inside, len(by) - 1)]], d[by[-1]]))
        split(lo + 1, lo + 1 + inside)
        split(lo + 1 + inside, hi)

    split(0, len(ids))
    return ids[order], rows[order], np.array(rings).reshape(-1, 4)


class Search:
    """The best k of a shard for a block of queries, which go down the tree together.

    Each query first meets the leaf that it would lie in, which brings its k-th
    best close; then all walk the whole tree, past what the bounds leave out.
    ``measured`` counts the pairs of a query and a point that were compared.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, rings: np.ndarray, leaf: int, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.ids, self.rows, self.rings, self.leaf = ids, rows, rings, leaf
        self.norms, self.query_norms = (np.sqrt(np.einsum("nd,nd->n", x, x)) for x in (rows, queries))
        self.unit, self.query_unit = rows / self.norms[:, None], queries / self.query_norms[:, None]
        self.query_ids, self.queries = query_ids, queries
        self.k, self.factor = k, factor
        self.score, self.found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), _NONE)
        self.measured, self.home = 0, np.full(len(queries), -1)
        self.settle(0, len(ids), 0, np.arange(len(queries)))
        self.visit(0, len(ids), 0, np.arange(len(queries)))

    def measure(self, lo: int, hi: int, q: np.ndarray) -> np.ndarray:
        """Cosines with the points lo..hi; the best k are kept, ties to the smaller id.

        A matrix product tells what may be among the best; only that is
        measured in the order of summation that scores are given in.
        """
        self.measured += (hi - lo) * len(q)
        s = self.query_unit[q] @ self.unit[lo:hi].T
        other = self.ids[lo:hi] != self.query_ids[q][:, None]
        least = self.score[q, -1]
        if hi - lo > self.k + 1:
            least = np.maximum(least, np.partition(s, -self.k - 1, axis=1)[:, -self.k - 1])
        i, j = np.nonzero((s >= least[:, None] - _SLACK) & other)
        if len(i):
            row, at = q[i], lo + j
            score = np.einsum("nd,nd->n", self.queries[row], self.rows[at]) / (self.query_norms[row] * self.norms[at])
            some = np.unique(row)
            place = np.concatenate([row, np.repeat(some, self.k)])
            score, names = np.concatenate([score, self.score[some].ravel()]), np.concatenate([self.ids[at], self.found[some].ravel()])
            order = np.lexsort((names, -score, place))
            rank = np.arange(len(order)) - np.searchsorted(place[order], place[order])
            best = order[rank < self.k]
            self.score[some], self.found[some] = score[best].reshape(-1, self.k), names[best].reshape(-1, self.k)
        return s

    def reach(self, q: np.ndarray) -> np.ndarray:
        """How far a better point may lie: the distance of the k-th best, times the factor."""
        return self.factor * np.sqrt(np.maximum(0, 2 - 2 * np.maximum(self.score[q, -1], -1))) + _SLACK

    def halves(self, lo: int, hi: int, node: int) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
        inside = (hi - lo) // 2
        return (lo + 1, lo + 1 + inside, node + 1), (lo + 1 + inside, hi, node + 1 + _inner(inside, self.leaf))

    def beyond(self, node: int, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far each query lies at least from the points of the near and of the far half."""
        near_from, near_to, far_from, far_to = self.rings[node]
        d = np.sqrt(np.maximum(0, 2 - 2 * cosine))
        return np.maximum(near_from - d, d - near_to), np.maximum(far_from - d, d - far_to)

    def settle(self, lo: int, hi: int, node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        if hi - lo <= self.leaf:
            self.measure(lo, hi, q)
            self.home[q] = lo
            return
        near, far = self.beyond(node, self.query_unit[q] @ self.unit[lo])
        self.measured += len(q)
        for half, mine in zip(self.halves(lo, hi, node), (near <= far, near > far), strict=True):
            self.settle(*half, q[mine])

    def visit(self, lo: int, hi: int, node: int, q: np.ndarray) -> None:
        if hi - lo <= self.leaf:
            q = q[self.home[q] != lo]
            if len(q) and hi > lo:
                self.measure(lo, hi, q)
            return
        if not len(q):
            return
        for half, off in zip(self.halves(lo, hi, node), self.beyond(node, self.measure(lo, lo + 1, q)[:, 0]), strict=True):
            self.visit(*half, q[off <= self.reach(q)])


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 5, factor: float = 1.0, leaf: int = 192, shard_rows: int = 16_384, block: int = 512) -> DataFrame:
    """The k vectors of the largest cosine for each query: query_id, rank, vec_id, score.

    All vectors are dealt by the hash of their id over shards of about
    ``shard_rows``, and each shard is indexed whole as a vantage-point tree of
    Euclidean distances between unit vectors. Queries go to every shard in
    blocks of about ``block``; a block's work in a shard is large beside the
    tree that is sent with it. A subtree is left out if the triangle inequality
    shows that its points are farther than ``factor`` times the distance of the
    k-th best; at 1 the result is exact, below 1 more is pruned. Scores are
    cosines of the original vectors in double precision; ties go to the smaller
    id. Only the k best of a shard leave it, and only the k best of a task are
    shuffled.

    Null ids and vectors that are null, empty, zero or hold null or non-finite
    components take no part on either side. Only vectors of equal length are
    compared. A repeated id counts once, with its smallest vector. A query's own
    id is no candidate. Empty tables give no rows; other columns are ignored.
    """

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(df[id_col].cast("long").alias("id"), as_doubles(df, vector_col).alias("v"))
        return df.where(F.col("id").isNotNull() & usable("v")).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))

    points, asked = clean(vectors), materialise(clean(queries), "queries")
    points = materialise(points, "points")
    n, m = points.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block))

    def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        v = matrix(table["v"].combine_chunks())
        ids = table["id"].to_numpy()
        order = np.argsort(ids)
        ids, rows, rings = build(ids[order], v[order], leaf)
        return pa.Table.from_batches([batch(_TREE, dim=[key[0].as_py()], shard=[key[1].as_py()], ids=[ids.tobytes()], rows=[rows.tobytes()], rings=[rings.tobytes()])])

    # few bytes and much work: a partition for each shard, which small sizes don't merge
    spread = lambda df: df.repartition(shards, "dim", "shard")
    index = spread(points.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))).groupBy("dim", "shard").applyInArrow(grow, "dim int, shard long, ids binary, rows binary, rings binary")
    index = materialise(index, "trees")
    packed = asked.groupBy("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("q"))
    packed = packed.select("dim", F.col("q.id").alias("qids"), F.flatten("q.v").alias("qrows"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                query_ids = b.column("qids").slice(i, 1).flatten().to_numpy()
                q = b.column("qrows").slice(i, 1).flatten().to_numpy().reshape(-1, dim)
                ids, rows, rings = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in (("ids", np.int64), ("rows", np.float64), ("rings", np.float64)))
                s = Search(ids, rows.reshape(-1, dim), rings.reshape(-1, 4), leaf, query_ids, q, k, factor)
                real = s.found != _NONE
                yield batch(_BEST, query_id=np.broadcast_to(query_ids[:, None], real.shape)[real], vec_id=s.found[real], score=s.score[real])

    found = spread(index).join(spread(packed), ["dim", "shard"]).select("dim", "qids", "qrows", "ids", "rows", "rings").mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
