"""Near-duplicate embeddings by product quantisation over inverted lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmark.llm.common import batch, contract, smallest
from pitmark.llm.vectors import as_doubles, matrix, unit, usable
from pitmark.operators.components import components
from pitmark.operators.scratch import materialise

_CODED = pa.schema([("cls", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("mult", pa.int64()), ("v", pa.list_(pa.float64())), ("cell", pa.int32()), ("code", pa.binary()), ("error", pa.float64()), ("probes", pa.list_(pa.int32()))])
_PAIRED = pa.schema([("edge", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
_SLACK = 1e-9


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (row, centre)."""
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        at = _distances(x, centres).argmin(1)
        total = np.zeros_like(centres)
        np.add.at(total, at, x)
        n = np.bincount(at, minlength=len(centres))[:, None]
        centres = np.where(n > 0, total / np.maximum(n, 1), centres)
    return centres


@dataclass(frozen=True)
class Quantiser:
    """Coarse centres, and codewords of the residual in each subspace."""

    centres: np.ndarray  # (cell, dimension)
    books: np.ndarray  # (subspace, codeword, dimensions of the subspace)

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, subspace: int = 4, words: int = 16) -> Quantiser:
        centres = k_means(x, cells)
        rest = x - centres[_distances(x, centres).argmin(1)]
        parts = rest.reshape(len(x), -1, subspace)
        books = [k_means(parts[:, m], min(words, len(x)), seed=m) for m in range(parts.shape[1])]
        return cls(centres, np.stack(books))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes, and how far the decoded vector lies from the real one."""
        cell = _distances(x, self.centres).argmin(1)
        parts = (x - self.centres[cell]).reshape(len(x), *self.books.shape[::2])
        codes = np.stack([_distances(parts[:, m], b).argmin(1) for m, b in enumerate(self.books)], 1).astype(np.uint8)
        decoded = np.stack([b[codes[:, m]] for m, b in enumerate(self.books)], 1)
        return cell, codes, np.sqrt(((parts - decoded) ** 2).sum((1, 2)))

    def probes(self, x: np.ndarray, cell: np.ndarray, reach: float) -> np.ndarray:
        """(row, cell): can a vector within ``reach`` have this cell as its nearest?

        It can't if the row is farther than that from the plane halfway
        between the row's own centre and the cell's.
        """
        d = _distances(x, self.centres)
        apart = np.sqrt(_distances(self.centres, self.centres))[cell]
        return d - np.take_along_axis(d, cell[:, None], 1) <= 2 * apart * reach + _SLACK

    def table_distances(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances (row, code) of whole vectors to decoded members of a cell, from tables of each subspace."""
        parts = (x - self.centres[cell]).reshape(len(x), *self.books.shape[::2])
        out = np.zeros((len(x), len(codes)))
        for m, b in enumerate(self.books):
            out += _distances(parts[:, m], b)[:, codes[:, m]]
        return np.sqrt(out)


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, cosine: float = 0.93, sample: int = 8192, cells: int | None = None, block: int = 1024) -> DataFrame:
    """Links between vectors of equal label with a cosine of at least ``cosine``.

    Per row: vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable), kept. Rows of equal label and vector fall into
    a class first and are counted, not compared. The quantiser is fitted on the
    ``sample`` classes (four for each cell at least) with the smallest hash of
    their id; every class is indexed. There are sqrt(classes) / 24 cells: more would copy each vector
    more often than they spare comparisons. A vector probes
    each cell that can hold a link of it by the half-plane bound. Members whose
    table distance, less their own coding error, is beyond the distance that
    belongs to ``cosine`` can't be links; all others are decided by the exact
    cosine in double precision. No link is lost by either bound.

    A list and the vectors that probe it are cut into blocks of about ``block``
    by hash, and two blocks meet in one group: a hot label or cell is spread
    over tasks. A pair of blocks returns a count for each vector and a forest of
    its links instead of the links.

    Null ids, null labels and vectors that are null, empty, zero or hold null or
    non-finite components link with nothing (component null for a null id).
    Only vectors of equal length are compared. Each repeated row is a vector of
    its own for the counts; vectors of one id share a component. An empty table
    gives no rows; other columns are ignored.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), as_doubles(vectors, vector_col).alias("v"), vectors[label_col].cast("string").alias("label"))
    rows = rows.withColumn("v", F.when(usable("v"), F.col("v")))
    some = rows.where("id is not null and label is not null and v is not null")
    classes = materialise(some.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("mult")).withColumn("dim", F.size("v")).withColumn("cls", F.monotonically_increasing_id()), "classes")
    n, width = classes.agg(F.count("*"), F.max("dim")).first()
    if not n:
        links = n_links = None
    else:
        width = -(-width // 4) * 4
        cells = cells or max(1, round(n**0.5 / 24))
        taken = smallest(classes.select("rep", "v"), "rep", max(sample, 4 * cells), n).toArrow()
        quantiser = Quantiser.fit(unit(matrix(taken["v"].combine_chunks(), width)), min(cells, taken.num_rows))
        shared = classes.sparkSession.sparkContext.broadcast(quantiser)
        reach = float(np.sqrt(2 - 2 * cosine))

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = unit(matrix(b.column("v"), width))
                    cell, codes, error = shared.value.encode(x)
                    may = shared.value.probes(x, cell, reach) & (np.arange(len(shared.value.centres)) >= cell[:, None])
                    yield batch(_CODED, cls=b.column("cls"), label=b.column("label"), dim=b.column("dim"), mult=b.column("mult"), v=b.column("v"), cell=cell.astype(np.int32), code=[c.tobytes() for c in codes], error=error, probes=[np.flatnonzero(m).astype(np.int32) for m in may])

        coded = materialise(classes.select("cls", "label", "dim", "mult", "v").mapInArrow(encode, "cls long, label string, dim int, mult long, v array<double>, cell int, code binary, error double, probes array<int>"), "coded")
        key = ["label", "dim", "cell"]
        asking = coded.select("cls", "label", "dim", "mult", "v", F.col("cell").alias("own"), F.explode("probes").alias("cell"))
        sizes = materialise(
            coded.groupBy(*key).agg(F.count("*").alias("n")).join(asking.groupBy(*key).agg(F.count("*").alias("m")), key)
            .select(*key, F.ceil(F.col("n") / block).alias("parts"), F.ceil(F.col("m") / block).alias("askers")),
            "lists",
        )
        deal = lambda size, salt: F.pmod(F.xxhash64("cls", F.lit(salt)), F.col(size))
        every = lambda size: F.explode(F.sequence(F.lit(0).cast("long"), F.col(size) - 1))
        members = coded.join(sizes, key).select(*key, deal("parts", 1).alias("part"), every("askers").alias("asker"), "cls", "mult", "v", "code", "error")
        askers = asking.join(sizes, key).select(*[F.col(c).alias(f"q_{c}") for c in (*key, "cls", "mult", "v", "own")], every("parts").alias("q_part"), deal("askers", 2).alias("q_asker"))

        def meet(k: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            cell = k[2].as_py()
            if not left.num_rows or not right.num_rows:
                return pa.Table.from_batches([], _PAIRED)
            x, q = matrix(left["v"].combine_chunks(), width), matrix(right["q_v"].combine_chunks(), width)
            x_ids, q_ids = left["cls"].to_numpy(), right["q_cls"].to_numpy()
            codes = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(len(x), -1)
            near = shared.value.table_distances(unit(q), cell, codes) - left["error"].to_numpy() <= reach + _SLACK
            near &= (right["q_own"].to_numpy() != cell)[:, None] | (q_ids[:, None] < x_ids)
            i, j = np.nonzero(near)
            norms_q, norms_x = np.sqrt((q * q).sum(1)), np.sqrt((x * x).sum(1))
            kept = [np.einsum("nd,nd->n", q[a], x[b]) / (norms_q[a] * norms_x[b]) >= cosine for a, b in ((i[s : s + 65536], j[s : s + 65536]) for s in range(0, len(i), 65536))]
            sure = np.concatenate(kept) if kept else np.zeros(0, bool)
            i, j = i[sure], j[sure]
            ids = np.concatenate([q_ids, x_ids])
            add = np.concatenate([np.bincount(i, left["mult"].to_numpy()[j], len(q)), np.bincount(j, right["q_mult"].to_numpy()[i], len(x))]).astype(np.int64)
            root = contract(i, j + len(q), len(ids))
            some, tied = np.flatnonzero(add), np.flatnonzero(root != np.arange(len(ids)))
            return pa.Table.from_batches([batch(_PAIRED, edge=np.arange(len(some) + len(tied)) >= len(some), a=np.concatenate([ids[some], ids[tied]]), b=np.concatenate([add[some], ids[root[tied]]]))])

        group = [*key, "part", "asker"]
        met = materialise(members.groupBy(*group).cogroup(askers.groupBy(*[f"q_{c}" for c in group])).applyInArrow(meet, "edge boolean, a long, b long"), "met")
        n_links = materialise(met.where("not edge").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("n")), "counts")
        links = met.where("edge").select("a", "b")
    # an id with several vectors ties their classes together
    twin = materialise(some.groupBy("id").agg(F.countDistinct("label", "v").alias("n")).where("n > 1").select("id"), "twins")
    several = some.join(twin, "id", "left_semi").join(classes.select("label", "v", "cls"), ["label", "v"]).select("id", F.col("cls").alias("a")).distinct()
    tied = several.join(several.groupBy("id").agg(F.min("a").alias("b")), "id").select("a", "b")
    root = components(tied if links is None else links.unionByName(tied), "a", "b")
    root = materialise(root.select(F.col("node").alias("cls"), "component"), "roots")
    least = root.join(classes.select("cls", "rep"), "cls").groupBy("component").agg(F.min("rep").alias("root"))
    root = materialise(root.join(least, "component").select("cls", "root"), "roots")
    known = classes.select("label", "v", "cls", "rep", "mult").join(root, "cls", "left")
    known = known.withColumn("n", F.lit(0).cast("long")) if n_links is None else known.join(n_links, "cls", "left")
    known = materialise(known.select("label", "v", F.coalesce("root", "rep").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n")), "known")
    out = rows.join(known, ["label", "v"], "left").select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
