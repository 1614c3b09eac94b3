"""Sequence packing by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pitmark.llm import pretokens
from pitmark.llm.common import batch, texts_of

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
#: Sequence numbers that each task may give out.
_PER_TASK = 1 << 36


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each item.

    Every item starts as a partial partition with one filled window. The two
    partial partitions with the widest spread are merged, the fullest window
    of one with the emptiest of the other, until one partition is left.
    """
    nodes: list[tuple[int, int, np.ndarray] | None] = [None] * len(sizes)
    sums = []
    for x in sizes:
        s = np.zeros(windows, np.int64)
        s[0] = x
        sums.append(s)
    spread = lambda s: int(s[0] - s[-1])
    heap = [(-spread(s), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(windows)
        nodes.append((a, b, place))
        sums.append(both[order])
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-spread(sums[-1]), len(sums) - 1))
    at: dict[int, np.ndarray] = {len(nodes) - 1: np.arange(windows)}
    for k in range(len(nodes) - 1, len(sizes) - 1, -1):
        a, b, place = nodes[k]
        mine = at.pop(k)[place]
        at[a], at[b] = mine, mine[::-1]
    return np.array([at[i][0] for i in range(len(sizes))], np.int64)


def near_equal(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Windows of at most ``capacity`` and their number, which rises while one is exceeded."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        where = difference(sizes, windows)
        if np.bincount(where, weights=sizes, minlength=windows).max() <= capacity:
            return where, windows
        windows += 1


class _Packer:
    """Packs what one task reads; holds at most the pieces of one batch of windows."""

    def __init__(self, capacity: int, windows: int, grain: int, slack: int, task: int):
        self.capacity, self.grain, self.target = capacity, grain, windows * (capacity - slack)
        self.next_id, self.waiting, self.sum, self.rows = task * _PER_TASK, [], 0, []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self.rows.append((doc, at, self.capacity, ids[at : at + self.capacity].tobytes(), n, self.next_id, 0))
            self.next_id += 1
            at += self.capacity
        while at < n:
            size = min(self.grain, n - at, self.target - self.sum)
            self.waiting.append((doc, at, size, ids[at : at + size].tobytes(), n))
            self.sum += size
            at += size
            if self.sum == self.target:
                self.flush()

    def flush(self) -> None:
        if self.waiting:
            where, windows = near_equal([p[2] for p in self.waiting], self.capacity)
            filled = [0] * windows
            for p, w in zip(self.waiting, where.tolist(), strict=True):
                self.rows.append((*p, self.next_id + w, filled[w]))
                filled[w] += p[2]
            self.next_id += windows
            self.waiting, self.sum = [], 0

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(_SCHEMA)
        self.rows = []
        return batch(_SCHEMA, **dict(zip(_SCHEMA.names, columns, strict=True)))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = 1024, windows: int = 64, grain: int = 256, slack: int = 2, tokenizer: str = "byte_bpe_50k", end_id: int = 0) -> DataFrame:
    """Cut documents into pieces and pack them into sequences of at most ``capacity`` ids.

    Per piece: doc_id, start, length, ids (binary, little-endian uint32),
    doc_tokens (with the closing ``end_id``), sequence_id and offset. Whole
    stretches of ``capacity`` ids are sequences by themselves. What is left of
    each document, cut at every ``grain`` ids, waits until ``windows`` windows
    can be filled to within ``slack`` ids each; differencing deals these pieces
    out. There is no shuffle: each task packs what it reads, in the order read,
    so a lost task comes out the same again. Only a task's last batch can leave
    a window half filled.

    Null text is empty and gives the closing id alone; a null id stays null;
    repeated rows are packed one by one; an empty table gives no rows; other
    columns are ignored. A very long text is held once, its pieces leave at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, windows, grain, slack, TaskContext.get().partitionId())
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                packer.add(doc, np.append(pretokens.ids(text, tokenizer), np.uint32(end_id)).astype("<u4"))
                if len(packer.rows) >= 4096:
                    yield packer.take()
        packer.flush()
        yield packer.take()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
