"""Running states over ordered rows, whatever the size of a key: ranges in tasks, and one state carried from range to range.

Rows are cut into ranges of (key, order), so a key with very many rows lies in
several tasks. Each task runs its fold over its own range and writes the rows
with their states; only the first key of a range can have begun before it, so
what is carried over is one state for each range. The rows of that key then take
it up in place; all others are as they were written. One shuffle, one table, no
window over a whole key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from pitmark.operators.scratch import materialise

_HEAD, _FIRST, _LAST = "in_first_key", "first_row", "last_row"


class Fold:
    """An associative combination of rows. ``fields`` are the columns of a state; a state is a tuple of their values."""

    fields: pa.Schema

    def prefixes(self, rows: pa.RecordBatch, new: np.ndarray, before: tuple | None) -> list[pa.Array]:
        """The state after each row since its key began (where ``new``); the first key may go on from ``before``."""
        raise NotImplementedError

    def joined(self, before: tuple, states: list[pa.Array]) -> list[pa.Array]:
        """States of a key that has come to ``before`` already."""
        raise NotImplementedError


class Sums(Fold):
    """Running sums of long columns, modulo 2**64; null counts as 0."""

    def __init__(self, **columns: str):
        self.columns = columns
        self.fields = pa.schema([(name, pa.int64()) for name in columns])

    def prefixes(self, rows, new, before):
        starts = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        out = []
        for k, name in enumerate(self.columns.values()):
            total = np.cumsum(pc.fill_null(rows.column(name), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            base = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0)
            if before is not None and len(new) and not new[0]:
                base[: int(np.argmax(new)) if new.any() else len(new)] -= before[k]
            out.append(pa.array(total - base))
        return out

    def joined(self, before, states):
        return [pa.array(s.to_numpy(zero_copy_only=False) + np.int64(x)) for s, x in zip(states, before, strict=True)]


class Steps(Fold):
    """A fold by ``lift(row) -> state`` and ``combine(state, state) -> state``, over the named columns."""

    def __init__(self, columns: Sequence[str], fields: pa.Schema, lift, combine):
        self.columns, self.fields, self.lift, self.combine = columns, fields, lift, combine

    def _out(self, states: list[tuple]) -> list[pa.Array]:
        return [pa.array(list(c), f.type) for c, f in zip(zip(*states, strict=True) if states else [[] for _ in self.fields], self.fields, strict=True)]

    def prefixes(self, rows, new, before):
        states, state = [], before
        for fresh, row in zip(new.tolist(), zip(*[rows.column(c).to_pylist() for c in self.columns], strict=True), strict=True):
            one = self.lift(*row)
            state = one if fresh or state is None else self.combine(state, one)
            states.append(state)
        return self._out(states)

    def joined(self, before, states):
        return self._out([self.combine(before, s) for s in zip(*[s.to_pylist() for s in states], strict=True)])


def _changes(rows: pa.RecordBatch, key: Sequence[str]) -> np.ndarray:
    """Where a row's key is another than that of the row before it; nulls are alike."""
    changed = np.zeros(max(rows.num_rows - 1, 0), bool)
    for c in key:
        x = rows.column(c)
        a, b = x.slice(1), x.slice(0, max(rows.num_rows - 1, 0))
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        changed |= differ | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    return changed


def _at(rows: pa.RecordBatch, columns: Sequence[str], k: int) -> tuple:
    return tuple(rows.column(c)[k].as_py() for c in columns)


def running(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], fold: Fold) -> DataFrame:
    """``df`` with the columns of ``fold``: its state after each row, over the rows of the same key up to it in ``order``.

    Null keys are one key. Rows that are equal in key and order stand in any
    order, in one range: give an order that tells them apart where they are
    many. Writes one table on the way; what comes to the driver is two rows for
    each range. Names that the result needs may not be columns of ``df``.
    """
    spark, mine = df.sparkSession, [*fold.fields.names]
    # where a column of the order comes from an expression, it is part of the rows no longer
    by = [*[F.col(c).asc_nulls_first() for c in key], *[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    key, columns = list(key), list(df.columns)
    made = pa.schema([*fold.fields, ("range", pa.int32()), (_HEAD, pa.bool_()), (_FIRST, pa.bool_()), (_LAST, pa.bool_())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first_key, last_key, state, held, begun = TaskContext.get().partitionId(), None, None, None, None, False

        def batch(rows, states, head, first, last):
            n = rows.num_rows
            edge = lambda on, k: pa.array(np.arange(n) == (k if on else -1))
            return pa.RecordBatch.from_arrays([*rows.columns, *states, pa.array(np.full(n, number, np.int32)), pa.array(head), edge(first, 0), edge(last, n - 1)], names=[*columns, *made.names])

        for rows in batches:
            if not rows.num_rows:
                continue
            if held is not None:
                yield batch(*held, False)
            here = _at(rows, key, 0)
            new = np.concatenate([[not begun or here != last_key], _changes(rows, key)])
            states = fold.prefixes(rows, new, state if begun and not new[0] else None)
            if not begun:
                first_key = here
            # the first key goes on until the first change of this batch, if it has not ended before
            still = here == first_key and (not begun or last_key == first_key)
            until = (int(np.argmax(new[1:])) + 1 if new[1:].any() else rows.num_rows) if still else 0
            held = (rows, states, np.arange(rows.num_rows) < until, not begun)
            last_key, state, begun = _at(rows, key, rows.num_rows - 1), tuple(s[-1].as_py() for s in states), True
        if held is not None:
            yield batch(*held, True)

    schema = from_arrow_schema(pa.schema([*to_arrow_schema(df.schema), *made]))
    schema = type(schema)([*df.schema.fields, *schema.fields[len(columns) :]])
    table = materialise(ordered.mapInArrow(local, schema), "running")
    edges = table.where(F.col(_FIRST) | F.col(_LAST)).select("range", _FIRST, _LAST, F.struct(*key).alias("k") if key else F.lit(0).alias("k"), *mine).collect()
    first, last = {r["range"]: r["k"] for r in edges if r[_FIRST]}, {r["range"]: r for r in edges if r[_LAST]}
    carried: dict[int, tuple] = {}
    before = None  # key and state at the end of the range before
    for number in sorted(first):
        end, state = last[number], tuple(last[number][c] for c in mine)
        if before is not None and before[0] == first[number]:
            carried[number] = before[1]
            if end["k"] == first[number]:
                one = [pa.array([x], f.type) for x, f in zip(state, fold.fields, strict=True)]
                state = tuple(c[0].as_py() for c in fold.joined(before[1], one))
        before = end["k"], state
    if not carried:
        return table.select(*columns, *mine)

    def take_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            states = [rows.column(c) for c in mine]
            head, number = rows.column(_HEAD).to_numpy(zero_copy_only=False), rows.column("range").to_numpy()
            for k in np.unique(number[head]).tolist():
                if k in carried:
                    at = np.flatnonzero(head & (number == k))
                    place = np.arange(rows.num_rows)
                    place[at] = rows.num_rows + np.arange(len(at))
                    new = fold.joined(carried[k], [s.take(pa.array(at)) for s in states])
                    states = [pa.concat_arrays([s, n.cast(s.type)]).take(pa.array(place)) for s, n in zip(states, new, strict=True)]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in columns], *states], names=[*columns, *mine])

    # only rows of a range's first key may change; all others are read as they are
    begun = table.where(_HEAD).mapInArrow(take_up, type(schema)(schema.fields[: len(columns) + len(mine)]))
    return table.where(~F.col(_HEAD)).select(*columns, *mine).unionByName(begun)


def numbered(df: DataFrame, order: Sequence[str | Column], name: str, key: Sequence[str] = ()) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1: within its key, or among all rows without a task that sees them all."""
    return running(df.withColumn("one", F.lit(1).cast("long")), key, order, Sums(**{name: "one"})).drop("one")
