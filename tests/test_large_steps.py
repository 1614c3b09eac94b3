"""Steps that larger tables made slow: gaps of a grid, notices in batches."""

import datetime as dt

import numpy as np
import pyarrow as pa

from pitmark.operators import row_quality, temporal


def test_gaps_of_a_grid_are_found_without_it(spark):
    d = lambda k: dt.date(2024, 1, k)
    rows = [("a", d(1)), ("a", d(1)), ("a", d(9)), ("b", None), (None, d(2))]
    actual = spark.createDataFrame(rows, "k string, t date")
    days = spark.createDataFrame([(d(1),), (d(2),)], "t date")
    got = row_quality.grid_gaps(actual, days, "k", "t")
    grid = actual.select("k").distinct().crossJoin(days)
    want = grid.subtract(actual).selectExpr("*", "'MISSING' gap").unionByName(actual.subtract(grid).selectExpr("*", "'EXTRA' gap"))
    rows_of = lambda df: sorted(map(repr, df.collect()))
    assert rows_of(got) == rows_of(want)
    # keys meet days in one place only: no join on the grid's cells
    assert "LeftAnti" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_notices_compose_in_batches_as_one_by_one(spark):
    names = ["DELISTED", "SUSPENDED", "TRADING"]
    fold = temporal._Transitions(names)
    rng = np.random.default_rng(3)
    n = 400
    events = [["SUSPEND", "RESUME", "DELIST", "RELIST", "OTHER", None][k] for k in rng.integers(0, 6, n)]
    new = rng.random(n) < 0.02
    new[0], new[250:] = False, False
    rows = pa.RecordBatch.from_arrays([pa.array(events, pa.string()), pa.array(range(n), pa.int32())], names=["event_type", "day"])
    before = ([1, 5, 2, None, 1, None, 1, None, 0, 4, 2, 3],)

    def step(state, event, day):
        out = []
        for k in range(3):
            now, since = state[4 * k], state[4 * k + 1]
            to = temporal.TRANSITIONS.get((names[now], event))
            out += [now if to is None else names.index(to), since if to is None else day, now, since]
        return out

    want, state = [], before[0]
    for k in range(n):
        state = step([x for s in range(3) for x in (s, None, s, None)] if new[k] else state, events[k], k)
        want.append(state)
    got = fold.prefixes(rows, new, before)[0].to_pylist()
    assert got == want
    head = int(np.argmax(new)) if new.any() else n
    alone = fold.prefixes(rows.slice(0, head), new[:head], None)
    assert fold.joined(before, alone)[0].to_pylist() == want[:head]
