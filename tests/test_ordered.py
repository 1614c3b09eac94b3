"""Running states over ranges: one key in many tasks gives what a plain loop gives."""

import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitmark.operators import ranking as R
from pitmark.operators import temporal as J
from pitmark.operators.ordered import Steps, Sums, numbered, running

DAY = datetime.date(2000, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


@pytest.fixture
def ranges(spark):
    """Eight ranges however few the rows are."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_sums_equal_a_plain_loop(ranges):
    rng = random.Random(0)
    rows = [(rng.choice([None, "a", "a", "a", "a", "b", "c"]), i, rng.randint(-5, 5) if rng.random() < 0.9 else None) for i in range(3000)]
    got = {r.i: r.total for r in running(ranges.createDataFrame(rows, "k string, i long, v long"), ["k"], ["i"], Sums(total="v")).collect()}
    sums = {}
    for k, i, v in rows:
        sums[k] = sums.get(k, 0) + (v or 0)
        assert got[i] == sums[k]
    big = ranges.createDataFrame([(0, 2**62), (1, 2**62), (2, 2**62), (3, -(2**62))], "i long, v long")
    assert [r.t for r in sorted(running(big, [], ["i"], Sums(t="v")).collect())] == [2**62, -(2**63), -(2**62), -(2**63)]


def test_order_matters_and_one_key_spans_all_ranges(ranges):
    fold = Steps(["w"], pa.schema([("said", pa.string())]), lambda w: (w,), lambda a, b: (a[0] + b[0],))
    rows = [("x", i, chr(97 + i % 26)) for i in range(400)] + [("y", 0, "!")]
    got = sorted(running(ranges.createDataFrame(rows, "k string, i long, w string"), ["k"], ["i"], fold).collect(), key=lambda r: (r.k, r.i))
    text = "".join(r[2] for r in rows[:-1])
    assert [r.said for r in got] == [text[: i + 1] for i in range(400)] + ["!"]


def test_numbers_follow_descending_order_and_nulls(ranges):
    rows = [(i, (i * 37) % 11 if i % 7 else None) for i in range(500)]
    got = {r.i: r.n for r in numbered(ranges.createDataFrame(rows, "i long, v long"), [F.desc("v"), "i"], "n").collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {i: k + 1 for k, (i, _) in enumerate(want)}
    assert numbered(ranges.createDataFrame([], "i long"), ["i"], "n").collect() == []


def plain_status(notices, first, last):
    status, since, intervals, errors = "TRADING", first, [], []
    for at, _, event in sorted(n for n in notices if first <= n[0] <= last):
        to = J.TRANSITIONS.get((status, event))
        if to is None:
            errors.append((status, event, at))
            continue
        if at - datetime.timedelta(days=1) >= since:
            intervals.append((status, since, at - datetime.timedelta(days=1)))
        status, since = to, at
    return intervals + ([(status, since, last)] if since <= last else []), errors


def test_one_security_with_very_many_notices_equals_the_fold(ranges):
    rng = random.Random(4)
    events = ["SUSPEND", "RESUME", "DELIST", "RELIST", "SUSPEND", "RESUME", "OTHER"]
    hot = [(day(rng.randrange(40_000)), k, rng.choice(events)) for k in range(60_000)]
    few = {code: [(day(rng.randrange(40_000)), k, rng.choice(events)) for k in range(rng.randint(1, 5))] for code in map(str, range(50))}
    few["hot"] = hot
    rows = [(code, *n) for code, some in few.items() for n in some]
    df = ranges.createDataFrame(rows, "security_code string, effective_date date, notice_id long, event_type string")
    first, last = day(100), day(39_000)
    intervals, errors = {}, {}
    for r in J.status_intervals(df, str(first), str(last)).collect():
        intervals.setdefault(r.security_code, []).append((r.status, r.effective_from, r.effective_to))
    for r in J.status_transition_errors(df, str(first), str(last)).collect():
        errors.setdefault(r.security_code, []).append((r.status, r.event_type, r.effective_date))
    for code, some in few.items():
        want, wrong = plain_status(some, first, last)
        if any(first <= n[0] <= last for n in some):
            assert sorted(intervals.get(code, [])) == sorted(want), code
            assert sorted(errors.get(code, [])) == sorted(wrong), code
        else:
            assert code not in intervals


@pytest.mark.parametrize("half_open", [False, True])
def test_facts_of_a_hot_code_with_very_many_intervals(ranges, half_open):
    rng = random.Random(5)
    spans = [("hot", day(3 * k), day(3 * k + rng.choice([-1, 0, 1, 2, 2])), f"v{k}") for k in range(20_000)]
    spans += [("a", day(1), None, "open"), ("a", None, day(3), "no start"), ("b", day(1), day(9), "x"), ("b", day(1), day(9), "x"), (None, day(0), None, "null code")]
    facts = [("hot", day(rng.randrange(60_010)), k) for k in range(3_000)] + [("a", day(0), 1), ("a", day(1), 2), ("a", day(99), 3), ("a", None, 4), ("b", day(9), 5), ("b", day(10), 6), (None, day(5), 7), ("none", day(5), 8)]
    facts += facts[-8:]
    intervals = ranges.createDataFrame(spans, "security_code string, valid_from date, valid_to date, v string")
    asked = ranges.createDataFrame(facts, "security_code string, on date, fact long")
    got = J.resolve_as_of(asked, ["fact"], "on", intervals, "v", half_open=half_open).collect()
    by_code = {}
    for code, start, end, v in spans:
        if code is not None and start is not None:
            by_code.setdefault(code, []).append((start, end, v))
    want = []
    for code, at, k in facts:
        hits = [v for s, e, v in by_code.get(code, []) if at is not None and s <= at and (e is None or (at < e if half_open else at <= e))]
        want.append((k, code, at, hits[0] if len(hits) == 1 else None, ("MISSING", "MATCHED")[len(hits)] if len(hits) < 2 else "AMBIGUOUS"))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_the_as_of_join_multiplies_nothing(ranges):
    intervals = ranges.createDataFrame([("x", day(0), None, k) for k in range(3_000)], "security_code string, valid_from date, valid_to date, interval_id long")
    facts = ranges.createDataFrame([("x", day(k)) for k in range(3_000)], "security_code string, on date")
    found = J.in_force(facts, ["security_code"], "on", intervals, "valid_from", "valid_to")
    assert {(r.matches, r.interval_id) for r in found.collect()} == {(3_000, None)} and found.count() == 3_000
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_bar_conflicts_twice(ranges):
    status = ranges.createDataFrame([("x", "SUSPENDED", day(0), day(9))], "security_code string, status string, effective_from date, effective_to date")
    allowed = ranges.createDataFrame([("TRADING", "TRADED")], "status string, trading_state string")
    bars = ranges.createDataFrame([("x", day(3), "TRADED"), ("x", day(3), "TRADED"), ("x", day(30), "TRADED")], "security_code string, trade_date date, trading_state string")
    assert [tuple(r) for r in J.state_status_conflicts(bars, status, allowed).collect()] == [("x", day(3), "TRADED", "SUSPENDED")] * 2


def test_collisions_of_a_hot_isin_are_linear_and_lose_no_group(ranges):
    rng = random.Random(6)
    rows = [("I", str(rng.randrange(400)), "MAIN", day(s := rng.randrange(9_000)), None if rng.random() < 0.01 else day(s + rng.randrange(60))) for _ in range(2_000)]
    rows += [("J", "1", "MAIN", day(0), day(5)), ("J", "1", "MAIN", day(2), day(9)), ("J", "2", "MAIN", day(10), None), (None, "3", "MAIN", day(0), None), ("K", "4", "MAIN", None, None)]
    df = ranges.createDataFrame(rows, "isin string, security_code string, board string, valid_from date, valid_to date")
    got = J.collision_links(df).collect()
    assert len(got) <= len(rows) and {r.isin for r in got} == {"I"}

    def groups(edges):
        at = {}
        find = lambda x: x if at.setdefault(x, x) == x else find(at[x])
        for a, b in edges:
            at[find(a)] = find(b)
        return sorted(sorted(x for x in at if find(x) == r) for r in {find(x) for x in at})

    late = lambda x: x or datetime.date.max
    pairs = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] == "I" and a[1] != b[1] and a[3] <= late(b[4]) and b[3] <= late(a[4])}
    links = {(r.security_code, r.with_listing.split('"')[3]) for r in got}
    assert links <= pairs and groups(links) == groups(pairs)


def test_ranks_have_no_window_over_all_rows(ranges):
    weights = {"f": 1.0}
    df = ranges.createDataFrame([(f"c{i:04d}", float(i * 7 % 50) if i % 9 else None) for i in range(1_000)], "security_code string, f double")
    ranked = R.heuristic_rank(df, 10, weights=weights)
    got = {r.security_code: (r["rank"], r.selected) for r in ranked.collect()}
    some = sorted(((-float(i * 7 % 50), f"c{i:04d}") for i in range(1_000) if i % 9))
    assert got == {c: (k + 1, k < 10) for k, (_, c) in enumerate(some)} | {f"c{i:04d}": (None, False) for i in range(0, 1_000, 9)}
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    wrong = df.select(F.lit(1).alias("decision_id"), "security_code", F.coalesce("f", F.lit(-1.0)).alias("score"), F.lit(1).alias("rank"), F.lit(False).alias("selected"))
    found = R.rank_consistency(wrong, 0)
    assert found.count() == 999 and "Window" not in found._jdf.queryExecution().executedPlan().toString()
