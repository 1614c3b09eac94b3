"""Streams in micro-batches: order of arrival, replays, one reading of the source; and digests of ordered rows."""

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pitmark.operators import ledger as L
from pitmark.streaming import streams as T

T0 = datetime.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, T.STATE_STORE)
    yield spark
    spark.conf.set(key, before)


def feed(spark, tmp_path, batches, schema):
    """A stream that hands over one list of rows at a time."""
    at = tmp_path / "in"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(at / f"part={k:03d}"))
    files = sorted(at.glob("*/*.parquet"))
    for k, f in enumerate(files):  # older files come first
        import os

        os.utime(f, (1_000_000 + k * 100, 1_000_000 + k * 100))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(at / "part=*"))


EVENTS = "ledger_id long, seq long, previous_hash string, event_hash string, at timestamp"


def chain(ledger, n, broken=()):
    rows = []
    for k in range(1, n + 1):
        rows.append((ledger, k, None if k == 1 else "wrong" if k in broken else f"h{ledger}-{k - 1}", f"h{ledger}-{k}", T0 + datetime.timedelta(minutes=k)))
    return rows


def test_shuffled_micro_batches_give_the_batch_result(rocks, tmp_path):
    rows = chain(1, 12) + chain(2, 9, broken={4, 9}) + chain(3, 1) + [(4, 1, "x", "y", T0)]
    want = sorted(tuple(r) for r in L.chain_violations(rocks.createDataFrame(rows, EVENTS).drop("at")).select("ledger_id", "seq", "code").collect())
    assert {c for _, _, c in want} == {"PREVIOUS_HASH_BREAK", "FIRST_HAS_PREVIOUS"}
    random.Random(1).shuffle(rows)
    stream = feed(rocks, tmp_path, [rows[:6], rows[6:12], rows[12:18], rows[18:]], EVENTS)
    got = T.run_available(T.chain_check(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_a_gap_is_reported_when_patience_ends_and_what_follows_is_late(rocks, tmp_path):
    a = chain(1, 6)
    late = T0 + datetime.timedelta(hours=5)
    batches = [[a[0], a[3], a[4]], [(9, 1, None, "z", late)], [(9, 2, "z", "zz", late + datetime.timedelta(minutes=1))], [(1, 2, "h1-1", "h1-2", late + datetime.timedelta(minutes=2)), (1, 6, "h1-5", "h1-6", late + datetime.timedelta(minutes=2))]]
    stream = feed(rocks, tmp_path, batches, EVENTS)
    got = T.run_available(T.chain_check(stream, "at", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, "LATE_OR_REPEATED"), (1, 4, "PREVIOUS_HASH_BREAK"), (1, 4, "SEQUENCE_GAP")]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    schema = "source_id long, ts timestamp, v long"
    hour = lambda k: T0 + datetime.timedelta(hours=k)
    stream = feed(spark, tmp_path, [[(1, hour(1), 1), (1, hour(5), 2), (2, hour(1), 3)], [(1, hour(4), 4), (1, hour(9), 5), (3, hour(2), 6)]], schema)
    marks = spark.createDataFrame([(1, hour(2)), (7, hour(3))], "source_id long, watermark timestamp")
    out = str(tmp_path / "out")

    def run(state):
        T.incremental_run(stream, marks, out, str(tmp_path / state))
        rows = sorted(r.v for r in T.incremental_rows(spark, out).collect())
        return rows, {r.source_id: r.watermark for r in T.current_watermarks(spark, out, marks).collect()}

    want = ([2, 3, 5, 6], {1: hour(9), 2: hour(1), 3: hour(2), 7: hour(3)})
    assert run("state") == want
    assert run("state") == want  # nothing new
    assert run("lost") == want  # with its checkpoint lost, every batch is replayed under its number
    # a batch whose commit is missing doesn't count
    (tmp_path / "out/watermarks/batch=1/_SUCCESS").unlink()
    assert sorted(r.v for r in T.incremental_rows(spark, out).collect()) == [2, 3]


def test_the_source_of_late_rows_is_read_once(spark, tmp_path):
    schema = "event_id long, captured_at timestamp, first_available_at timestamp"
    days = lambda k: T0 + datetime.timedelta(days=k)
    rows = [(k, days(k % 9), days(-k)) for k in range(200)] + [(900, None, None)]
    stream = feed(spark, tmp_path, [rows[:100], rows[100:]], schema)
    counts = T.late_rows(stream, F.lit(days(5)), str(tmp_path / "out"), str(tmp_path / "state"))
    late = {k for k, captured, first in rows if captured is not None and (captured > days(5) or first < days(-115))}
    assert [(c["rows"], c["late"]) for c in counts] == [(100, len([k for k in late if k < 100])), (101, len([k for k in late if k >= 100]))]
    for side, want in ((True, late), (False, {r[0] for r in rows} - late)):
        got = [r.event_id for r in T.split(spark, str(tmp_path / "out"), stream.schema, side).collect()]
        assert len(got) == len(want) and set(got) == want


def test_digests_are_those_of_the_whole_text(spark):
    rng = random.Random(2)
    rows = [(k % 3 if k % 3 else None, k, f"h{k}", rng.choice(["é", "line", None]) and f"line {k}") for k in range(3_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "ledger_id long, seq long, event_hash string, line string")
    got = {r.ledger_id: r for r in L.ledger_seal(df).collect()}
    for key in (None, 1, 2):
        mine = sorted(r[1:] for r in rows if r[0] == key)
        text = "".join(f"{line or ''}\n" for _, _, line in mine)
        assert (got[key].event_count, got[key].first_event_hash, got[key].last_event_hash, got[key].content_sha256) == (1_000, mine[0][1], mine[-1][1], hashlib.sha256(text.encode()).hexdigest())
    files = spark.createDataFrame([("p", "b", "2"), ("p", "a", "1"), ("q", "z", "9")], "packet_id string, path string, sha256 string")
    want = hashlib.sha256(b'[{"path":"a","sha256":"1"},{"path":"b","sha256":"2"}]\n').hexdigest()
    assert {r.packet_id: (r.n_files, r.packet_sha256) for r in L.packet_hash(files).collect()}["p"] == (2, want)
    assert L.ledger_seal(df.where("false")).collect() == []


def test_a_ledger_of_very_many_events_has_one_digest(spark):
    n = 300_000
    df = spark.range(n).selectExpr("7L ledger_id", "id seq", "concat('h', id) event_hash", "concat('{\"seq\":', id, '}') line")
    (r,) = L.ledger_seal(df).collect()
    assert (r.event_count, r.content_sha256) == (n, hashlib.sha256("".join(f'{{"seq":{k}}}\n' for k in range(n)).encode()).hexdigest())
