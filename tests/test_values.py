"""Hand-computed values on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitmark.functions.columns import isin_is_valid, names_compatible, registrable_domain
from pitmark.operators import actions, components, evaluation, events, market, ranking, row_quality, signals, temporal
from pitmark.sources import contracts
from pitmark.streaming import streams

TERMS = "action_id string, security_code string, action_type string, formula_mode string, previous_close decimal(18,8), cash decimal(18,8), new_shares decimal(18,8), rights_ratio decimal(18,8), subscription_price decimal(18,8), official_factor decimal(18,8), official_reference decimal(18,8), official_quantity decimal(18,8), fractional_policy string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def terms(kind, mode="REPRODUCIBLE_MECHANICAL", close="100", cash=None, new=None, ratio=None, price=None):
    d = lambda x: None if x is None else Decimal(x)
    return ("a", "1", kind, mode, d(close), d(cash), d(new), d(ratio), d(price), None, None, None, "NOT_APPLICABLE")


@pytest.mark.parametrize(
    ("row", "price", "quantity", "ready", "status"),
    [
        (terms("CASH_DIVIDEND_NORMAL", cash="5"), "95", "1", True, "reproducible"), (terms("BONUS_SHARES", new="0.25"), "80", "1.25", True, "reproducible"),
        (terms("RIGHTS_ISSUE", ratio="0.5", price="60"), "86.666666666667", "1.5", False, "reproducible"), (terms("STOCK_SPLIT", new="0.5"), None, None, False, "error"),
        (terms("MERGER", mode="NO_AUTOMATIC_FORMULA"), None, None, False, "pending"), (terms("MERGER"), None, None, False, "error"), (terms("CASH_DIVIDEND_NORMAL", cash="100"), None, None, False, "error"),
    ],
)
def test_adjustment_factors(spark, row, price, quantity, ready, status):
    r = actions.adjustment_factors(spark.createDataFrame([row], TERMS)).first()
    assert r.theoretical_ex_price == (None if price is None else Decimal(price))
    assert r.quantity_multiplier == (None if quantity is None else Decimal(quantity))
    assert (r.return_ready, r.factor_status) == (ready, status)


def test_missing_volume_is_not_zero_volume(spark):
    rows = [("1", day(1), 10.0, 5.0, 50.0), ("1", day(2), 11.0, None, 40.0), ("1", day(3), 11.0, 0.0, 0.0)]
    r = signals.liquidity_metrics(spark.createDataFrame(rows, "security_code string, trade_date date, close double, volume double, turnover double")).first()
    assert (r.sessions, r.traded_sessions, r.missing_volume_sessions, r.zero_volume_sessions, r.zero_return_sessions) == (3, 1, 1, 1, 1)
    assert r.nontrading_ratio == pytest.approx(2 / 3) and r.amihud_illiquidity is None


def test_status_intervals_tile_the_window(spark):
    n = spark.createDataFrame([("7", day(5), 1, "SUSPEND"), ("7", day(8), 2, "RESUME"), ("7", day(9), 3, "RELIST"), ("7", day(12), 4, "SUSPEND"), ("8", day(1), 5, "SUSPEND")], "security_code string, effective_date date, notice_id long, event_type string")
    got = [tuple(r) for r in temporal.status_intervals(n, "2024-01-01", "2024-01-20").orderBy("security_code", "effective_from").collect()]
    assert got == [("7", "TRADING", day(1), day(4)), ("7", "SUSPENDED", day(5), day(7)), ("7", "TRADING", day(8), day(11)), ("7", "SUSPENDED", day(12), day(20)), ("8", "SUSPENDED", day(1), day(20))]
    assert [r.event_type for r in temporal.status_transition_errors(n, "2024-01-01", "2024-01-20").collect()] == ["RELIST"]


def test_due_session_skips_holidays_and_suspensions(spark):
    cal = spark.createDataFrame([(day(n), n not in (3, 4)) for n in range(1, 15)], "trade_date date, is_trading_day boolean")
    status = spark.createDataFrame([("7", "TRADING", day(1), day(5)), ("7", "SUSPENDED", day(6), day(8)), ("7", "TRADING", day(9), day(14))], "security_code string, status string, effective_from date, effective_to date")
    due = temporal.nth_session_due(spark.createDataFrame([(1, "7", day(2)), (2, "7", day(12))], "decision_id long, security_code string, decision_date date"), cal, status, 3)
    assert {r.decision_id: (r.due_date, r.code) for r in due.collect()} == {1: (day(10), "OK"), 2: (None, "HORIZON_NOT_COVERED")}


EVENT = "event_id long, security_code string, source_id string, source_role string, direction string, novelty double, event_at timestamp_ntz, published_at timestamp_ntz, first_available_at timestamp_ntz, captured_at timestamp_ntz, content_hash string, origin_id string, original_event_id long"


def event(i, source="s", content="c", origin="o", parent=None, hour=0):
    t = dt.datetime(2024, 1, 1, hour)
    return (i, "1", source, "NEWS_CONTEXT", "POSITIVE", 0.5, t, t, t, t, content, origin, parent)


def test_repost_is_one_event_with_its_sources(spark):
    r = events.canonical_events(spark.createDataFrame([event(1, "a", "x"), event(2, "b", "y", parent=1, hour=2)], EVENT)).collect()
    assert len(r) == 1 and r[0].canonical_event_id == "1" and r[0].diffusion_count == 2 and r[0].source_diversity == 2


def test_origin_and_content_link_transitively(spark):
    rows = [event(1, content="a", origin="x"), event(2, content="b", origin="x"), event(3, content="b", origin="y"), event(4, content="z", origin="w")]
    got = {r.event_id: r.component for r in events.context_components(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_window_tags_include_their_ends(spark):
    r = spark.createDataFrame([(a,) for a in (3.0, 7.0, 30.0, 120.0, 120.1)], "a double").select(events.window_tags(F.col("a")).alias("t")).collect()
    assert [len(x.t) for x in r] == [4, 3, 2, 1, 0]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert set(got.values()) == {1, 100} and got[160] == 100 and got[59] == 1
    assert components.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_purge_keeps_what_ended_before_the_first_cutoff(spark):
    train = spark.createDataFrame([(1, day(5)), (2, day(10)), (3, None)], "sample_id long, label_end date")
    test = spark.createDataFrame([(day(10),), (day(20),)], "feature_cutoff date")
    assert {r.sample_id: r.kept for r in evaluation.purge_embargo(train, test).collect()} == {1: True, 2: False, 3: False}


def test_rank_ic_with_ties_and_constants(spark):
    rows = [("d", "1", 1.0, 1.0), ("d", "2", 1.0, 2.0), ("d", "3", 2.0, 3.0), ("e", "1", 1.0, 1.0), ("e", "2", 1.0, 2.0)]
    got = {r.decision_id: r.rank_ic for r in evaluation.rank_ic(spark.createDataFrame(rows, "decision_id string, security_code string, score double, outcome double")).collect()}
    assert got["d"] == pytest.approx(0.8660254) and got["e"] is None


def test_disagreeing_providers_are_not_merged(spark):
    rows = [("1", "A", 1.0, "h1"), ("1", "B", 1.0, "h2"), ("2", "A", 1.0, "h3"), ("2", "B", 2.0, "h4")]
    got = {r.k: (r.agreed, r.primary_provider, r.close) for r in market.merge_providers(spark.createDataFrame(rows, "k string, provider_id string, close double, evidence_hash string"), ["k"], ["close"]).collect()}
    assert got == {"1": (True, "A", 1.0), "2": (False, "A", None)}


def test_gaps_are_reported_not_filled(spark):
    s = spark.createDataFrame([("x", day(1)), ("x", day(4))], "k string, trade_date date")
    cal = spark.createDataFrame([(day(n), n != 4) for n in range(1, 5)], "trade_date date, is_trading_day boolean")
    r = row_quality.series_coverage(s, cal, "k").first()
    assert (r.n_rows, r.missing_dates, r.extra_dates) == (2, 2, 1)


def test_identifiers(spark):
    r = spark.createDataFrame([("US0378331005",), ("US0378331006",), ("XX",), (None,)], "i string").select(isin_is_valid(F.col("i")).alias("v")).collect()
    assert [x.v for x in r] == [True, False, False, None]
    assert spark.range(1).select(registrable_domain(F.lit("a.b.com.kw")).alias("d")).first().d == "b.com.kw"
    assert spark.range(1).select(names_compatible(F.lit("Gulf Bank K.S.C.P."), F.lit("GULF BANK")).alias("c")).first().c is not None


def test_abstainers_have_no_rank(spark):
    columns = list(ranking.FEATURE_WEIGHTS)
    schema = T.StructType([T.StructField("security_code", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in columns]])
    got = {r.security_code: (r["rank"], r.selected, r.abstained) for r in ranking.heuristic_rank(spark.createDataFrame([("b", *[1.0] * 6), ("a", *[1.0] * 6), ("c", 1.0, *[None] * 5)], schema), 1).collect()}
    assert got == {"a": (1, True, False), "b": (2, False, False), "c": (None, False, True)}


def test_contract_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("﻿a,b\n1,x\n2\n3,y,z\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    good, bad = contracts.read_contract_csv(spark, str(tmp_path), schema)
    assert [tuple(r) for r in good.collect()] == [(1, "x")] and sorted(r.raw for r in bad.collect()) == ["2", "3,y,z"]
    assert contracts.header_errors(spark, str(tmp_path), schema).count() == 0
    other = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert contracts.header_errors(spark, str(tmp_path), other).first().code == "HEADER_MISMATCH"


def test_manifest_and_artifacts(spark, tmp_path):
    import hashlib
    import json

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a").write_bytes(b"1")
    (raw / "b").write_bytes(b"2")
    (raw / "d").write_bytes(b"4")
    item = lambda n, text, size: {"path": f"raw/{n}", "sha256": hashlib.sha256(text).hexdigest(), "size_bytes": size}
    (tmp_path / "m.json").write_text(json.dumps({"artifacts": [item("a", b"1", 1), item("b", b"x", 1), item("c", b"3", 1)]}))
    manifest = contracts.read_manifest(spark, str(tmp_path / "m.json"))
    assert {r.name: r.code for r in contracts.verify_artifacts(manifest, str(raw)).collect()} == {"a": "OK", "b": "HASH_MISMATCH", "c": "MISSING", "d": "UNREFERENCED"}


def test_a_dataset_is_written_in_order_and_once(spark, tmp_path):
    out = str(tmp_path / "out")
    contracts.write_dataset(spark.range(100).select((99 - F.col("id")).alias("k")), out, ["k"], 2)
    assert [r.k for r in spark.read.parquet(out).where("k < 10").collect()] == list(range(10))
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        contracts.write_dataset(spark.range(1).select(F.col("id").alias("k")), out, ["k"])


def test_streamed_status_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.STATE_STORE)
    n = spark.createDataFrame([("7", day(5), 1, "SUSPEND"), ("7", day(8), 2, "RESUME"), ("7", day(9), 3, "RELIST"), ("8", day(4), 4, "DELIST")], "security_code string, effective_date date, notice_id long, event_type string")
    n.write.parquet(str(tmp_path / "in"))
    got = streams.run_available(streams.status_intervals(streams.read_stream(spark, str(tmp_path / "in")), first="2024-01-01"), str(tmp_path / "out"), str(tmp_path / "state"))
    closed = temporal.status_intervals(n, "2024-01-01", "2024-01-20").where("effective_to < date '2024-01-20'")
    assert {tuple(r) for r in got.where("kind = 'INTERVAL'").select("security_code", "status", "effective_from", "effective_to").collect()} == {tuple(r) for r in closed.collect()}
    assert got.where("kind = 'ERROR'").count() == 1
