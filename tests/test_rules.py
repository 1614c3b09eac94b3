"""Rules of contracts against literal rows, one fault a row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitmark.functions import columns as fn
from pitmark.operators import actions, coverage, evaluation, events, ledger, market, ranking, row_quality, signals, temporal

T0 = dt.datetime(2024, 5, 1, 12)
HASH = "a" * 64


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def codes_of(df, *keys):
    out = {}
    for r in df.collect():
        out.setdefault(tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]], set()).add(r.code)
    return out


def test_hosts_names_and_keys(spark):
    hosts = {"192.168.10.7": "192.168.10.7", "A.B.Co.Uk": "b.co.uk", "shop.example.com.": "example.com", "localhost": None, "a..com": None, "": None, "[2001:db8::1]": "2001:db8::1", "x.y.z.com.kw": "z.com.kw"}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r.h: r.d for r in df.select("h", fn.registrable_domain(F.col("h")).alias("d")).collect()} == hosts
    names = spark.createDataFrame([("KSC", "The KSCP", True), ("ABC KSC", "The KSCP", False), ("Zain Telecom Co", "ZAIN TELECOMMUNICATIONS COMPANY", True)], "a string, b string, want boolean")
    assert all(r.want == r.got for r in names.select("want", fn.names_compatible(F.col("a"), F.col("b")).alias("got")).collect())
    urls = {"https://x/?mytoken=1": False, "https://x/?my_token=1": True, "https://x/?my-token=1": True, "https://x/?X-Amz-Sig=1": True, "https://x/?ApiKey": True, "https://x/token=1": False, "https://x/?a=1&oauthtoken=2": True, "https://x/?pre_access_token_x=1": True, "https://x/?a=1#?token=2": False, "https://x/?%74oken=1": True}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.k for r in df.select("u", fn.credential_keys(F.col("u")).alias("k")).collect()} == urls


def test_claims_in_compatible_forms(spark):
    df = spark.createDataFrame([("ＡＢＣ１２ oﬃce ﷼ ﻼم plain",)], "t string")
    assert set(df.select(fn.claim_tokens(F.col("t"))).first()[0]) >= {"abc12", "office", "plain"}


def test_activity_of_traded_rows(spark):
    df = spark.createDataFrame([(1, "TRADED", -5.0, 1.0, 1), (2, "TRADED", 5.0, 1.0, 1), (3, "TRADED", 5.0, 1.0, None)], "k int, trading_state string, volume double, turnover double, trade_count int")
    df = df.selectExpr("*", *[f"CASE WHEN k > 0 THEN 1.0 END {c}" for c in ("open", "high", "low", "close")])
    assert codes_of(row_quality.state_activity_violations(df, ["k"]), "k") == {1: {"TRADED_WITHOUT_ACTIVITY"}, 3: {"TRADED_WITHOUT_ACTIVITY"}}


def test_registered_evidence(spark):
    reg = spark.createDataFrame([("pub", "PUBLIC_OFFICIAL_EXPORT", "NONE", "VERIFIED_DEFINITION"), ("draft", "PUBLIC_OFFICIAL_EXPORT", "NONE", "DRAFT"), ("lic", "LICENSED_EXPORT", "EXTERNAL_LICENSE_REQUIRED", "VERIFIED_DEFINITION")], "source_id string, source_access string, rights_requirement string, registry_state string")
    cases = [
        ("pub", "PUBLIC_OFFICIAL_EXPORT", "RESEARCH_USE_AUTHORIZED", "PROVEN_REAL_EVIDENCE", "LIVE_DEPENDENT", "SELF_DECLARED_PROVEN_LOWERED"), ("pub", "PUBLIC_OFFICIAL_EXPORT", "UNKNOWN", None, None, "CAPTURE_MODE_AND_RIGHTS_CONFLICT"), ("pub", "SOURCE_ACCESS_RECEIPT", "UNKNOWN", None, "LIVE_DEPENDENT", None),
        ("pub", "SOURCE_ACCESS_RECEIPT", "RESTRICTED", None, None, "RECEIPT_RIGHTS_DIFFER"), ("draft", "USER_PROVIDED_OFFICIAL_EXPORT", "RESEARCH_USE_AUTHORIZED", None, None, "DEFINITION_NOT_VERIFIED"), ("lic", "LICENSED_VENDOR_EXPORT", "RESEARCH_USE_AUTHORIZED", None, "LICENSED_FEED_DEPENDENT", None),
        ("pub", "LICENSED_VENDOR_EXPORT", "RESEARCH_USE_AUTHORIZED", None, None, "LICENSED_CAPTURE_OUTSIDE_CONTRACT"), ("lic", "PUBLIC_OFFICIAL_EXPORT", "RESEARCH_USE_AUTHORIZED", None, None, "OFFICIAL_CAPTURE_OUTSIDE_CONTRACT"), ("lic", "SYNTHETIC_GENERATED", "FIXTURE_ONLY", None, "SYNTHETIC_ONLY", None), ("lic", "GUESS", "UNKNOWN", None, None, "CAPTURE_MODE_UNSUPPORTED"), ("no", "SYNTHETIC_GENERATED", "FIXTURE_ONLY", None, None, "SOURCE_NOT_REGISTERED"),
    ]
    rows = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, source_id string, capture_mode string, rights_status string, declared_class string")
    assert {r.i: (r.evidence_class, r.code) for r in row_quality.derive_registered_class(rows, reg).collect()} == {i: c[4:] for i, c in enumerate(cases)}


def test_gaps_and_gates(spark):
    cal = spark.createDataFrame([(dt.date(2024, 1, d), d != 3) for d in (1, 2, 3)], "trade_date date, is_trading_day boolean")
    s = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 3)), ("b", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "k string, trade_date date")
    assert {tuple(r) for r in row_quality.series_gaps(s, cal, "k").collect()} == {("a", dt.date(2024, 1, 2), "MISSING"), ("a", dt.date(2024, 1, 3), "EXTRA")}
    parts = spark.createDataFrame([("g", "PASS", "RESEARCH_USE_AUTHORIZED", "PROVEN_REAL_EVIDENCE", 2), ("g", "PARTIAL", "RESTRICTED", "SYNTHETIC_ONLY", 3)], "gate string, status string, rights_status string, evidence_class string, metric_rows int")
    r = market.gate_matrix(parts).first()
    assert (r.status, r.open_components, r.rights_status, r.evidence_class, r.metric_rows) == ("PARTIAL", 1, "RESTRICTED", "SYNTHETIC_ONLY", 5)
    none = spark.createDataFrame([], "code string")
    good = spark.createDataFrame([("PROVEN_REAL_EVIDENCE", "RESEARCH_USE_AUTHORIZED")], "evidence_class string, rights_status string")
    assert market.eod_readiness(none, none, none, none, none, good).first().overall == "PASS"
    assert market.eod_readiness(none, none, none, none, spark.createDataFrame([("x",)], "code string")).first().overall == "BLOCKED"
    weak = spark.createDataFrame([("LIVE_DEPENDENT", "RESEARCH_USE_AUTHORIZED")], "evidence_class string, rights_status string")
    assert market.eod_readiness(none, none, none, none, none, weak).first().overall == "PARTIAL"
    day = dt.date(2024, 1, 1)
    totals = spark.createDataFrame([(day, 2, 10.0, 5.0, 7)], "trade_date date, traded_securities long, total_volume double, total_value double, total_trades long")
    done = spark.createDataFrame([(day, True)], "trade_date date, complete boolean")
    for trades, want in ((7, "OK"), (8, "MISMATCH"), (None, "NOT_RECONCILABLE")):
        said = spark.createDataFrame([(day, 2, 10.0, 5.0, trades)], totals.schema)
        assert market.reconcile_totals(totals, said, done).first().code == want
    bars = spark.createDataFrame([("e", day), ("e", dt.date(2024, 1, 5)), ("f", day)], "export_id string, trade_date date")
    m = spark.createDataFrame([("e", 3, day, dt.date(2024, 1, 4)), ("h", 1, day, day)], "export_id string, row_count int, date_from date, date_to date")
    assert codes_of(market.reconcile_vendor_exports(bars, m), "export_id") == {"e": {"ROW_COUNT_DIFFERS", "LAST_DATE_DIFFERS"}, "f": {"EXPORT_NOT_IN_MANIFEST"}, "h": {"EXPORT_WITHOUT_ROWS"}}


def test_corrections_stay_apart(spark):
    rows = [(1, "s", "o1", "c1", None, "ORIGINAL"), (2, "s", "o1", "c2", 1, "REPUBLISHED"), (3, "s", "o1", "c1", 1, "CORRECTIVE"), (4, "s", "o4", "c4", 1, "SUPPLEMENTARY"), (5, "s", "o5", "c2", None, "STANDALONE")]
    e = spark.createDataFrame(rows, "event_id int, security_code string, origin_id string, content_hash string, original_event_id int, relation_type string")
    assert {r.event_id: r.component for r in events.context_components(e).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
    assert {r.event_id: r.component for r in events.context_components(e.drop("relation_type")).collect()} == dict.fromkeys(range(1, 6), 1)


@pytest.mark.parametrize("n", [40, 2000])
def test_copies_make_no_clique(spark, n):
    words = "one two three four five six seven eight nine ten eleven twelve"
    near = words + " thirteen"
    day = 24 * 3600
    f = spark.range(n).selectExpr("id finding_id", "'s' security_code", "'K' signal_kind", "'POSITIVE' direction", "concat('e', id) event_key", "concat('o', id) origin_id", f"IF(id % 4 = 3, '{near}', '{words}') claim_text", f"timestamp_seconds(1700000000 + (id % 10) * {day}) available_at")
    pairs = events.near_duplicate_pairs(f).collect()
    assert len(pairs) == n - 1 and all(r.a < r.b for r in pairs)
    assert {r.cluster for r in events.claim_clusters(f, events.near_duplicate_pairs(f)).collect()} == {0}


def test_copies_far_apart_in_time(spark):
    text = "one two three four five six seven"
    rows = [(i, "s", "K", "POSITIVE", f"e{i}", f"o{i}", text, at(h)) for i, h in enumerate((0, 70, 143, 216, 300, 371, 372))]
    f = spark.createDataFrame(rows, "finding_id long, security_code string, signal_kind string, direction string, event_key string, origin_id string, claim_text string, available_at timestamp")
    got = {r.finding_id: r.cluster for r in events.claim_clusters(f, events.near_duplicate_pairs(f)).collect()}
    # 70 and 143 are 73 hours apart, 143 and 216 too, 216 and 300 are 84
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4}


def test_exposures_and_facts(spark):
    canon = spark.createDataFrame([("e", ["a"], "SECURITY", "1", at(0), "CONTESTED", "SUPERSEDED", ["COMMUNITY"], [HASH])], "canonical_event_id string, source_ids array<string>, scope string, scope_key string, first_available_at timestamp, factual_status string, correction_status string, source_classes array<string>, evidence_hashes array<string>")
    rows = [(1, "e", "2", "DIRECT_NAMED", "REPORTED", True, at(-1), ["b"]), (2, "e", "1", "DIRECT_NAMED", "ANALYTICAL_INFERENCE", False, at(1), [HASH]), (3, "e", "1", "INFERRED_EXPOSURE", "REPORTED", False, at(1), [HASH]), (4, "e", "1", "UNRESOLVED", "UNRESOLVED", True, at(1), [HASH])]
    x = spark.createDataFrame([(*r, ["a"], 0.9, "CONSISTENT") for r in rows], "exposure_id int, canonical_event_id string, security_code string, exposure_type string, confirmation_class string, factor_eligible boolean, available_at timestamp, evidence_hashes array<string>, sources array<string>, confidence double, contradiction_status string")
    got = codes_of(events.exposure_violations(x, canon, spark.createDataFrame([("1",), ("2",)], "security_code string")), "exposure_id")
    weak = {"FACTOR_FROM_CONTESTED_EVENT", "FACTOR_FROM_SUPERSEDED_EVENT", "FACTOR_FROM_WEAK_SOURCES"}
    assert got == {1: {"SECURITY_SCOPE_CONFLICT", "EVIDENCE_HASHES_DO_NOT_BIND", "EXPOSURE_BEFORE_EVENT"} | weak, 2: {"DIRECT_EXPOSURE_AS_INFERENCE"}, 3: {"INFERENCE_RELABELLED"}, 4: {"UNRESOLVED_FACTOR"} | weak}
    src = spark.createDataFrame([("gaz", ["OFFICIAL_GAZETTE"], "PRIMARY_OFFICIAL"), ("blog", ["OPINION"], "COMMUNITY"), ("news", ["NEWS"], "SECONDARY")], "source_id string, roles array<string>, tier string")
    claims = spark.createDataFrame([(1, "COMPANY_STATUS", ["gaz"], None, "OFFICIAL_CONFIRMED"), (2, "COMPANY_STATUS", ["news"], None, "OFFICIAL_CONFIRMED"), (3, "COURT_OUTCOME", ["gaz"], None, None), (4, "COURT_OUTCOME", ["blog"], "FINAL", None), (5, "SOCIAL_SENTIMENT", ["blog"], None, None), (6, "PRICE", [], None, None), (7, "PRICE", ["who"], None, None)], "claim_id int, fact_type string, source_ids array<string>, legal_status string, factual_status string")
    assert codes_of(events.fact_type_violations(claims, src), "claim_id") == {2: {"REGISTRY_ROLE_MISSING", "PRIMARY_TIER_MISSING", "CONFIRMED_WITHOUT_PRIMARY"}, 3: {"LEGAL_STATUS_MISSING"}, 4: {"LEGAL_ROLE_MISSING", "COMMUNITY_CANNOT_ESTABLISH_FACT"}, 6: {"NO_SOURCE"}, 7: {"UNKNOWN_SOURCE"}}


def test_features(spark):
    e = spark.createDataFrame([(1, None, at(-24 * 40)), (2, 1, at(-24 * 20)), (3, 2, at(-24 * 3)), (4, 3, at(-1))], "event_id int, original_event_id int, first_available_at timestamp")
    got = {tuple(r) for r in signals.window_relation_violations(e, F.lit(T0)).collect()}
    assert got == {(2, 30, "MISSING_ORIGINAL_IN_WINDOW"), (3, 7, "MISSING_ORIGINAL_IN_WINDOW")}
    row = lambda n, state, value, hashes, grade, seen=-1, published=-2: (n, "s", "news_count", at(seen), T0, "PROSPECTIVE", at(seen), state, value, hashes, grade, at(published))
    rows = [row(1, "OBSERVED", 1.0, [HASH], "A"), row(2, "OBSERVED", 1.0, [], "D"), row(3, "UNKNOWN_NOT_OBSERVED", None, [HASH], None), row(4, "OBSERVED", 1.0, ["b" * 64], "B"), row(5, "OBSERVED", 1.0, [HASH], "C", seen=1, published=2), row(1, "OBSERVED", 1.0, [HASH], "A")]
    f = spark.createDataFrame(rows, "decision_id int, security_code string, feature_name string, available_at timestamp, decision_at timestamp, capture_mode string, fetched_at timestamp, source_availability_state string, feature_value double, evidence_hashes array<string>, availability_evidence_grade string, source_published_at timestamp")
    got = codes_of(signals.feature_violations(f, spark.createDataFrame([(HASH,)], "sha256 string")), "decision_id")
    assert got == {1: {"DUPLICATE_KEY"}, 2: {"OBSERVED_WITHOUT_EVIDENCE", "GRADE_MISSING"}, 3: {"UNKNOWN_WITH_EVIDENCE"}, 4: {"EVIDENCE_UNRESOLVED"}, 5: {"LOOK_AHEAD", "LATE_PROSPECTIVE_FETCH", "PUBLISHED_AFTER_AVAILABLE"}}


def test_findings(spark):
    src = spark.createDataFrame([("s", "PRIMARY_OFFICIAL", ["OFFICIAL_EVENT"], "B", ["DIVIDEND"]), ("c", "COMMUNITY", ["COMMUNITY_SENTIMENT"], "D", ["MOOD"])], "source_id string, source_class string, roles array<string>, timing_grade_ceiling string, fact_eligibility array<string>")
    art = spark.createDataFrame([("s", HASH, "https://s/1", "BODY", at(0)), ("s", "b" * 64, "https://s/2", "ACCESS_RECEIPT", at(0)), ("c", HASH, "https://c/1", "BODY", at(-9))], "source_id string, sha256 string, source_url string, capture_kind string, observed_at timestamp")
    roles = spark.createDataFrame([("s", ["OFFICIAL_EVENT"]), ("c", ["COMMUNITY_SENTIMENT"])], "source_id string, roles_observed array<string>")
    base = dict(source_id="s", security_code="101", published_at=at(-3), available_at=at(-2), capture_mode="PAGE", timing_grade="B", raw_sha256=HASH, source_url="https://s/1", evidence_roles=["OFFICIAL_EVENT"], signal_kind="CATALYST", fact_type="DIVIDEND", strength=0.5, materiality=0.5, origin_id="o", event_key="e", claim_text="t")
    cases = [
        ({}, set()), ({"security_code": "KO"}, {"CODE_NOT_NUMERIC"}), ({"published_at": at(-1)}, {"PUBLISHED_AFTER_AVAILABLE"}), ({"capture_mode": "SEARCH_INDEX"}, {"SEARCH_INDEX_IS_NO_FINDING"}), ({"timing_grade": "A"}, {"GRADE_ABOVE_CEILING"}), ({"raw_sha256": "c" * 64}, {"EVIDENCE_UNRESOLVED"}), ({"source_url": "https://s/9"}, {"EVIDENCE_URL_DIFFERS"}),
        ({"raw_sha256": "b" * 64, "source_url": "https://s/2"}, {"ACCESS_RECEIPT_ONLY"}), ({"available_at": at(5)}, {"EVIDENCE_BEFORE_AVAILABILITY"}), ({"capture_mode": "ARCHIVE_CAPTURE"}, {"ARCHIVE_ARTIFACT_MISSING"}), ({"evidence_roles": ["ISSUER_PRIMARY"]}, {"ROLES_OUTSIDE_CONTRACT"}), ({"signal_kind": "SENTIMENT"}, {"KIND_NOT_ELIGIBLE_FOR_ROLE"}), ({"fact_type": "MOOD"}, {"FACT_NOT_ELIGIBLE"}),
        ({"strength": 1.5}, {"WEIGHT_OUT_OF_RANGE"}), ({"claim_text": " "}, {"FIELD_EMPTY"}), ({"source_id": "c", "source_url": "https://c/1", "timing_grade": "E", "evidence_roles": ["COMMUNITY_SENTIMENT"], "fact_type": "MOOD", "available_at": at(-10), "published_at": at(-11)}, {"COMMUNITY_KIND", "KIND_NOT_ELIGIBLE_FOR_ROLE"}),
    ]
    names = list(base)
    f = spark.createDataFrame([(i, *[(base | c)[n] for n in names]) for i, (c, _) in enumerate(cases)], "finding_id int, source_id string, security_code string, published_at timestamp, available_at timestamp, capture_mode string, timing_grade string, raw_sha256 string, source_url string, evidence_roles array<string>, signal_kind string, fact_type string, strength double, materiality double, origin_id string, event_key string, claim_text string")
    assert codes_of(coverage.finding_violations(f, src, art, roles), "finding_id") == {i: w for i, (_, w) in enumerate(cases) if w}


def test_universe(spark):
    codes = lambda *x: spark.createDataFrame([(c,) for c in x], "security_code string")
    d = dt.date
    b = spark.createDataFrame([("1", "AA", d(2020, 1, 1), None), ("2", "BB", d(2020, 1, 1), d(2021, 1, 1)), ("3", "CC", d(2020, 1, 1), None), ("3", "CD", d(2020, 1, 1), None), ("9", "ZZ", d(2020, 1, 1), d(2019, 1, 1))], "security_code string, ticker string, valid_from date, valid_to date")
    f = spark.createDataFrame([("1", "aa"), ("1", "AB"), ("8", "HH")], "security_code string, ticker string")
    got = codes_of(coverage.universe_binding_violations(codes("1", "2", "3", "4"), codes("1", "2", "3", "4", "7"), b, f, F.lit(T0)), "security_code")
    assert got == {"1": {"FINDING_TICKER_DIFFERS"}, "2": {"BINDING_NOT_EFFECTIVE"}, "3": {"BINDING_DOUBLED"}, "4": {"BINDING_MISSING"}, "7": {"COVERED_NOT_EXPECTED", "BINDING_MISSING"}, "9": {"BINDING_NOT_COVERED", "BINDING_NOT_EFFECTIVE", "BINDING_REVERSED"}, "8": {"FINDING_OUTSIDE_UNIVERSE"}}
    member = lambda a, o: spark.createDataFrame([(a, o)], "as_of timestamp, observed_at timestamp")
    whole = coverage.universe_readiness(codes("1"), codes("1"), codes("1"), member(at(-2), at(-1)), F.lit(T0)).first()
    assert whole.full_market_complete and whole.codes == []
    part = coverage.universe_readiness(codes("1", "2"), codes("1"), codes(), member(at(-30), at(-31)), F.lit(T0)).first()
    assert (part.uncovered, part.without_finding, part.full_market_complete, set(part.codes)) == (1, 2, False, {"MEMBERSHIP_OF_ANOTHER_DAY", "MEMBERSHIP_STALE", "MEMBERSHIP_OBSERVED_BEFORE"})


def test_routes_to_run(spark):
    zero = [(r, "z", i, i, "s%d" % i, 1, "NEXT_EMPTY_STRATEGY" , "AVAILABLE", "ZERO_RESULT", True, 0, True, [], f"h{i}", f"h{i}", f"u{i}", None, False) for r in ("r1",) for i in range(1, 5)]
    one = lambda r, s, end, state="AVAILABLE", error=None, gave_up=False: (r, s, 1, 1, "s1", 1, end, state, "OBSERVED", False, 1, True, [], "h", "h", "u", error, gave_up)
    rows = [*zero, one("r2", "q", "STOP_QUALIFIED"), one("r3", "q", "STOP_QUALIFIED"), one("r4", "p", "STOP_CAPTURE_PENDING_PARSER"), one("r5", "b", "STOP_HARD_BLOCK", "AUTH_REQUIRED"), one("r6", "x", "STOP_RATE_LIMITED", error="HTTP_RATE_LIMITED"), one("r7", "x", "STOP_QUALIFIED"), one("r8", "g", "STOP_QUALIFIED", gave_up=True)]
    a = spark.createDataFrame(rows, "route_id string, source_id string, event_id int, strategy_ordinal int, strategy_id string, attempt_ordinal int, retry_disposition string, state string, query_status string, zero_result boolean, qualified_items int, content_persisted boolean, data_quality_flags array<string>, proof_sha256 string, content_sha256 string, final_url string, error_code string, gave_up boolean").withColumn("ts", F.col("event_id"))
    routes = coverage.route_status(a)
    assert {r.route_id: r.status for r in routes.collect()} == {"r1": "ZERO_RESULT", "r2": "QUALIFIED", "r3": "QUALIFIED", "r4": "CAPTURED_PENDING_PARSER", "r5": "AUTH_REQUIRED", "r6": "BLOCKED", "r7": "QUALIFIED", "r8": "ERROR"}
    sources = coverage.source_status(routes)
    assert {r.source_id: r.status for r in sources.collect()} == {"z": "ZERO_RESULT", "q": "QUALIFIED", "p": "CAPTURED_PENDING_PARSER", "b": "AUTH_REQUIRED", "x": "BLOCKED", "g": "ERROR"}
    waves = spark.createDataFrame([("w0", 0, "z"), ("w0", 0, "q"), ("w1", 1, "p"), ("w2", 2, None), ("w3", 3, "q")], "wave_id string, wave_index int, source_id string")
    assert {r.wave_id: (r.status, r.degraded) for r in coverage.wave_status(waves, sources).collect()} == {"w0": ("COMPLETE", 0), "w1": ("DEGRADED", 1), "w2": ("EMPTY", 0), "w3": ("COMPLETE", 0)}
    assert {r.wave_id: (r.status, r.degraded) for r in coverage.wave_status(waves, sources, 1).collect()} == {"w0": ("COMPLETE", 0), "w1": ("BUDGET_STOPPED", 1), "w2": ("BUDGET_STOPPED", 0), "w3": ("BUDGET_STOPPED", 1)}
    domains = spark.createDataFrame([("a.com",)], "domain string")
    good = sources.where("source_id in ('z', 'q')")
    assert [coverage.run_status(s, domains, **o).first().status for s, o in ((good, {}), (good, {"explicit_subset": True}), (good, {"domain_target": 1}), (good, {"domain_target": 1, "stopped": True}), (sources, {"domain_target": 1}), (sources.limit(0), {}))] == ["DEGRADED", "COMPLETE", "COMPLETE", "DEGRADED", "DEGRADED", "FAILED"]


def test_probes_methods_ownership(spark):
    p = spark.createDataFrame([(1, at(-1), at(-0.5), at(5), 200, "AVAILABLE"), (2, at(1), at(1), at(2), 404, "AVAILABLE"), (3, at(-9), at(-2), at(-1), 700, "FAILED"), (4, at(0), at(-1), at(40), 200, "PARTIAL"), (5, at(-1), at(-1), at(-2), None, "FAILED")], "probe_id int, attempted_at timestamp, observed_at timestamp, expires_at timestamp, http_status int, state string")
    assert codes_of(coverage.implausible_probes(p, F.lit(T0)), "probe_id") == {2: {"OBSERVED_IN_FUTURE", "AVAILABLE_WITHOUT_SUCCESS"}, 3: {"EXPIRED_PROBE", "ATTEMPTED_TOO_LONG_AGO", "HTTP_STATUS_OUT_OF_RANGE"}, 4: {"VALID_OVER_A_DAY", "ATTEMPTED_AFTER_OBSERVED"}, 5: {"EXPIRES_BEFORE_OBSERVED", "EXPIRED_PROBE"}}
    m = spark.createDataFrame([("b", "ACTIVE", ["p"], ["x"]), ("a", "ACTIVE", ["p"], ["x"]), ("z", "FROZEN_BASELINE", ["p"], ["x"]), ("c", "ACTIVE", ["p"], ["y"]), ("d", "RETIRED", ["p"], ["x"]), ("e", "BLOCKED_CAPABILITY", ["p"], ["x"]), ("f", "ACTIVE", ["q"], ["x"])], "method_id string, state string, supports array<string>, required array<string>")
    got = coverage.method_availability(m, spark.createDataFrame([("p",)], "product_id string"), spark.createDataFrame([("x",)], "capability string")).orderBy("place").collect()
    assert [(r.method_id, r.availability, r.missing) for r in got] == [("z", "AVAILABLE", []), ("a", "AVAILABLE", []), ("b", "AVAILABLE", []), ("c", "BLOCKED", ["y"]), ("e", "BLOCKED", [])]
    e = spark.createDataFrame([(1, "s", "g", "NEWS"), (2, "s", "h", "NEWS"), (3, "s", "g", "OFFICIAL"), (4, "t", "g", "NEWS")], "event_id int, source_id string, source_group_id string, source_class string")
    cat = spark.createDataFrame([("s", "g", "MEDIA", ["R"])], "source_id string, independence_group string, source_class string, roles array<string>")
    fits = spark.createDataFrame([("MEDIA", "NEWS")], "source_class string, event_class string")
    assert codes_of(coverage.source_claim_violations(e, cat, fits), "event_id") == {2: {"GROUP_DIFFERS"}, 3: {"CLASS_EXCEEDS_CATALOGUE"}, 4: {"SOURCE_NOT_IN_CATALOGUE"}}
    f = spark.createDataFrame([("1", "f1", ["h1", "h2"]), ("1", "f2", ["h1"]), ("1", "f3", ["h1"])], "security_code string, factor_id string, evidence_hashes array<string>")
    art = spark.createDataFrame([("s", "h1")], "source_id string, sha256 string")
    need = spark.createDataFrame([("f1", ["R"]), ("f2", ["Q"])], "factor_id string, roles array<string>")
    assert {tuple(r) for r in coverage.factor_ownership(f, art, cat, need).collect()} == {("1", "f1", "h2", "NO_ELIGIBLE_OWNER"), ("1", "f2", "h1", "NO_ELIGIBLE_OWNER"), ("1", "f3", "h1", "NO_ROLE_POLICY")}


def test_snapshots_and_candidates(spark):
    cell = lambda s, f, status, value=None, h=-1, hashes=(HASH,): (s, f, status, value, at(h) if h is not None else None, T0, list(hashes))
    cells = [cell("1", "f", "OBSERVED", 1.0), cell("2", "f", "OBSERVED", 1.0, h=1), cell("3", "f", "OBSERVED", 1.0, h=-100), cell("4", "f", "MISSING", h=-1), cell("5", "f", "REJECTED", hashes=()), cell("6", "f", "OBSERVED", 1.0, hashes=("b", "a"))]
    snap = spark.createDataFrame(cells, "security_code string, factor_id string, status string, value double, available_at timestamp, decision_at timestamp, evidence_hashes array<string>")
    reg = spark.createDataFrame([("f", 3)], "factor_id string, window_days int")
    assert codes_of(ranking.snapshot_violations(snap, snap, reg), "security_code") == {"2": {"LOOK_AHEAD"}, "3": {"OUTSIDE_REGISTRY_WINDOW"}, "4": {"MISSING_WITH_AVAILABILITY", "MISSING_WITH_EVIDENCE"}, "5": {"WITHOUT_EVIDENCE"}, "6": {"EVIDENCE_NOT_IN_ORDER"}}
    rows = spark.createDataFrame([("1", 1, 1, 0, 0, 0, 1.0, "SELECTED", 5.0, "UNVALIDATED_RESEARCH_SCORE", None), ("2", 3, 1, 0, 0, 0, 1.0, "SELECTED", None, None, 0.5), ("3", 2, 0, 1, 0, 0, 0.0, "ABSTAINED", 1.0, "X", None)], "security_code string, ordinal int, observed int, missing int, not_applicable int, rejected int, required_coverage double, disposition string, score double, score_kind string, probability double")
    got = codes_of(ranking.snapshot_row_violations(rows, snap, spark.createDataFrame([("f",)], "factor_id string")), "security_code")
    assert got == {"2": {"NOT_IN_ORDER", "SELECTED_WITHOUT_SCORE", "PROBABILITY_RECORDED"}, "3": {"COUNTS_DIFFER", "COVERAGE_DIFFERS", "NOT_IN_ORDER", "SCORE_ON_ABSTENTION"}}
    c = spark.createDataFrame([("r", "101", "AB", 1, 9.0, "SOURCE_MOSAIC_EVIDENCE_SCORE_NOT_PROBABILITY", "WATCH", 0.5, ["x"]), ("r", "x", "A B", 3, 8.0, "P", "BUY", 1.5, ["x", "x", ""])], "run_id string, security_code string, ticker string, rank int, score double, score_kind string, status string, evidence_coverage double, reasons array<string>")
    allowed = c.columns
    assert codes_of(ranking.candidate_field_violations(c, allowed), "security_code") == {"x": {"CODE_INVALID", "TICKER_INVALID", "SCORE_KIND_INVALID", "STATUS_INVALID", "EVIDENCE_COVERAGE_OUT_OF_RANGE", "REASON_DOUBLED", "REASON_EMPTY", "RANK_NOT_BY_SCORE"}}
    assert codes_of(ranking.candidate_field_violations(c.withColumn("target_price", F.lit(1)), allowed), "security_code")["101"] == {"FIELDS_NOT_ALLOWED:target_price"}
    req = [(1, "SINGLE_SECURITY", "NAMED_SECURITIES", ["1"]), (2, "SINGLE_SECURITY", "FULL_MARKET", ["1", "2"]), (3, "COMPARISON", "NAMED_SECURITIES", ["1"]), (4, "RESEARCH_RANK", "NAMED_SECURITIES", ["1"]), (5, "RESEARCH_RANK", "CANDIDATE_SET", []), (6, "RESEARCH_RANK", "FULL_MARKET", [])]
    r = spark.createDataFrame(req, "request_id int, claim_type string, scope string, securities array<string>")
    packs = spark.createDataFrame([(1, "FULL_MARKET", False), (2, "FULL_MARKET", True), (3, "CANDIDATE_SET", True), (4, "NAMED_SECURITIES", True), (6, "FULL_MARKET", True)], "request_id int, scope string, exact_universe boolean")
    ranked = spark.createDataFrame([(i, "1") for i in (1, 2, 3, 4)], "request_id int, security_code string")
    assert codes_of(ranking.claim_scope_violations(r, packs, ranked), "request_id") == {1: {"EXACT_UNIVERSE_REQUIRED"}, 2: {"SINGLE_CLAIM_SCOPE", "SINGLE_CLAIM_LIST", "SECURITY_UNRESOLVED"}, 3: {"COMPARISON_LIST", "SCOPE_INCOMPATIBLE"}, 4: {"RANK_SCOPE", "RANK_WITH_LIST"}, 5: {"PACKET_MISSING"}}


def test_ranks_of_codes_that_are_no_numbers(spark):
    d = spark.createDataFrame([(1, "10", 1.0, 2, False), (1, "9", 1.0, 1, True), (1, "x", 1.0, 3, False)], "decision_id int, security_code string, score double, rank int, selected boolean")
    assert ranking.rank_consistency(d, 1).count() == 0


def test_chains_links_inventories(spark):
    e = spark.createDataFrame([("l", 1, "h1", None, "p", "x", "CREATE", HASH), ("l", 2, "h2", "h1", "p", None, "GUESS", "zz")], "ledger_id string, seq int, event_hash string, previous_hash string, payload string, payload_hash string, event_type string, policy_hash string")
    e = e.withColumn("payload_hash", F.when(F.col("seq") == 1, F.sha2("payload", 256)))
    assert codes_of(ledger.chain_violations(e), "seq") == {2: {"PAYLOAD_HASH_MISMATCH", "EVENT_TYPE_UNKNOWN", "POLICY_HASH_SHAPE"}}
    seal = lambda n, run: ledger.stream_seal(spark.range(1, n + 1).selectExpr("'l' ledger_id", "id seq", "concat('h', id) event_hash"), run).first()
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert seal(5, 10).digest == sha("\n".join(f"h{i}" for i in range(1, 6)))
    assert seal(5, 2).digest == sha("\n".join([sha("h1\nh2"), sha("h3\nh4"), sha("h5")])) and (seal(5, 2).n, seal(5, 2).last_hash) == (5, "h5")
    dec = spark.createDataFrame([("d", at(0), ["1", "2", "2"], at(2), at(4))], "decision_id string, decided_at timestamp, candidates array<string>, issued_at timestamp, recorded_at timestamp")
    out = spark.createDataFrame([(1, "d", "1", at(5)), (2, "d", "2", at(3)), (3, "d", "3", at(1))], "outcome_id int, decision_id string, security_code string, observed_at timestamp")
    assert codes_of(ledger.outcome_link_violations(out, dec), "outcome_id") == {2: {"CANDIDATE_AMBIGUOUS", "OBSERVED_BEFORE_RECORDED"}, 3: {"NOT_A_CANDIDATE", "OBSERVED_BEFORE_ISSUED", "OBSERVED_BEFORE_RECORDED"}}
    m = spark.createDataFrame([("a", "h", 1, at(1), at(0), at(2)), ("b", "h", 1, at(3), at(0), at(2)), ("c", "k", 1, at(1), at(0), at(2))], "path string, sha256 string, size_bytes long, observed_at timestamp, window_from timestamp, window_to timestamp")
    files = spark.createDataFrame([("a", 1), ("b", 2), ("z", 1)], "path string, size_bytes long")
    assert codes_of(ledger.manifest_inventory(m, files), "path") == {"a": {"DUPLICATE_HASH"}, "b": {"DUPLICATE_HASH", "OUTSIDE_TIME_WINDOW", "SIZE_MISMATCH"}, "c": {"MISSING_FILE"}, "z": {"UNREFERENCED_FILE"}}
    assert tuple(ledger.inventory_total(m, files, 3).first()) == (3, 4, True)
    st = spark.createDataFrame([("r", "a", HASH), ("r", "b", "b" * 64)], "run_id string, stage string, admission_sha256 string")
    bind = spark.createDataFrame([("r", "b", "a", HASH), ("r", "c", "a", "c" * 64), ("r", "c", "q", "c" * 64), ("r", "d", "a", "short")], "run_id string, stage string, pred string, admission_sha256 string")
    assert codes_of(ledger.admission_violations(st, bind), "stage") == {"c": {"PREDECESSOR_NOT_ADMITTED", "ADMISSION_HASH_DIFFERS", "ADMISSION_REPLAYED"}, "d": {"ADMISSION_HASH_DIFFERS", "HASH_SHAPE"}}


def test_forecasts(spark):
    import json

    base = dict(decision_id="d", security_code="1", product_id="p", target_rule="t", decision_at="2024-01-01T10:00:00Z", outcome_due_at="2024-01-09T10:00:00+03:00", horizon_sessions=5, model_version="m", entry_rule="e", eligible=True, selected=True, abstained=False, thesis_episode_id="x", score=1.0)
    cases = [
        ({}, set()), ({"score": None, "probability": 0.4}, set()), ({"score": None}, {"SCORE_MISSING"}), ({"abstained": True}, {"SELECTED_AND_ABSTAINED"}), ({"eligible": False}, {"SELECTED_AND_ABSTAINED"}), ({"selected": "yes"}, {"FLAG_NOT_BOOLEAN"}), ({"outcome_due_at": "2024-01-01T10:00:00Z"}, {"OUTCOME_DUE_NOT_AFTER_DECISION"}), ({"decision_at": "2024-01-01T10:00:00"}, {"TIME_UNREADABLE"}),
        ({"horizon_sessions": 0}, {"HORIZON_NOT_POSITIVE"}), ({"probability": 1.2}, {"PROBABILITY_OUT_OF_RANGE"}), ({"score": "high"}, {"NUMBER_UNREADABLE"}), ({"rank": 0}, {"RANK_NOT_POSITIVE"}), ({"reason_codes": "x"}, {"LIST_EXPECTED"}), ({"model_version": ""}, {"FIELD_MISSING"}), ({"note": 1}, {"FIELD_NOT_ALLOWED"}),
        ({"reason_codes": [{"deep": {"realized_gain": 1}}]}, {"OUTCOME_FIELD"}), ({"direction": 'says "outcome": up'}, set()), ({"exit_price_fils": 1}, {"OUTCOME_FIELD", "FIELD_NOT_ALLOWED"}), ({"reason_codes": [{"x_target_hit": 1}]}, {"OUTCOME_FIELD"}),
    ]
    df = spark.createDataFrame([(i, json.dumps(base | c)) for i, (c, _) in enumerate(cases)] + [(99, "{broken")], "event_id int, payload string")
    assert codes_of(ledger.forecast_payload_violations(df, required=ledger.FORECAST_REQUIRED), "event_id") == {i: w for i, (_, w) in enumerate(cases) if w} | {99: {"PAYLOAD_UNREADABLE"}}


def test_schedules_trust_and_replays(spark):
    d = lambda n: dt.date(2024, 1, n)
    rows = [("a", "1", "AA", "I1", d(2), d(3), d(4), None, "UNCLASSIFIED_ENTITLEMENT", None, "pending"), ("b", "1", "AB", "I1", d(2), d(3), d(4), None, "BONUS", 2.0, "done"), ("c", "9", "AA", "I1", d(20), d(21), d(22), None, "UNCLASSIFIED_ENTITLEMENT", None, "pending"), ("c", "1", "AA", "I1", d(2), d(3), d(4), None, "UNCLASSIFIED_ENTITLEMENT", None, "pending")]
    ca = spark.createDataFrame(rows, "action_id string, security_code string, ticker string, isin string, cum_date date, ex_date date, record_date date, payment_date date, action_type string, adjustment_factor double, factor_status string").withColumn("window_from", F.lit(d(1))).withColumn("window_to", F.lit(d(10)))
    who = spark.createDataFrame([("1", "AA", "I1")], "security_code string, ticker string, isin string")
    assert codes_of(actions.schedule_violations(ca, who), "action_id") == {"b": {"IDENTITY_DIFFERS", "SCHEDULE_CLAIMS_TYPE", "SCHEDULE_CLAIMS_FACTOR", "FACTOR_NOT_PENDING"}, "c": {"DUPLICATE_ACTION_ID", "IDENTITY_DIFFERS", "OUTSIDE_WINDOW", "SCHEDULE_OUTSIDE_WINDOW"}}
    audited = spark.createDataFrame([("a", ["NO_PRICE_ROW"], "PARTIAL"), ("b", [], "PASS")], "action_id string, codes array<string>, audit_status string")
    m = actions.integration_metrics(audited, audited, spark.createDataFrame([("a",), ("a",), ("z",)], "action_id string")).first()
    assert (m.actions, m.passed, m.partial, m.no_price_row, m.without_factor, m.several_factors, m.factor_without_action) == (2, 1, 1, 1, 1, 1, 1)
    reg = spark.createDataFrame([("e1", "s", "u", ["1"], "x.com", at(0), at(9)), ("e2", "s", "u", ["1", "2"], "y.com", at(0), at(9)), ("e3", "s", "u", ["1"], "x.com", at(9), at(12))], "entry_id string, source_id string, subject_id string, security_codes array<string>, domain string, valid_from timestamp, valid_until timestamp")
    facts = spark.createDataFrame([(1, "s", "u", "1", "https://www.x.com/a", at(1)), (2, "s", "u", "2", "https://x.com/a", at(1)), (3, "s", "u", None, "https://x.com/a", at(9)), (4, "s", "u", "3", "https://x.com", at(1)), (5, "t", "u", "1", "https://x.com", at(1))], "fact_id int, source_id string, subject_id string, security_code string, url string, at timestamp")
    assert {r.fact_id: (r.entry_id, r.resolution) for r in temporal.trust_entry_as_of(facts, reg).collect()} == {1: ("e1", "MATCHED"), 2: (None, "DOMAIN_OUTSIDE_ENTRY"), 3: ("e3", "MATCHED"), 4: (None, "MISSING"), 5: (None, "MISSING")}
    r = spark.createDataFrame([(1, str(i), float(i), float(i), float(-i), float(i % 2), i > 2, i > 1) for i in range(5)], "decision_id int, security_code string, score double, outcome double, market_excess double, sector_excess double, selected boolean, positive boolean")
    got = evaluation.replay_metrics(r, 2).first()
    assert (got.mean_rank_ic, got.mean_market_rank_ic, got.market_rank_ic_decisions) == (pytest.approx(1.0), pytest.approx(-1.0), 1) and got.market_excess_rate == 0.0


def test_universe_of_pieces(spark):
    d = lambda n: dt.date(2024, 1, n)
    cal = spark.createDataFrame([(d(n), n not in (5, 6)) for n in range(1, 21)], "trade_date date, is_trading_day boolean")
    ids = spark.createDataFrame([("a", d(2), d(12)), ("a", d(10), None), ("b", d(1), None)], "security_code string, valid_from date, valid_to date")
    st = spark.createDataFrame([("a", d(1), d(7), "TRADING"), ("a", d(8), None, "SUSPENDED"), ("b", d(1), d(9), "TRADING"), ("b", d(1), d(4), "TRADING"), ("b", d(10), None, "DELISTED")], "security_code string, effective_from date, effective_to date, status string")
    got = {(r.trade_date.day, r.security_code, r.status) for r in temporal.eligible_universe(cal, ids, st).collect()}
    want = {(n, "a", "TRADING" if n < 8 else "SUSPENDED") for n in range(2, 21) if n not in (5, 6)} | {(n, "b", "TRADING") for n in range(7, 10)}
    assert got == want


def test_files_out_of_contract(spark, tmp_path):
    import hashlib

    from pyspark.sql import types as t

    from pitmark.sources import contracts

    schema = t.StructType([t.StructField("a", t.LongType()), t.StructField("b", t.StringType())])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_bytes("\ufeffa,b\r\n1,x\r\na,b\r\n2,y,z\r\n".encode())
    (tmp_path / "in" / "2.csv").write_text("a,b\n3,w\n")
    good, bad = contracts.read_contract_csv(spark, str(tmp_path / "in"), schema)
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, "x"), (3, "w")]
    assert sorted((r.raw, r.code) for r in bad.collect()) == [("2,y,z", "ROW_NOT_IN_CONTRACT"), ("a,b", "HEADER_REPEATED")]
    (tmp_path / "in" / "3.csv").write_text("b,a\nx,1\n")
    with pytest.raises(ValueError, match="HEADER_MISMATCH"):
        contracts.read_contract_csv(spark, str(tmp_path / "in"), schema)
    raw = tmp_path / "raw"
    for folder, said in (("x", "one"), ("y", "two"), ("z", "three")):
        (raw / folder).mkdir(parents=True)
        (raw / folder / "same.txt").write_text(said)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    m = spark.createDataFrame([("x/same.txt", sha("one"), 3), ("./y/same.txt", sha("one"), 3), ("w/same.txt", sha("one"), 3)], "path string, sha256 string, size_bytes long")
    assert {r.name: r.code for r in contracts.verify_artifacts(m, str(raw)).collect()} == {"x/same.txt": "OK", "y/same.txt": "HASH_MISMATCH", "w/same.txt": "MISSING", "z/same.txt": "UNREFERENCED"}


def test_components_of_names(spark):
    from pitmark.operators.components import components

    edges = [("b", "a"), ("c", "b"), ("e", "d"), ("d", "d"), (None, "a"), ("c", "a"), *((f"n{i:03}", f"n{i + 1:03}") for i in range(300))]
    df = spark.createDataFrame(edges, "src string, dst string").repartition(5)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"} | {f"n{i:03}": "n000" for i in range(301)}
    assert components(df.limit(0)).count() == 0


def test_scratch_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from pitmark.operators import scratch

    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, applicationId="x"))
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch.shared_folder(session(master))
    assert scratch.shared_folder(session("local[4]")).startswith("file://")
