"""Queries on whole tables against their SQL twins, and that no row is left out."""

import pytest
from pyspark.sql import functions as F

from pitmark.operators import coverage, ledger
from pitmark.plans import catalogue
from pitmark.plans.whole_queries import LanguageViews
from test_oracles import SF, duck, plain  # noqa: F401

RESIDUES = ["k8_attempt_rollup", "k9_advance_watermarks", "k14_capture_state_rollup", "q18_fold_evidence_class", "e5_fold_fact_status", "r9_candidate_contract"]


def agrees(spark, duck, name):  # noqa: F811
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    sql = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({catalogue.ORACLES[name]})").fetchall()
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(map(plain, r)) for r in sql), key=repr)
    return got


@pytest.mark.parametrize("name", RESIDUES)
def test_whole_tables(spark, duck, name):  # noqa: F811
    plan = catalogue.QUERIES[f"{name}_whole"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("event_id" in line or "o_orderkey" in line for line in plan.splitlines() if line.strip(" :+-").startswith("Filter") and "%" in line)
    assert agrees(spark, duck, f"{name}_whole")


def test_no_row_is_left_out(spark):
    q = lambda name: catalogue.QUERIES[name](spark, SF)
    e = spark.read.parquet(f"{SF}/events.parquet")
    assert q("k14_capture_state_rollup_whole").agg(F.sum("captures")).first()[0] == e.count()
    assert q("k8_attempt_rollup_whole").agg(F.sum("routes")).first()[0] == e.select("user_id").distinct().count()
    assert {r.status for r in q("k8_attempt_rollup_whole").collect()} == {"COMPLETE", "PARTIAL", "FAILED"}
    assert {r.evidence_class for r in q("q18_fold_evidence_class_whole").collect()} >= {"error", "click", "view"}
    assert q("e5_fold_fact_status_whole").count() == e.select(F.regexp_extract("props", r"(\d+)", 1)).distinct().count()
    assert q("r9_candidate_contract_whole").where("cast(security_code as long) % 3 <> 0").count() > 0


@pytest.mark.parametrize("name", ["e7_near_duplicate_pairs", "e8_claim_clusters", "e9_cluster_representative", "k5_role_coverage_by_security", "r2_mosaic_rank", "s6_export_projection"])
def test_blocked_by_language(spark, duck, name):  # noqa: F811
    agrees(spark, duck, f"{name}_by_language")


def test_copies_meet_across_residues(spark, tmp_path):
    """Copies of one kind and direction, whose ids leave different rests by 5."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(0, text), (12, text), (24, text + " thirteen"), (36, "quite other words that have nothing in common with these sentences"), (1, text), (2, text)]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    f = LanguageViews(spark, str(tmp_path)).findings()
    assert {(r.finding_id, r.security_code, r.direction) for r in f.collect()} >= {(0, "en", "POSITIVE"), (1, "en", "NEGATIVE"), (2, "en", "NEUTRAL")}
    q = lambda name: catalogue.QUERIES[name](spark, str(tmp_path))
    near = lambda df: sorted((r.a, r.b) for r in df.where("why = 'claim_text'").collect())
    # copies are tied to one row, not to one another
    assert near(q("e7_near_duplicate_pairs_by_language")) == [(0, 12), (0, 24)]
    assert near(q("e7_near_duplicate_pairs")) == [(0, 1), (0, 2), (0, 12), (0, 24)]
    assert {r.finding_id: r.cluster for r in q("e8_claim_clusters_by_language").collect()} == {0: 0, 12: 0, 24: 0, 36: 36, 1: 1, 2: 2}


@pytest.mark.parametrize("name", ["k8_wave_rollup", "k8_run_rollup", "k14_batch_state", "a9_packet_status", "l1_chain_own_hash_and_time"])
def test_rollups_and_chains(spark, duck, name):  # noqa: F811
    got = agrees(spark, duck, name)
    assert got and (name != "l1_chain_own_hash_and_time" or {r[0] for r in got} == {"OWN_HASH_MISMATCH", "PREVIOUS_HASH_BREAK", "TIME_ORDER"})


def test_chain_times(spark):
    rows = [("a", 1, None, "h1", 5, 4, 4), ("a", 2, "h1", "h2", 4, 4, 4), ("a", 3, "h2", "h3", 6, 7, 7), ("a", 4, "h3", "h4", 8, 8, 7)]
    e = spark.createDataFrame(rows, "ledger_id string, seq int, previous_hash string, event_hash string, recorded_at int, issued_at int, effective_at int")
    assert sorted((r.seq, r.code) for r in ledger.chain_violations(e).collect()) == [(2, "TIME_ORDER"), (3, "TIME_ORDER"), (4, "TIME_ORDER")]


ATTEMPT = "route_id string, event_id int, ts int, strategy_ordinal int, strategy_id string, attempt_ordinal int, retry_disposition string, interrupted boolean"


def test_route_violations(spark):
    nxt, again = "NEXT_EMPTY_STRATEGY", "RETRY_TRANSIENT"
    rows = {
        "fine": [(1, "s", 1, again), (1, "s", 2, nxt), (2, "t", 1, "STOP_QUALIFIED")], "late": [(2, "t", 1, "STOP_QUALIFIED")], "skip": [(1, "s", 1, nxt), (3, "u", 1, "STOP_QUALIFIED")],
        "retry": [(1, "s", 1, nxt), (1, "s", 2, "STOP_QUALIFIED")], "next": [(1, "s", 1, again), (2, "t", 1, "STOP_QUALIFIED")], "name": [(1, "s", 1, again), (1, "x", 2, "STOP_QUALIFIED")], "open": [(1, "s", 1, nxt)], "cut": [(1, "s", 1, nxt)],
    }
    a = spark.createDataFrame([(k, 10 * i + j, j, *x, k == "cut") for i, (k, v) in enumerate(rows.items()) for j, x in enumerate(v)], ATTEMPT)
    assert {(r.route_id, r.code) for r in coverage.route_violations(a).collect()} == {
        ("late", "BEGINS_PAST_ONE"), ("skip", "STRATEGIES_NOT_CONTIGUOUS"), ("retry", "RETRY_CONTRADICTS_DISPOSITION"), ("next", "TRANSITION_CONTRADICTS_DISPOSITION"), ("name", "STRATEGY_ORDINAL_REUSED"), ("open", "ENDS_ON_OPEN_DISPOSITION")}


def test_zero_result_proof(spark):
    def route(name, n=4, proof=str, url=str):
        return [(name, k, k, k, "NEXT_EMPTY_STRATEGY", "AVAILABLE", "ZERO_RESULT", True, 0, True, [], proof(k), proof(k), url(k)) for k in range(1, n + 1)]

    a = spark.createDataFrame(route("all") + route("three", 3) + route("same", proof=lambda k: "p") + route("url", url=lambda k: "u"), "route_id string, event_id int, ts int, strategy_ordinal int, retry_disposition string, state string, query_status string, zero_result boolean, qualified_items int, content_persisted boolean, data_quality_flags array<string>, proof_sha256 string, content_sha256 string, final_url string")
    assert {r.route_id: r.zero_complete for r in coverage.zero_result_routes(a).collect()} == {"all": True, "three": False, "same": False, "url": False}
