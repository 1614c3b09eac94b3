"""Ranks: heuristic, source mosaic, factor snapshots, and checks of recorded ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import signed
from pitmark.operators.coverage import role_coverage, substantive
from pitmark.operators.events import claim_clusters, cluster_representatives, near_duplicate_pairs, source_conflicts
from pitmark.operators.ordered import Sums, numbered, running
from pitmark.operators.row_quality import with_codes
from pitmark.operators.scratch import materialise

#: Weights of the heuristic rank.
FEATURE_WEIGHTS = {"relative_return_5d": 0.25, "relative_return_20d": 0.15, "relative_value_20d": 0.20, "relative_volume_20d": 0.15, "official_event_net_30d": 0.15, "liquidity_percentile": 0.10}


def heuristic_rank(features: DataFrame, k: int, min_coverage: float = 0.67, weights: Mapping[str, float] = FEATURE_WEIGHTS, group: Sequence[str] = ()) -> DataFrame:
    """Weighted sum of what is known if enough is; else the row abstains with a null rank. Ties go to the smaller code.

    Give ``group`` (a decision date, say) where there are many decisions: each is
    ranked apart. Ranks come from ranges in order and the sizes of those before
    (``ordered.numbered``), so no task sees the whole universe.
    """
    coverage = sum((F.col(c).isNotNull().cast("int") for c in weights), F.lit(0)) / len(weights)
    total = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    scored = features.withColumn("feature_coverage", coverage).withColumn("score", F.when(F.col("feature_coverage") >= min_coverage, F.round(total, 9)))
    scored = scored.withColumn("abstained", F.col("score").isNull())
    out = numbered(scored, [F.desc("score"), "security_code"], "rank", [*group, "abstained"]).withColumn("rank", F.when(~F.col("abstained"), F.col("rank")).cast("int"))
    return out.select(*group, "security_code", "score", "feature_coverage", "abstained", "rank", F.coalesce(F.col("rank") <= k, F.lit(False)).alias("selected"))


def mosaic_rank(findings: DataFrame, policy: Mapping, reliability: Column, k: int = 5) -> DataFrame:
    """Evidence score of each security from one representative per cluster of claims.

    ``policy``: weights by kind, quorum by role, minimum_groups, minimum_coverage,
    community_cap, and whether the whole universe was reconciled. The community's
    part of a kind shares the kind's denominator and is scaled down to the cap.
    Every row gets a rank; only candidates are selected. The clusters are
    written to a table on the way.
    """
    weights, cap = policy["weights"], policy["community_cap"]
    strong = substantive(findings)
    usable = strong if cap > 0 else strong.where("source_class <> 'COMMUNITY'")
    # several branches read the clusters, none of them the texts
    clustered = materialise(claim_clusters(usable, near_duplicate_pairs(usable)).drop("claim_text"), "clustered")
    best = cluster_representatives(clustered, reliability).select("finding_id")
    reps = clustered.join(best, "finding_id").withColumn("reliability", reliability)
    value = signed(F.col("direction")) * F.col("strength") * F.col("materiality") * F.col("reliability")
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in weights.items() for x in p]), F.col("signal_kind")), F.lit(0.0))
    by_kind = reps.withColumn("value", value).groupBy("security_code", "signal_kind").agg(F.count("*").alias("n"), F.sum(F.when(F.col("source_class") != "COMMUNITY", F.col("value")).otherwise(0.0)).alias("a"), F.sum(F.when(F.col("source_class") == "COMMUNITY", F.col("value")).otherwise(0.0)).alias("b"))
    by_kind = by_kind.withColumn("w", weight).withColumn("a", F.col("a") / F.col("n") * F.col("w")).withColumn("b", F.col("b") / F.col("n") * F.col("w"))
    kinds = by_kind.groupBy("security_code").agg(F.collect_list(F.struct("a", "b")).alias("parts"), F.sum("w").alias("present"), F.sum(F.abs("b")).alias("community"))
    scale = F.when(F.col("community") > 0, F.least(F.lit(1.0), cap / F.col("community"))).otherwise(0.0)
    clamp = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    kinds = kinds.withColumn("scale", scale)
    total = clamp(F.aggregate("parts", F.lit(0.0), lambda s, p: s + clamp(p.a + p.b * F.col("scale"))))
    scored = kinds.select("security_code", F.round(50 + 50 * total, 4).alias("score"), F.round(F.col("present") / sum(weights.values()), 6).alias("evidence_coverage"))
    groups = reps.groupBy("security_code").agg(F.count_distinct("publisher_group").alias("groups"))
    conflicts = source_conflicts(reps).groupBy("security_code").agg(F.array_sort(F.collect_set(F.concat_ws(":", "signal_kind", "event_key"))).alias("conflicts"))
    quorum = findings.sparkSession.createDataFrame([(r, n) for r, n in policy["quorum"].items()], "role string, required int")
    gaps = role_coverage(clustered, quorum, by_security=True).where("gap").groupBy("security_code").agg(F.array_sort(F.collect_list(F.concat(F.lit("PER_SECURITY_ROLE_QUORUM:"), "role", F.lit(":"), F.col("actual").cast("string"), F.lit("/"), F.col("required").cast("string")))).alias("gaps"))
    none = F.array().cast("array<string>")
    j = findings.select("security_code").distinct().join(scored, "security_code", "left").join(groups, "security_code", "left").join(conflicts, "security_code", "left").join(gaps, "security_code", "left")
    j = j.select("security_code", F.coalesce("score", F.lit(50.0)).alias("score"), F.coalesce("evidence_coverage", F.lit(0.0)).alias("evidence_coverage"), F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("conflicts", none).alias("conflicts"), F.when(F.col("score").isNull(), F.array(*[F.lit(f"PER_SECURITY_ROLE_QUORUM:{r}:0/{n}") for r, n in sorted(policy["quorum"].items())])).otherwise(F.coalesce("gaps", none)).alias("gaps"))
    few, thin = F.col("groups") < policy["minimum_groups"], F.col("evidence_coverage") < policy["minimum_coverage"]
    own = F.when(few, F.array(F.lit("INSUFFICIENT_SOURCE_DIVERSITY"))).when(thin, F.array(F.lit("INSUFFICIENT_SIGNAL_COVERAGE"))).when(F.size("conflicts") > 0, F.array(F.concat(F.lit("INDEPENDENT_SOURCE_CONFLICT:"), F.array_join("conflicts", ",")))).otherwise(none)
    j = j.withColumn("reasons", F.concat("gaps", own)).withColumn("status", F.when(few | thin, "ABSTAIN").when(F.size("reasons") > 0, "WATCH").otherwise("RESEARCH_CANDIDATE"))
    allowed = j.agg(F.bool_and(F.size("gaps") == 0).alias("complete"))
    exact = F.lit(bool(policy["exact_universe"]))
    j = j.crossJoin(F.broadcast(allowed)).withColumn("full", exact & F.col("complete"))
    j = j.withColumn("status", F.when(exact & ~F.col("full") & (F.col("status") == "RESEARCH_CANDIDATE"), "WATCH").otherwise(F.col("status")))
    candidate = F.col("status") == "RESEARCH_CANDIDATE"
    j = j.withColumn("one", F.lit(1).cast("long")).withColumn("is_candidate", candidate.cast("long"))
    j = running(j, [], [F.desc("score"), "security_code"], Sums(rank="one", nth="is_candidate"))
    return j.select("security_code", "score", "evidence_coverage", "groups", "status", "reasons", F.when(F.col("full"), "FULL_MARKET_RESEARCH_RANK").otherwise("CANDIDATE_SET_RESEARCH_RANK").alias("scope_label"), F.col("rank").cast("int").alias("rank"), (candidate & (F.col("nth") <= k)).alias("selected"))


def factor_snapshot(universe: DataFrame, registry: DataFrame, inputs: DataFrame) -> DataFrame:
    """universe x registry: each factor OBSERVED, MISSING, NOT_APPLICABLE or REJECTED. The registry is a small fixed list."""
    grid = universe.select("security_code").distinct().crossJoin(F.broadcast(registry))
    j = grid.join(inputs, ["security_code", "factor_id"], "left")
    return j.select("security_code", "factor_id", "required", F.coalesce("status", F.lit("MISSING")).alias("status"), F.when(F.col("status") == "OBSERVED", F.col("value")).alias("value"))


def snapshot_dispositions(snapshot: DataFrame) -> DataFrame:
    n = lambda s: F.sum(F.when(F.col("status") == s, 1).otherwise(0))
    g = snapshot.groupBy("security_code").agg(n("OBSERVED").alias("observed"), n("MISSING").alias("missing"), n("REJECTED").alias("rejected"), F.avg(F.when(F.col("required"), (F.col("status") == "OBSERVED").cast("double"))).alias("required_coverage"))
    return g.withColumn("disposition", F.when(F.col("rejected") > 0, "REJECTED").when(F.col("required_coverage") < 1, "INCOMPLETE").otherwise("ELIGIBLE"))


def disposition_violations(rows: DataFrame) -> DataFrame:
    c = F.col
    return with_codes(
        rows, ["security_code"],
        ((c("disposition") == "SELECTED") & (c("required_coverage") < 1), "SELECTED_WITHOUT_COVERAGE"), ((c("disposition") == "SELECTED") & (c("rejected") > 0), "SELECTED_WITH_REJECTED_FACTOR"),
        ((c("disposition") == "SELECTED") & (c("status") != "TRADING"), "SELECTED_NOT_TRADING"), (c("score").isNotNull() & (c("stage") == "SCREENED_OUT"), "SCORE_AFTER_SCREENING"),
    )


def snapshot_violations(snapshot: DataFrame, universe: DataFrame, registry: DataFrame) -> DataFrame:
    """Cells that are missing, extra or doubled, and values against their state.

    Where the snapshot has ``available_at`` and ``decision_at``: availability is
    not after the decision, and not older than the registry's ``window_days``;
    with ``evidence_hashes``: what is missing has none, all else has some, in order.
    """
    c = F.col
    more = []
    if "available_at" in snapshot.columns:
        more += [(c("available_at") > c("decision_at"), "LOOK_AHEAD"), ((c("status") == "MISSING") & c("available_at").isNotNull(), "MISSING_WITH_AVAILABILITY")]
        if "window_days" in registry.columns:
            age = F.unix_seconds(c("decision_at").cast("timestamp")) - F.unix_seconds(c("available_at").cast("timestamp"))
            snapshot = snapshot.join(F.broadcast(registry.select("factor_id", "window_days")), "factor_id", "left")
            more.append((~c("status").isin("REJECTED", "MISSING") & (age > c("window_days") * 86_400), "OUTSIDE_REGISTRY_WINDOW"))
    if "evidence_hashes" in snapshot.columns:
        n = F.coalesce(F.size("evidence_hashes"), F.lit(0))
        more += [((c("status") == "MISSING") & (n > 0), "MISSING_WITH_EVIDENCE"), ((c("status") != "MISSING") & (n <= 0), "WITHOUT_EVIDENCE"), (c("evidence_hashes") != F.array_sort("evidence_hashes"), "EVIDENCE_NOT_IN_ORDER")]
    want = universe.select("security_code").distinct().crossJoin(F.broadcast(registry.select("factor_id")))
    key = ["security_code", "factor_id"]
    have = snapshot.groupBy(*key).agg(F.count("*").alias("n"))
    j = want.withColumn("want", F.lit(True)).join(have, key, "full_outer")
    cells = with_codes(j, key, (F.col("n").isNull(), "MISSING_CELL"), (F.col("want").isNull(), "EXTRA_CELL"), (F.col("n") > 1, "DUPLICATE_CELL"))
    return cells.unionByName(with_codes(snapshot, key, *more, ((F.col("status") == "OBSERVED") & F.col("value").isNull(), "OBSERVED_WITHOUT_VALUE"), ((F.col("status") != "OBSERVED") & F.col("value").isNotNull(), "VALUE_WITHOUT_OBSERVATION")))


def snapshot_row_violations(rows: DataFrame, snapshot: DataFrame, required: DataFrame) -> DataFrame:
    """(security_code, code): counts and coverage that a snapshot's rows state against its cells, and order and score of the rows.

    ``rows``: security_code, ordinal, observed, missing, not_applicable,
    rejected, required_coverage, disposition, score, score_kind, probability;
    ``required``: factor_id of those required for selection.
    """
    c = F.col
    n = lambda s: F.count_if(c("status") == s)
    must = required.select("factor_id", F.lit(True).alias("must")).distinct()
    cells = snapshot.join(F.broadcast(must), "factor_id", "left").groupBy("security_code").agg(
        n("OBSERVED").alias("c_observed"), n("MISSING").alias("c_missing"), n("NOT_APPLICABLE").alias("c_not_applicable"), n("REJECTED").alias("c_rejected"), F.count_if((c("status") == "OBSERVED") & c("must")).alias("held"),
    )
    total = must.agg(F.count("*").alias("must_have"))
    j = rows.join(cells, "security_code", "left").crossJoin(F.broadcast(total))
    coverage = F.when(c("must_have") > 0, c("held") / c("must_have")).otherwise(1.0)
    j = numbered(j, ["security_code"], "place")
    picked = c("disposition") == "SELECTED"
    return with_codes(
        j, ["security_code"],
        (F.exists(F.array(*[c(x) != c(f"c_{x}") for x in ("observed", "missing", "not_applicable", "rejected")]), lambda x: x) | c("c_observed").isNull(), "COUNTS_DIFFER"), (F.abs(c("required_coverage") - coverage) > 1e-12, "COVERAGE_DIFFERS"), (c("ordinal") != c("place"), "NOT_IN_ORDER"),
        (picked & (c("score").isNull() | ~c("score_kind").eqNullSafe("UNVALIDATED_RESEARCH_SCORE")), "SELECTED_WITHOUT_SCORE"), (c("score").isNull() & c("score_kind").isNotNull(), "SCORE_KIND_WITHOUT_SCORE"), (c("disposition").isin("ABSTAINED", "UNRESOLVED") & c("score").isNotNull(), "SCORE_ON_ABSTENTION"), (c("probability").isNotNull(), "PROBABILITY_RECORDED"),
    )


def full_market_claim(ranked: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: may the ranking be called one of the full market?"""
    n = ranked.agg(F.count("*").alias("ranked"), F.count_distinct("security_code").alias("unique_"), F.sum(F.col("has_gap").cast("int")).alias("gaps"))
    missing = expected.select("security_code").distinct().join(ranked, "security_code", "left_anti").agg(F.count("*").alias("missing"))
    extra = ranked.join(expected, "security_code", "left_anti").agg(F.count("*").alias("extra"))
    j = n.crossJoin(missing).crossJoin(extra)
    return j.select("ranked", "missing", "extra", "gaps", ((F.col("ranked") == F.col("unique_")) & (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("gaps") == 0)).alias("allowed"))


def rank_consistency(decisions: DataFrame, k: int) -> DataFrame:
    """Recorded ranks and selections that do not follow from score (descending), number of the code, code."""
    order = [F.desc("score"), F.col("security_code").try_cast("bigint").asc_nulls_last(), "security_code"]
    r = numbered(decisions, order, "expected_rank", ["decision_id"]).withColumn("expected_rank", F.col("expected_rank").cast("int"))
    return r.where((F.col("rank") != F.col("expected_rank")) | (F.col("selected") != (F.col("expected_rank") <= k))).select("decision_id", "security_code", "rank", "expected_rank", "selected")


def scope_violations(requests: DataFrame, packets: DataFrame, ranked: DataFrame) -> DataFrame:
    """Requests whose packet has another scope, or whose securities were not ranked."""
    got = ranked.groupBy("request_id").agg(F.collect_set("security_code").alias("got"))
    j = requests.join(packets.select("request_id", F.col("scope").alias("p_scope")), "request_id", "left").join(got, "request_id", "left")
    unresolved = F.size(F.array_except("securities", F.coalesce("got", F.array().cast("array<string>")))) > 0
    return with_codes(j, ["request_id"], (F.col("p_scope").isNull(), "PACKET_MISSING"), (F.col("scope") != F.col("p_scope"), "SCOPE_INCOMPATIBLE"), ((F.col("scope") == "SECURITIES") & unresolved, "SECURITY_UNRESOLVED"), ((F.col("scope") == "FULL_MARKET") & (F.size("securities") > 0), "LIST_IN_FULL_MARKET_CLAIM"))


#: Scopes of packets that serve a request's scope.
PACKET_SCOPES = {"CANDIDATE_SET": ("CANDIDATE_SET", "FULL_MARKET"), "NAMED_SECURITIES": ("NAMED_SECURITIES", "FULL_MARKET"), "FULL_MARKET": ("FULL_MARKET",)}


def claim_scope_violations(requests: DataFrame, packets: DataFrame, ranked: DataFrame) -> DataFrame:
    """(request_id, code): claim type against scope and list of securities, scope against the packet, and what was resolved.

    ``requests``: request_id, claim_type, scope, securities; ``packets``:
    request_id, scope, exact_universe; ``ranked``: request_id, security_code.
    """
    c = F.col
    got = ranked.groupBy("request_id").agg(F.collect_set("security_code").alias("got"))
    j = requests.join(packets.select("request_id", c("scope").alias("p_scope"), "exact_universe"), "request_id", "left").join(got, "request_id", "left")
    n, named, full = F.coalesce(F.size("securities"), F.lit(0)), c("scope") == "NAMED_SECURITIES", c("scope") == "FULL_MARKET"
    fits = F.lit(False)
    for scope, packs in PACKET_SCOPES.items():
        fits = fits | ((c("scope") == scope) & c("p_scope").isin(*packs))
    exact = F.coalesce("exact_universe", F.lit(False))
    return with_codes(
        j, ["request_id"],
        ((c("claim_type") == "SINGLE_SECURITY") & ~named, "SINGLE_CLAIM_SCOPE"), ((c("claim_type") == "SINGLE_SECURITY") & (n != 1), "SINGLE_CLAIM_LIST"), ((c("claim_type") == "COMPARISON") & ~named, "COMPARISON_SCOPE"), ((c("claim_type") == "COMPARISON") & (n < 2), "COMPARISON_LIST"),
        ((c("claim_type") == "RESEARCH_RANK") & ~c("scope").isin("CANDIDATE_SET", "FULL_MARKET"), "RANK_SCOPE"), ((c("claim_type") == "RESEARCH_RANK") & (n > 0), "RANK_WITH_LIST"), (~c("scope").isin(*PACKET_SCOPES), "SCOPE_UNSUPPORTED"),
        (c("p_scope").isNull(), "PACKET_MISSING"), (c("scope").isin(*PACKET_SCOPES) & c("p_scope").isNotNull() & ~fits, "SCOPE_INCOMPATIBLE"), (((named & (c("p_scope") == "FULL_MARKET")) | full) & ~exact, "EXACT_UNIVERSE_REQUIRED"),
        (F.size(F.array_except("securities", F.coalesce("got", F.array().cast("array<string>")))) > 0, "SECURITY_UNRESOLVED"),
    )


#: Fields of a candidate and the range they lie in.
CANDIDATE_RANGES = {"evidence_coverage": (0, 1), "source_quality_factor": (0, 1), "evidence_direction_alignment": (-1, 1), "community_contribution_total": (-1, 1), "community_contribution_cap": (0, 1)}


def candidate_field_violations(ranked: DataFrame, allowed: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """(run_id, security_code, code): identity, ranges, labels and reasons of candidates, roles against their quorum, and fields out of place.

    Rules on fields that the table lacks are left out; a column that is not
    ``allowed`` is a code of every row. ``ties`` are further columns that order
    rows of one score and code; they are no fields of a candidate. Rows that all
    these leave alike stand by the rank they state. Nulls come last.
    """
    c, here = F.col, set(ranked.columns)
    rules = [(~F.coalesce(c("security_code").rlike("^[0-9]{1,12}$"), F.lit(False)), "CODE_INVALID"), (~F.coalesce(c("rank") > 0, F.lit(False)), "RANK_NOT_POSITIVE")]
    if "ticker" in here:
        rules.append((~F.coalesce(c("ticker").rlike(r"^[\p{L}\p{N}._-]{1,32}$"), F.lit(False)), "TICKER_INVALID"))
    if "score_kind" in here:
        rules.append((~c("score_kind").eqNullSafe("SOURCE_MOSAIC_EVIDENCE_SCORE_NOT_PROBABILITY"), "SCORE_KIND_INVALID"))
    if "status" in here:
        rules.append((~F.coalesce(c("status").isin("RESEARCH_CANDIDATE", "WATCH", "ABSTAIN"), F.lit(False)), "STATUS_INVALID"))
    if "scope_label" in here:
        rules.append((~c("scope_label").isin("CANDIDATE_SET_RESEARCH_RANK", "FULL_MARKET_RESEARCH_RANK"), "SCOPE_LABEL_INVALID"))
    rules += [(F.isnan(c(x).cast("double")) | ~c(x).between(lo, hi), f"{x.upper()}_OUT_OF_RANGE") for x, (lo, hi) in CANDIDATE_RANGES.items() if x in here]
    if "reasons" in here:
        rules += [(F.size(F.array_distinct("reasons")) < F.size("reasons"), "REASON_DOUBLED"), (F.exists("reasons", lambda r: F.trim(r) == ""), "REASON_EMPTY")]
    if "role_gaps" in here:
        rules.append((F.exists("role_gaps", lambda g: (g.actual < 0) | (g.required < 0)), "ROLE_GAP_NEGATIVE"))
    extra = sorted(here - set(allowed) - {"run_id", *ties})
    if extra:
        rules.append((F.lit(True), "FIELDS_NOT_ALLOWED:" + ",".join(extra)))
    order = Window.partitionBy("run_id").orderBy(F.desc("score"), F.col("security_code").try_cast("bigint").asc_nulls_last(), *[c(x).asc_nulls_last() for x in ("security_code", *ties, "rank")])
    rows = ranked.withColumn("__place", F.row_number().over(order))
    return with_codes(rows, ["run_id", "security_code"], *rules, (c("rank") != c("__place"), "RANK_NOT_BY_SCORE"))


def candidate_contract_violations(ranked: DataFrame) -> DataFrame:
    """Recorded candidates: unique code and rank, score in range, status that fits its reasons, and no probability."""
    code = ranked.groupBy("run_id", "security_code").agg(F.count("*").alias("n")).where("n > 1").select("run_id", "security_code", F.lit("DUPLICATE_CODE").alias("code"))
    rank = ranked.groupBy("run_id", "rank").agg(F.count("*").alias("n"), F.min("security_code").alias("security_code")).where("n > 1").select("run_id", "security_code", F.lit("DUPLICATE_RANK").alias("code"))
    c = F.col
    rows = with_codes(ranked, ["run_id", "security_code"], (~c("score").between(0, 100), "SCORE_OUT_OF_RANGE"), (c("probability").isNotNull(), "PROBABILITY_RECORDED"), ((c("status") == "RESEARCH_CANDIDATE") & (F.size("reasons") > 0), "CANDIDATE_WITH_REASONS"), ((c("status") != "RESEARCH_CANDIDATE") & (F.size("reasons") == 0), "STATUS_WITHOUT_REASON"), (c("selected") & (c("status") != "RESEARCH_CANDIDATE"), "SELECTED_NOT_CANDIDATE"))
    return code.unionByName(rank).unionByName(rows)


