"""Sources: what was observed, admitted, covered, and how far each source has come."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import codes, host, registrable_domain
from pitmark.operators.row_quality import denominator_gap, with_codes

#: Dispositions after which the next strategy of a route is tried.
NEXT_STRATEGY = ("NEXT_EMPTY_STRATEGY", "NEXT_STRATEGY_AFTER_TRANSIENT_EXHAUSTED", "NEXT_REJECTED_STRATEGY")


def qualify_observations(observations: DataFrame, decision: Column, max_age_hours: float) -> DataFrame:
    """Status after the age check, whether the observation contributes, and what is incoherent about it.

    A stale observation is rejected, and one that is rejected may not claim items.
    """
    age = (F.unix_seconds(decision.cast("timestamp")) - F.unix_seconds(F.col("attempted_at").cast("timestamp"))) / 3600
    status = F.when((F.col("query_status") == "OBSERVED") & (age > max_age_hours), "DATA_QUALITY_REJECTED").otherwise(F.col("query_status"))
    why = codes(
        (age < 0, "ATTEMPTED_AFTER_DECISION"), ((status != "OBSERVED") & (F.col("qualified_items") > 0), "NON_CONTRIBUTING_WITH_ITEMS"),
        ((status == "OBSERVED") & (F.col("qualified_items") == 0) & ~F.col("zero_result"), "OBSERVED_WITHOUT_ITEMS"), (F.col("zero_result") & (F.col("qualified_items") > 0), "ZERO_RESULT_WITH_ITEMS"),
    )
    return observations.select("*", status.alias("status"), ((status == "OBSERVED") & (F.size(why) == 0)).alias("contributes"), why.alias("codes"))


def admit_findings(findings: DataFrame, qualified: DataFrame, sources: DataFrame, decision: Column, max_age_hours: float) -> tuple[DataFrame, DataFrame]:
    """Admitted findings, and the refused with their codes; a stale finding is refused with a warning code alone.

    For evidence, kinds, facts and grades of findings see ``finding_violations``,
    whose codes can be joined to these.
    """
    obs = qualified.groupBy("source_id").agg(F.bool_or("contributes").alias("contributes"))
    j = findings.join(obs, "source_id", "left").join(sources.select("source_id", "domain", F.col("roles").alias("s_roles")), "source_id", "left")
    age = (F.unix_seconds(decision.cast("timestamp")) - F.unix_seconds(F.col("available_at").cast("timestamp"))) / 3600
    h = host(F.col("source_url"))
    why = codes(
        (~F.coalesce("contributes", F.lit(False)), "SOURCE_NOT_OBSERVED"), (~F.coalesce((h == F.col("domain")) | h.endswith(F.concat(F.lit("."), F.col("domain"))), F.lit(False)), "HOST_NOT_OF_SOURCE"),
        (age < 0, "AVAILABLE_AFTER_DECISION"), (F.size(F.array_except("roles", "s_roles")) > 0, "ROLE_NOT_GRANTED"), (age > max_age_hours, "STALE_FINDING"),
    )
    j = j.withColumn("codes", why)
    return j.where(F.size("codes") == 0).select(*findings.columns), j.where(F.size("codes") > 0).select(*findings.columns, "codes")


#: Kinds of signal that evidence in a role may carry.
ROLE_SIGNAL_KINDS = {
    "IDENTITY_REFERENCE": ("RISK", "ARCHIVE_CONTEXT"),
    "OFFICIAL_EVENT": ("CATALYST", "FUNDAMENTAL", "RISK"),
    "ISSUER_PRIMARY": ("CATALYST", "FUNDAMENTAL", "RISK"),
    "MARKET_DISCOVERY": ("PRICE_ACTIVITY", "TECHNICAL", "LIQUIDITY", "RISK"),
    "PRICE_HISTORY": ("PRICE_ACTIVITY", "TECHNICAL", "LIQUIDITY", "RISK"),
    "FUNDAMENTAL_ARCHIVE": ("CATALYST", "FUNDAMENTAL", "RISK", "ARCHIVE_CONTEXT"),
    "NEWS_ARCHIVE": ("CATALYST", "FUNDAMENTAL", "SENTIMENT", "RISK", "ARCHIVE_CONTEXT"),
    "COMMUNITY_SENTIMENT": ("SENTIMENT", "RISK"),
    "WEB_ARCHIVE": ("ARCHIVE_CONTEXT",),
    "SEARCH_ROUTER": (),
    "EXECUTION_TAPE": ("PRICE_ACTIVITY", "TECHNICAL", "LIQUIDITY", "RISK"),
    "STORAGE_ONLY": (),
}
#: Grades of timing, strongest first.
TIMING_GRADES = ("A", "B", "C", "D", "E", "F")


def finding_violations(findings: DataFrame, sources: DataFrame, artifacts: DataFrame, observed_roles: DataFrame) -> DataFrame:
    """(finding_id, code): what is wrong with a finding's identity, times, grade, evidence, kind, roles and fact type.

    ``sources``: source_id, source_class, roles, timing_grade_ceiling,
    fact_eligibility; ``artifacts``: source_id, sha256, source_url,
    capture_kind, observed_at; ``observed_roles``: source_id, roles_observed.
    A finding must rest on an artifact of its own source with its hash and
    address that is no access receipt and was observed once it was available.
    """
    c = F.col
    got = artifacts.select("source_id", F.col("sha256").alias("raw_sha256"), F.col("source_url").alias("a_url"), "capture_kind", "observed_at")
    met = findings.select("finding_id", "source_id", "raw_sha256", "source_url", "available_at", "capture_mode").join(got, ["source_id", "raw_sha256"], "left")
    same = c("a_url") == c("source_url")
    told = met.groupBy("finding_id").agg(
        F.count("a_url").alias("hashes"), F.count_if(same).alias("urls"), F.count_if(same & (c("capture_kind") != "ACCESS_RECEIPT")).alias("bodies"),
        F.count_if(same & (c("observed_at") >= c("available_at"))).alias("timely"), F.count_if(same & (c("capture_kind") == "ARCHIVE_CAPTURE")).alias("archived"), F.count("*").alias("rows"),
    )
    place = lambda g: F.array_position(F.array(*map(F.lit, TIMING_GRADES)), g)
    kinds = F.create_map(*[x for k, v in ROLE_SIGNAL_KINDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    seen = observed_roles.groupBy("source_id").agg(F.array_distinct(F.flatten(F.collect_list("roles_observed"))).alias("roles_observed"))
    s = sources.select("source_id", "source_class", c("roles").alias("s_roles"), "timing_grade_ceiling", "fact_eligibility")
    j = findings.join(told, "finding_id").join(s, "source_id", "left").join(seen, "source_id", "left")
    kind, cls = c("signal_kind"), c("source_class")
    no = lambda x: F.coalesce(~x, F.lit(True))
    out = with_codes(
        j, ["finding_id"],
        (no(c("security_code").rlike("^[0-9]+$")), "CODE_NOT_NUMERIC"), (c("published_at") > c("available_at"), "PUBLISHED_AFTER_AVAILABLE"), (c("capture_mode") == "SEARCH_INDEX", "SEARCH_INDEX_IS_NO_FINDING"),
        (no((place(c("timing_grade")) > 0) & (place(c("timing_grade")) >= place(c("timing_grade_ceiling")))), "GRADE_ABOVE_CEILING"), (c("hashes") == 0, "EVIDENCE_UNRESOLVED"), ((c("hashes") > 0) & (c("urls") == 0), "EVIDENCE_URL_DIFFERS"),
        ((c("urls") > 0) & (c("bodies") == 0), "ACCESS_RECEIPT_ONLY"), ((c("urls") > 0) & (c("timely") == 0), "EVIDENCE_BEFORE_AVAILABILITY"), ((c("capture_mode") == "ARCHIVE_CAPTURE") & (c("archived") == 0), "ARCHIVE_ARTIFACT_MISSING"),
        (no(F.size("evidence_roles") > 0) | (F.size(F.array_except("evidence_roles", F.coalesce("s_roles", F.array().cast("array<string>")))) > 0) | (F.size(F.array_except("evidence_roles", F.coalesce("roles_observed", F.array().cast("array<string>")))) > 0), "ROLES_OUTSIDE_CONTRACT"),
        ((cls == "COMMUNITY") & ~kind.isin("SENTIMENT", "RISK"), "COMMUNITY_KIND"), ((cls == "WEB_ARCHIVE") & (kind != "ARCHIVE_CONTEXT"), "WEB_ARCHIVE_KIND"), (cls.isin("SEARCH_ROUTER", "STORAGE"), "SOURCE_CANNOT_FIND"),
        (F.exists("evidence_roles", lambda r: no(F.array_contains(F.try_element_at(kinds, r), kind))), "KIND_NOT_ELIGIBLE_FOR_ROLE"), (no(F.array_contains("fact_eligibility", c("fact_type"))), "FACT_NOT_ELIGIBLE"),
        (no(c("strength").between(0, 1)) | no(c("materiality").between(0, 1)), "WEIGHT_OUT_OF_RANGE"), (F.exists(F.array("origin_id", "event_key", "claim_text"), lambda x: F.coalesce(F.trim(x), F.lit("")) == ""), "FIELD_EMPTY"),
    )
    twice = findings.groupBy("finding_id").agg(F.count("*").alias("n")).where("n > 1").select("finding_id", F.lit("DUPLICATE_FINDING_ID").alias("code"))
    return out.distinct().unionByName(twice)


def substantive(findings: DataFrame) -> DataFrame:
    return findings.where("direction <> 'NEUTRAL' and strength > 0 and materiality > 0 and signal_kind <> 'ARCHIVE_CONTEXT'")


def role_coverage(findings: DataFrame, quorum: DataFrame, *, by_security: bool = False) -> DataFrame:
    """Per role the least of its distinct publisher groups, origins and events, against the quorum; by security: groups and clusters."""
    keys = ["security_code"] if by_security else []
    each = findings.withColumn("role", F.explode("roles"))
    counts = ["publisher_group", "cluster"] if by_security else ["publisher_group", "origin_id", "event_key"]
    g = each.groupBy(*keys, "role").agg(*[F.count_distinct(c).alias(f"n{i}") for i, c in enumerate(counts)])
    g = g.select(*keys, "role", F.least(*[F.col(f"n{i}") for i in range(len(counts))]).alias("actual"))
    want = findings.select(*keys).distinct().crossJoin(F.broadcast(quorum)) if by_security else quorum
    j = want.join(g, [*keys, "role"], "left")
    actual = F.coalesce("actual", F.lit(0))
    return j.select(*keys, "role", actual.alias("actual"), "required", (actual < F.col("required")).alias("gap"))


def universe_reconcile(expected: DataFrame, covered: DataFrame) -> DataFrame:
    """Securities missing from or extra to the covered set, and tickers that differ."""
    gap = denominator_gap(expected, covered, ["security_code"]).select("security_code", F.concat(F.col("gap"), F.lit("_SECURITY")).alias("code"))
    t = expected.select("security_code", "ticker").join(covered.select("security_code", F.col("ticker").alias("c_ticker")), "security_code").where("ticker <> c_ticker")
    return gap.unionByName(t.select("security_code", F.lit("TICKER_DIFFERS").alias("code")).distinct())


def universe_binding_violations(expected: DataFrame, covered: DataFrame, bindings: DataFrame, findings: DataFrame, decision: Column) -> DataFrame:
    """(security_code, code): identity bindings against the covered universe on the decision's day, and findings against both.

    ``bindings``: security_code, ticker, valid_from, valid_to. A covered
    security needs one binding in force; findings stay inside the covered
    universe and carry the bound ticker; covered securities are expected ones.
    """
    day = F.to_date(decision)
    alive = (F.col("valid_from") <= day) & (F.coalesce("valid_to", day) >= day)
    b = bindings.groupBy("security_code").agg(F.count("*").alias("n"), F.count_if(alive).alias("alive"), F.count_if(F.col("valid_to") < F.col("valid_from")).alias("reversed"), F.min(F.when(alive, F.col("ticker"))).alias("bound"))
    marks = lambda df, name: df.select("security_code", F.lit(True).alias(name)).distinct()
    j = marks(covered, "covered").join(marks(expected, "expected"), "security_code", "full_outer").join(b, "security_code", "full_outer")
    on = F.col("covered").isNotNull()
    rows = with_codes(
        j, ["security_code"],
        (on & F.col("expected").isNull(), "COVERED_NOT_EXPECTED"), (on & F.col("n").isNull(), "BINDING_MISSING"), (~on & F.col("n").isNotNull(), "BINDING_NOT_COVERED"), (F.col("n") > 1, "BINDING_DOUBLED"),
        ((F.col("n") > 0) & (F.col("alive") == 0), "BINDING_NOT_EFFECTIVE"), (F.col("reversed") > 0, "BINDING_REVERSED"), (no_code(F.col("security_code")), "CODE_NOT_NUMERIC"),
    )
    f = findings.select("security_code", "ticker").distinct().join(j.select("security_code", "covered", "bound"), "security_code", "left")
    return rows.unionByName(with_codes(f, ["security_code"], (F.col("covered").isNull(), "FINDING_OUTSIDE_UNIVERSE"), (F.upper("ticker") != F.upper("bound"), "FINDING_TICKER_DIFFERS")).distinct())


def no_code(code: Column) -> Column:
    return ~F.coalesce(code.rlike("^[0-9]+$"), F.lit(False))


def universe_readiness(expected: DataFrame, covered: DataFrame, substantive_findings: DataFrame, membership: DataFrame, decision: Column, max_age_hours: float = 24.0) -> DataFrame:
    """One row: is the universe's evidence fresh, and is the market covered in full?

    ``membership`` has one row: as_of and observed_at of the evidence. It must
    be of the decision's day, not after it, no older than allowed, and observed
    once it held.
    """
    missing = lambda df, name: expected.select("security_code").distinct().join(df.select("security_code").distinct(), "security_code", "left_anti").agg(F.count("*").alias(name))
    age = (F.unix_seconds(decision.cast("timestamp")) - F.unix_seconds(F.col("as_of").cast("timestamp"))) / 3600
    fresh = codes(
        (F.to_date("as_of") != F.to_date(decision), "MEMBERSHIP_OF_ANOTHER_DAY"), (age < 0, "MEMBERSHIP_AFTER_DECISION"), (age > max_age_hours, "MEMBERSHIP_STALE"), (F.col("observed_at") < F.col("as_of"), "MEMBERSHIP_OBSERVED_BEFORE"),
    )
    j = membership.select(fresh.alias("codes")).crossJoin(missing(covered, "uncovered")).crossJoin(missing(substantive_findings, "without_finding"))
    return j.withColumn("full_market_complete", (F.size("codes") == 0) & (F.col("uncovered") == 0) & (F.col("without_finding") == 0))


def attempt_routes(attempts: DataFrame) -> DataFrame:
    """The ordered attempts of a route as its outcome: count, terminal state, gaps and attempts after the end."""
    w = Window.partitionBy("route_id").orderBy("ts", "event_id")
    a = attempts.withColumn("before", F.lag("state").over(w))
    ended = F.col("before") == "COMPLETE"
    g = a.groupBy("route_id", "source_id").agg(F.count("*").alias("attempts"), F.count_distinct("state").alias("states"), F.max_by("state", F.struct("ts", "event_id")).alias("terminal_state"), F.sum(ended.cast("int")).alias("after_complete"), F.sum(F.when(F.col("state") == "COMPLETE", 1).otherwise(0)).alias("completed"))
    return g.withColumn("outcome", F.when(F.col("completed") > 0, "COMPLETE").when(F.col("terminal_state") == "FAILED", "FAILED").otherwise("OPEN")).withColumn("after_complete", F.coalesce("after_complete", F.lit(0)))


def attempt_rollup(routes: DataFrame) -> DataFrame:
    """Routes to sources: complete only if every route is."""
    g = routes.groupBy("source_id").agg(F.count("*").alias("routes"), F.sum((F.col("outcome") == "COMPLETE").cast("int")).alias("complete"), F.sum((F.col("outcome") == "FAILED").cast("int")).alias("failed"))
    return g.withColumn("status", F.when(F.col("complete") == F.col("routes"), "COMPLETE").when(F.col("failed") == F.col("routes"), "FAILED").otherwise("PARTIAL"))


def route_violations(attempts: DataFrame) -> DataFrame:
    """Attempts out of turn: a route begins at one and one, and each next attempt is what the disposition before it allows.

    ``interrupted`` is true on the attempts of a route that was cut off and may end anywhere.
    """
    w = Window.partitionBy("route_id").orderBy("ts", "event_id")
    before = lambda c: F.lag(c).over(w)
    first_name = F.first("strategy_id").over(Window.partitionBy("route_id", "strategy_ordinal").orderBy("ts", "event_id"))
    a = attempts.select("*", before("strategy_ordinal").alias("s0"), before("attempt_ordinal").alias("a0"), before("retry_disposition").alias("d0"), F.row_number().over(w).alias("nth"), F.lead("event_id").over(w).isNull().alias("last"), first_name.alias("first_name"))
    s, n, d, later = F.col("strategy_ordinal"), F.col("attempt_ordinal"), F.col("retry_disposition"), F.col("nth") > 1
    open_end = (d == "RETRY_TRANSIENT") | (d.isin(*NEXT_STRATEGY) & (s < 4))
    return with_codes(
        a, ["route_id", "event_id"],
        (~later & ((s != 1) | (n != 1)), "BEGINS_PAST_ONE"), (F.col("strategy_id") != F.col("first_name"), "STRATEGY_ORDINAL_REUSED"),
        (later & (s == F.col("s0")) & (~F.col("d0").eqNullSafe("RETRY_TRANSIENT") | (n != F.col("a0") + 1)), "RETRY_CONTRADICTS_DISPOSITION"),
        (later & (s == F.col("s0") + 1) & (~F.coalesce(F.col("d0").isin(*NEXT_STRATEGY), F.lit(False)) | (n != 1)), "TRANSITION_CONTRADICTS_DISPOSITION"),
        (later & (s != F.col("s0")) & (s != F.col("s0") + 1), "STRATEGIES_NOT_CONTIGUOUS"), (F.col("last") & ~F.coalesce("interrupted", F.lit(False)) & open_end, "ENDS_ON_OPEN_DISPOSITION"),
    )


def zero_result_routes(attempts: DataFrame) -> DataFrame:
    """Per route whether a zero result is proven: the last attempts of strategies 1 to 4 are all empty, with four distinct proofs and addresses."""
    last = F.row_number().over(Window.partitionBy("route_id", "strategy_ordinal").orderBy(F.desc("ts"), F.desc("event_id")))
    empty = (F.col("retry_disposition") == "NEXT_EMPTY_STRATEGY") & (F.col("state") == "AVAILABLE") & (F.col("query_status") == "ZERO_RESULT") & F.col("zero_result") & (F.col("qualified_items") == 0) & F.col("content_persisted") & (F.size("data_quality_flags") == 0) & (F.col("proof_sha256") == F.col("content_sha256"))
    a = attempts.withColumn("back", last).where("back = 1").withColumn("empty", F.coalesce(empty, F.lit(False)) & F.col("strategy_ordinal").between(1, 4))
    of = lambda c: F.count_distinct(F.when(F.col("empty"), F.col(c)))
    return a.groupBy("route_id").agg(((of("strategy_ordinal") == 4) & (of("proof_sha256") == 4) & (of("final_url") == 4)).alias("zero_complete"))


def route_status(attempts: DataFrame) -> DataFrame:
    """Per route its status, whether it is covered, and the disposition it ended with.

    A proven zero result comes first; else the last attempt's disposition
    decides. A route whose retry control gave up (``gave_up`` on its attempts)
    ends blocked or in error whatever its attempts say.
    """
    order = F.struct("ts", "event_id")
    gave_up = F.bool_or("gave_up") if "gave_up" in attempts.columns else F.lit(False)
    last = attempts.groupBy("route_id", "source_id").agg(F.count("*").alias("attempts"), F.max_by("retry_disposition", order).alias("terminal"), F.max_by("state", order).alias("state"), F.max_by("error_code", order).alias("error"), gave_up.alias("gave_up"))
    j = last.join(zero_result_routes(attempts), "route_id")
    limited, end = F.coalesce(F.col("error") == "HTTP_RATE_LIMITED", F.lit(False)), F.col("terminal")
    gave_up = F.coalesce("gave_up", F.lit(False))
    status = (
        F.when(gave_up, F.when(limited, "BLOCKED").otherwise("ERROR")).when(F.col("zero_complete"), "ZERO_RESULT").when(end == "STOP_QUALIFIED", "QUALIFIED").when(end == "STOP_CAPTURE_PENDING_PARSER", "CAPTURED_PENDING_PARSER")
        .when(end == "STOP_HARD_BLOCK", F.col("state")).when(end.isin("STOP_RATE_LIMITED", "STOP_RETRY_BUDGET") & limited, "BLOCKED").otherwise("ERROR")
    )
    return j.select("route_id", "source_id", "attempts", F.when(gave_up, "STOP_SLEEPER_FAILURE").otherwise(end).alias("terminal_disposition"), status.alias("status")).withColumn("coverage_complete", F.col("status").isin("ZERO_RESULT", "QUALIFIED"))


def source_status(routes: DataFrame) -> DataFrame:
    """Per source the status that its routes' statuses add up to: covered only if every route is."""
    has = lambda s: F.bool_or(F.col("status") == s)
    status = (
        F.when(F.bool_and("coverage_complete"), F.when(has("QUALIFIED"), "QUALIFIED").otherwise("ZERO_RESULT")).when(has("CAPTURED_PENDING_PARSER"), "CAPTURED_PENDING_PARSER")
        .when(has("AUTH_REQUIRED"), "AUTH_REQUIRED").when(has("BLOCKED"), "BLOCKED").otherwise("ERROR")
    )
    return routes.groupBy("source_id").agg(F.count("*").alias("routes"), F.count_if("coverage_complete").alias("completed"), status.alias("status"))


def wave_status(waves: DataFrame, sources: DataFrame, budget_wave: int | None = None) -> DataFrame:
    """Per wave (wave_id, wave_index, planned source_id) its status and how many planned sources are not covered.

    From the wave on in which the budget ran out, every wave is stopped; in
    later ones no source is covered.
    """
    j = waves.join(sources.select("source_id", "status"), "source_id", "left")
    good = F.coalesce(F.col("status").isin("QUALIFIED", "ZERO_RESULT"), F.lit(False)) & (F.lit(True) if budget_wave is None else F.col("wave_index") <= budget_wave)
    g = j.groupBy("wave_id", "wave_index").agg(F.count("source_id").alias("sources"), F.count_if(F.col("source_id").isNotNull() & ~good).alias("degraded"))
    stopped = F.lit(False) if budget_wave is None else F.col("wave_index") >= budget_wave
    return g.withColumn("status", F.when(stopped, "BUDGET_STOPPED").when(F.col("sources") == 0, "EMPTY").when(F.col("degraded") == 0, "COMPLETE").otherwise("DEGRADED"))


def run_status(sources: DataFrame, tried_domains: DataFrame, *, explicit_subset: bool = False, stopped: bool = False, domain_target: int = 50) -> DataFrame:
    """One row: complete if all sources are covered, nothing stopped the run and enough domains were tried; failed without a source."""
    g = sources.agg(F.count("*").alias("sources"), F.count_if(F.col("status").isin("QUALIFIED", "ZERO_RESULT")).alias("covered")).crossJoin(tried_domains.agg(F.count_distinct("domain").alias("domains")))
    met = F.lit(explicit_subset) | (F.col("domains") >= domain_target)
    done = (F.col("covered") == F.col("sources")) & F.lit(not stopped) & met
    return g.withColumn("status", F.when(F.col("sources") == 0, "FAILED").when(done, "COMPLETE").otherwise("DEGRADED"))


def wave_rollup(waves: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources to waves: complete if every planned source is, degraded otherwise, empty without one; ``waves`` holds wave_id and planned source_id, or null."""
    j = waves.join(sources.select("source_id", "status"), "source_id", "left")
    g = j.groupBy("wave_id").agg(F.count("source_id").alias("sources"), F.count(F.when(F.col("status") == "COMPLETE", 1)).alias("complete"))
    return g.withColumn("status", F.when(F.col("sources") == 0, "EMPTY").when(F.col("complete") == F.col("sources"), "COMPLETE").otherwise("DEGRADED"))


def run_rollup(sources: DataFrame) -> DataFrame:
    """One row: sources, those complete, and the run's status, failed without a source."""
    g = sources.agg(F.count("*").alias("sources"), F.count(F.when(F.col("status") == "COMPLETE", 1)).alias("complete"))
    return g.withColumn("status", F.when(F.col("sources") == 0, "FAILED").when(F.col("complete") == F.col("sources"), "COMPLETE").otherwise("DEGRADED"))


def advance_watermarks(initial: DataFrame, sources: DataFrame, decision: Column) -> DataFrame:
    """A complete source moves to the decision time; any other keeps what it had."""
    j = initial.join(sources.select("source_id", "status"), "source_id", "full_outer")
    return j.select("source_id", F.when(F.col("status") == "COMPLETE", F.greatest(decision, F.col("watermark"))).otherwise(F.col("watermark")).alias("watermark"))


def probe_freshness(probes: DataFrame, now: Column, max_hours: float) -> DataFrame:
    age = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("probed_at").cast("timestamp"))) / 3600
    code = F.when(age < 0, "FUTURE_PROBE").when(~F.col("ok"), "FAILED_PROBE").when(age > max_hours, "EXPIRED_PROBE").otherwise("FRESH")
    return probes.select("probe_id", code.alias("code"))


def implausible_probes(probes: DataFrame, now: Column) -> DataFrame:
    """(probe_id, code): probes whose times, validity or answers can't be.

    ``probes``: attempted_at, observed_at, expires_at, http_status, state. Five
    minutes of clock difference are allowed, an hour between attempt and
    observation, a day of validity.
    """
    c = F.col
    at = lambda x: F.unix_seconds(x.cast("timestamp"))
    seen, tried, ends = at(c("observed_at")), at(c("attempted_at")), at(c("expires_at"))
    return with_codes(
        probes, ["probe_id"],
        (seen > at(now) + 300, "OBSERVED_IN_FUTURE"), (ends <= seen, "EXPIRES_BEFORE_OBSERVED"), (ends - seen > 86_400, "VALID_OVER_A_DAY"), (at(now) > ends, "EXPIRED_PROBE"), (tried > seen, "ATTEMPTED_AFTER_OBSERVED"), (seen - tried > 3600, "ATTEMPTED_TOO_LONG_AGO"),
        (~c("http_status").between(100, 599), "HTTP_STATUS_OUT_OF_RANGE"), (c("state").isin("AVAILABLE", "PARTIAL") & ~F.coalesce(c("http_status").between(200, 299), F.lit(False)), "AVAILABLE_WITHOUT_SUCCESS"),
    )


def method_availability(methods: DataFrame, products: DataFrame, passed: DataFrame) -> DataFrame:
    """Per product and method that supports it: available or blocked, what is missing, and the place in order.

    ``methods``: method_id, state, supports, required; retired ones are left
    out. Available methods come first, frozen baselines before others, then by name.
    """
    have = passed.agg(F.coalesce(F.collect_set("capability"), F.array().cast("array<string>")).alias("have"))
    j = methods.where("state <> 'RETIRED'").withColumn("product_id", F.explode("supports")).join(products.select("product_id").distinct(), "product_id").crossJoin(F.broadcast(have))
    missing = F.array_sort(F.array_except("required", "have"))
    open_ = (F.size(missing) == 0) & (F.col("state") != "BLOCKED_CAPABILITY")
    j = j.select("product_id", "method_id", "state", missing.alias("missing"), F.when(open_, "AVAILABLE").otherwise("BLOCKED").alias("availability"))
    first = (F.col("availability") == "AVAILABLE") & (F.col("state") == "FROZEN_BASELINE")
    w = Window.partitionBy("product_id").orderBy(F.col("availability"), F.when(first, 0).otherwise(1), "method_id")
    return j.withColumn("place", F.row_number().over(w))


def capability_gaps(products: DataFrame, passed: DataFrame) -> DataFrame:
    """Capabilities that a product requires and that have not passed, in order."""
    have = passed.agg(F.coalesce(F.collect_set("capability"), F.array().cast("array<string>")).alias("have"))
    return products.crossJoin(F.broadcast(have)).select("product_id", F.array_sort(F.array_except("required", "have")).alias("missing"))


def domain_coverage(attempts: DataFrame, catalogue: DataFrame, url: str, target: float) -> DataFrame:
    """One row: registrable domains tried against those of the catalogue, and whether the target share is met."""
    tried = attempts.select(registrable_domain(host(F.col(url))).alias("domain")).distinct()
    n = catalogue.select("domain").distinct().join(tried.withColumn("tried", F.lit(True)), "domain", "left").agg(F.count("*").alias("catalogue"), F.count("tried").alias("tried"))
    return n.withColumn("share", F.col("tried") / F.col("catalogue")).withColumn("met", F.col("share") >= target)


def evidence_ownership(events: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Hashes that an event cites and its own source did not capture."""
    each = events.select("event_id", "source_id", F.explode("hashes").alias("sha256"))
    return each.join(artifacts.select("source_id", "sha256").distinct(), ["source_id", "sha256"], "left_anti")


def source_claim_violations(events: DataFrame, catalogue: DataFrame, allowed: DataFrame) -> DataFrame:
    """(event_id, code): the group and class an event states for its source against the catalogue.

    ``catalogue``: source_id, independence_group, source_class; ``allowed``:
    source_class of the catalogue, event_class that an event may then state.
    """
    j = events.select("event_id", "source_id", "source_group_id", F.col("source_class").alias("event_class")).join(catalogue.select("source_id", "independence_group", "source_class"), "source_id", "left")
    j = j.join(allowed.select("source_class", "event_class", F.lit(True).alias("fits")).distinct(), ["source_class", "event_class"], "left")
    known = F.col("independence_group").isNotNull()
    return with_codes(j, ["event_id"], (~known, "SOURCE_NOT_IN_CATALOGUE"), (known & ~F.col("source_group_id").eqNullSafe(F.col("independence_group")), "GROUP_DIFFERS"), (known & F.col("fits").isNull(), "CLASS_EXCEEDS_CATALOGUE"))


def factor_ownership(factors: DataFrame, artifacts: DataFrame, sources: DataFrame, required_roles: DataFrame) -> DataFrame:
    """(security_code, factor_id, sha256, code): cited hashes that no source with a role the factor asks for has captured.

    ``required_roles``: factor_id, roles. A factor without such a policy is a code of its own.
    """
    each = factors.select("security_code", "factor_id", F.explode("evidence_hashes").alias("sha256")).join(required_roles, "factor_id", "left")
    owners = artifacts.select("source_id", "sha256").distinct().join(sources.select("source_id", F.col("roles").alias("s_roles")), "source_id")
    j = each.join(owners, "sha256", "left").groupBy("security_code", "factor_id", "sha256").agg(F.bool_or(F.col("roles").isNull()).alias("open"), F.bool_or(F.coalesce(F.arrays_overlap("roles", "s_roles"), F.lit(False))).alias("owned"))
    return j.where("open or not owned").select("security_code", "factor_id", "sha256", F.when(F.col("open"), "NO_ROLE_POLICY").otherwise("NO_ELIGIBLE_OWNER").alias("code"))


def capture_rollup(captures: DataFrame, order: Mapping[str, int]) -> DataFrame:
    """Per source AVAILABLE if all captures are, PARTIAL if some are, else the worst state."""
    rank = F.create_map(*[F.lit(x) for p in order.items() for x in p])
    g = captures.groupBy("source_id").agg(F.bool_and(F.col("state") == "AVAILABLE").alias("all_"), F.bool_or(F.col("state") == "AVAILABLE").alias("any_"), F.max_by("state", F.coalesce(F.try_element_at(rank, F.col("state")), F.lit(99))).alias("worst"), F.count("*").alias("captures"))
    return g.select("source_id", "captures", F.when(F.col("all_"), "AVAILABLE").when(F.col("any_"), "PARTIAL").otherwise(F.col("worst")).alias("state"))


def batch_state(rolled: DataFrame) -> DataFrame:
    return rolled.agg(F.when(F.bool_and(F.col("state") == "AVAILABLE"), "COMPLETE").when(F.bool_or(F.col("state").isin("AVAILABLE", "PARTIAL")), "DEGRADED").otherwise("FAILED").alias("batch_state"))


def coherence_violations(observations: DataFrame, key: list[str]) -> DataFrame:
    return with_codes(observations, key, (F.col("qualified_items") < 0, "NEGATIVE_ITEMS"))
