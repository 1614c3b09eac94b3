"""Coverage and ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.operators import coverage as K
from pitmark.operators import ranking as R
from pitmark.plans.event_queries import SQL as _SQL  # noqa: F401  (registers the cluster views)
from pitmark.plans.event_queries import clustered, reliability, rounded
from pitmark.plans.registry import query
from pitmark.plans.views import SQL, Views

def cut():
    return F.lit("2024-01-29 12:00:00").cast("timestamp_ntz")


def observations(v: Views):
    e, k = v.events(), F.col("event_id")
    return e.select(k.alias("obs_id"), "source_id", F.when(k % 7 == 0, "FAILED").otherwise("OBSERVED").alias("query_status"), F.col("event_at").alias("attempted_at"), (k % 4).alias("qualified_items"), (k % 8 == 0).alias("zero_result"))


@query("k1_qualify_observations", """WITH o AS (SELECT event_id obs_id, (epoch(TIMESTAMP '2024-01-29 12:00:00') - floor(epoch(event_at))) / 3600 age, CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'OBSERVED' END q, event_id % 4 n, event_id % 8 = 0 z FROM ev), s AS (SELECT *, CASE WHEN q = 'OBSERVED' AND age > 240 THEN 'DATA_QUALITY_REJECTED' ELSE q END st FROM o),
    c AS (SELECT *, list_filter([CASE WHEN age < 0 THEN 'ATTEMPTED_AFTER_DECISION' END, CASE WHEN st <> 'OBSERVED' AND n > 0 THEN 'NON_CONTRIBUTING_WITH_ITEMS' END, CASE WHEN st = 'OBSERVED' AND n = 0 AND NOT z THEN 'OBSERVED_WITHOUT_ITEMS' END, CASE WHEN z AND n > 0 THEN 'ZERO_RESULT_WITH_ITEMS' END], lambda x: x IS NOT NULL) codes FROM s) SELECT obs_id, st status, st = 'OBSERVED' AND len(codes) = 0 contributes, codes FROM c""")
def _(v: Views):
    return K.qualify_observations(observations(v), cut(), 240).select("obs_id", "status", "contributes", "codes")


@query("k2_admit_findings", """WITH f AS (SELECT page_id, 'http' || 's' x, url, page_id % 3 s, page_id % 700 h FROM pages), c AS (SELECT page_id, list_filter([CASE WHEN s = 2 THEN 'SOURCE_NOT_OBSERVED' END, CASE WHEN NOT regexp_matches(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), CASE s WHEN 0 THEN '(^|\\.)example\\.com$' WHEN 1 THEN '(^|\\.)example\\.org$' ELSE '(^|\\.)example\\.net$' END) THEN 'HOST_NOT_OF_SOURCE' END, CASE WHEN page_id % 5 = 0 AND s = 1 THEN 'ROLE_NOT_GRANTED' END, CASE WHEN h > 240 THEN 'STALE_FINDING' END], lambda x: x IS NOT NULL) codes FROM f)
    SELECT page_id, len(codes) = 0 admitted, codes FROM c""")
def _(v: Views):
    k = F.col("page_id")
    f = v.table("pages").select(k, F.col("url").alias("source_url"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("source_id"), (cut() - F.make_interval(hours=(k % 700).cast("int"))).alias("available_at"), F.when(k % 5 == 0, F.array(F.lit("FACT"), F.lit("OPINION"))).otherwise(F.array(F.lit("FACT"))).alias("roles"))
    q = v.spark.createDataFrame([("s0", True), ("s1", True), ("s2", False)], "source_id string, contributes boolean")
    s = v.spark.createDataFrame([("s0", "example.com", ["FACT", "OPINION"]), ("s1", "example.org", ["FACT"]), ("s2", "example.net", ["FACT", "OPINION"])], "source_id string, domain string, roles array<string>")
    good, bad = K.admit_findings(f, q, s, cut(), 240)
    return good.select("page_id", F.lit(True).alias("admitted"), F.array().cast("array<string>").alias("codes")).unionByName(bad.select("page_id", F.lit(False).alias("admitted"), "codes"))


@query("k3_substantive", "SELECT finding_id FROM findings WHERE direction <> 'NEUTRAL' AND strength > 0 AND materiality > 0 AND signal_kind <> 'ARCHIVE_CONTEXT'")
def _(v: Views):
    return K.substantive(v.findings()).select("finding_id")


def roles():
    return F.when(F.col("source_class") == "PRIMARY", F.array(F.lit("CONFIRM"), F.lit("FACT"))).when(F.col("source_class") == "NEWS", F.array(F.lit("CONTEXT"))).otherwise(F.array(F.lit("OPINION")))


SQL["roled"] = "SELECT *, unnest(CASE source_class WHEN 'PRIMARY' THEN ['CONFIRM', 'FACT'] WHEN 'NEWS' THEN ['CONTEXT'] ELSE ['OPINION'] END) role FROM findings"


def quorum(v: Views):
    return v.spark.createDataFrame([("CONFIRM", 1), ("CONTEXT", 25), ("OPINION", 2), ("MISSING", 1)], "role string, required int")


@query("k4_role_coverage", """WITH q(role, required) AS (VALUES ('CONFIRM', 1), ('CONTEXT', 25), ('OPINION', 2), ('MISSING', 1)), g AS (SELECT role, least(count(DISTINCT publisher_group), count(DISTINCT origin_id), count(DISTINCT event_key)) n FROM roled GROUP BY 1) SELECT role, coalesce(n, 0) actual, required, coalesce(n, 0) < required gap FROM q LEFT JOIN g USING (role)""")
def _(v: Views):
    return K.role_coverage(v.findings().withColumn("roles", roles()), quorum(v))


@query("k5_role_coverage_by_security", """WITH q(role, required) AS (VALUES ('CONFIRM', 1), ('CONTEXT', 25), ('OPINION', 2), ('MISSING', 1)), g AS (SELECT security_code, role, least(count(DISTINCT publisher_group), count(DISTINCT cluster)) n FROM roled JOIN clusters USING (finding_id) GROUP BY 1, 2)
    SELECT s.security_code, q.role, coalesce(n, 0) actual, required, coalesce(n, 0) < required gap FROM (SELECT DISTINCT security_code FROM findings) s CROSS JOIN q LEFT JOIN g ON g.security_code = s.security_code AND g.role = q.role""")
def _(v: Views):
    return K.role_coverage(clustered(v).withColumn("roles", roles()), quorum(v), by_security=True)


@query("k6_universe_reconcile", """SELECT CAST(c_custkey AS VARCHAR) security_code, 'MISSING_SECURITY' code FROM customer WHERE c_custkey % 9 = 0 UNION ALL SELECT 'x' || c_custkey, 'EXTRA_SECURITY' FROM customer WHERE c_custkey % 50 = 1 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'TICKER_DIFFERS' FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 8 = 0""")
def _(v: Views):
    c, k = v.table("customer"), F.col("c_custkey")
    e = c.select(k.cast("string").alias("security_code"), F.col("c_name").alias("ticker"), k)
    covered = e.where(k % 9 != 0).withColumn("ticker", F.when(k % 8 == 0, "other").otherwise(F.col("ticker"))).unionByName(e.where(k % 50 == 1).withColumn("security_code", F.concat(F.lit("x"), "security_code")))
    return K.universe_reconcile(e, covered)


SQL["attempts_varied"] = """SELECT * REPLACE (CASE source_id WHEN 8 THEN 'COMPLETE' WHEN 9 THEN 'FAILED' ELSE CASE WHEN state = 'COMPLETE' AND source_id < 4 AND route_id % 7 = 0 THEN 'RETRY' ELSE state END END AS state) FROM attempts"""


def attempts(v: Views):
    """All attempts; sources 0 to 3 have routes that never complete, 8 always completes, 9 always fails."""
    source, state = F.col("source_id"), F.col("state")
    lost = (state == "COMPLETE") & (source < 4) & (F.col("route_id") % 7 == 0)
    return v.attempts().withColumn("state", F.when(source == 8, "COMPLETE").when(source == 9, "FAILED").when(lost, "RETRY").otherwise(state))


SQL["routes"] = """SELECT route_id, source_id, count(*) attempts, count(DISTINCT state) states, arg_max(state, (ts, event_id)) terminal_state, count(*) FILTER (b = 'COMPLETE') after_complete, count(*) FILTER (state = 'COMPLETE') completed, CASE WHEN count(*) FILTER (state = 'COMPLETE') > 0 THEN 'COMPLETE' WHEN arg_max(state, (ts, event_id)) = 'FAILED' THEN 'FAILED' ELSE 'OPEN' END outcome
    FROM (SELECT *, lag(state) OVER (PARTITION BY route_id ORDER BY ts, event_id) b FROM attempts_varied) GROUP BY 1, 2"""


def routes(v: Views):
    return K.attempt_routes(attempts(v))


SQL["src"] = """SELECT source_id, count(*) routes, count(*) FILTER (outcome = 'COMPLETE') complete, count(*) FILTER (outcome = 'FAILED') failed, CASE WHEN count(*) FILTER (outcome = 'COMPLETE') = count(*) THEN 'COMPLETE' WHEN count(*) FILTER (outcome = 'FAILED') = count(*) THEN 'FAILED' ELSE 'PARTIAL' END status FROM routes GROUP BY 1"""


@query("k7_attempt_routes", SQL["routes"].replace("attempts_varied", "attempts"))
def _(v: Views):
    return K.attempt_routes(v.attempts())


@query("k8_attempt_rollup", "SELECT * FROM src")
def _(v: Views):
    return K.attempt_rollup(routes(v))


@query("k9_advance_watermarks", """WITH i AS (SELECT source_id, max(ts) watermark FROM attempts WHERE source_id < 9 AND ts < TIMESTAMP '2024-01-10' GROUP BY 1) SELECT source_id, CASE WHEN status = 'COMPLETE' THEN greatest(TIMESTAMP '2024-01-29 12:00:00', coalesce(watermark, TIMESTAMP '1970-01-01')) ELSE watermark END watermark FROM i FULL JOIN src USING (source_id)""")
def _(v: Views):
    i = v.attempts().where("source_id < 9").where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).groupBy("source_id").agg(F.max("ts").alias("watermark"))
    return K.advance_watermarks(i, K.attempt_rollup(routes(v)), cut())


@query("k10_probe_freshness", """SELECT event_id probe_id, CASE WHEN event_at > TIMESTAMP '2024-01-29 12:00:01' OR floor(epoch(event_at)) > epoch(TIMESTAMP '2024-01-29 12:00:00') THEN 'FUTURE_PROBE' WHEN source_id = 'error' THEN 'FAILED_PROBE' WHEN (epoch(TIMESTAMP '2024-01-29 12:00:00') - floor(epoch(event_at))) / 3600 > 240 THEN 'EXPIRED_PROBE' ELSE 'FRESH' END code FROM ev""")
def _(v: Views):
    return K.probe_freshness(v.events().select(F.col("event_id").alias("probe_id"), F.col("event_at").alias("probed_at"), (F.col("source_id") != "error").alias("ok")), cut(), 240)


@query("k11_capability_gaps", """SELECT p_partkey product_id, list_sort(list_filter(list_distinct([p_brand, p_type]), lambda x: NOT list_contains(h, x))) missing FROM part, (SELECT list(p_brand) h FROM part WHERE p_size > 48)""")
def _(v: Views):
    p = v.table("part")
    return K.capability_gaps(p.select(F.col("p_partkey").alias("product_id"), F.array_distinct(F.array("p_brand", "p_type")).alias("required")), p.where("p_size > 48").select(F.col("p_brand").alias("capability")))


@query("k12_domain_coverage", "SELECT count(*) catalogue, count(*) FILTER (d IN ('example.com', 'example.org', 'example.net')) tried, count(*) FILTER (d IN ('example.com', 'example.org', 'example.net')) / count(*) share, false met FROM (VALUES ('example.com'), ('example.org'), ('example.net'), ('missing.com')) t(d)")
def _(v: Views):
    cat = v.spark.createDataFrame([("example.com",), ("example.org",), ("example.net",), ("missing.com",)], "domain string")
    return K.domain_coverage(v.table("pages"), cat, "url", 0.9)


@query("k13_evidence_ownership", """SELECT doc_id event_id, CASE WHEN doc_id % 6 = 0 THEN 'src1' ELSE source END source_id, sha256(text) sha256 FROM documents WHERE (CASE WHEN doc_id % 6 = 0 THEN 'src1' ELSE source END, sha256(text)) NOT IN (SELECT (source, sha256(text)) FROM documents)""")
def _(v: Views):
    d = v.table("documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return K.evidence_ownership(d.select(F.col("doc_id").alias("event_id"), F.when(F.col("doc_id") % 6 == 0, "src1").otherwise(F.col("source")).alias("source_id"), F.array("h").alias("hashes")), d.select(F.col("source").alias("source_id"), F.col("h").alias("sha256")))


@query("k14_capture_state_rollup", """SELECT route_id source_id, count(*) captures, CASE WHEN bool_and(s = 'AVAILABLE') THEN 'AVAILABLE' WHEN bool_or(s = 'AVAILABLE') THEN 'PARTIAL' ELSE arg_max(s, CASE s WHEN 'FAILED' THEN 2 ELSE 1 END) END state FROM (SELECT route_id, CASE state WHEN 'COMPLETE' THEN 'AVAILABLE' WHEN 'FAILED' THEN 'FAILED' ELSE 'BLOCKED' END s FROM attempts_varied) GROUP BY 1""")
def _(v: Views):
    c = attempts(v).select(F.col("route_id").alias("source_id"), F.when(F.col("state") == "COMPLETE", "AVAILABLE").when(F.col("state") == "FAILED", "FAILED").otherwise("BLOCKED").alias("state"))
    return K.capture_rollup(c, {"AVAILABLE": 0, "BLOCKED": 1, "FAILED": 2})


SQL["rf"] = """WITH b AS (SELECT *, row_number() OVER (PARTITION BY security_code ORDER BY trade_date DESC) back FROM gapped), s AS (SELECT security_code, max("close") FILTER (back = 1) c1, max("close") FILTER (back = 6) c6, max("close") FILTER (back = 21) c21, max(turnover) FILTER (back = 1) t1, avg(turnover) FILTER (back BETWEEN 2 AND 21) t20, max(volume) FILTER (back = 1) v1, avg(volume) FILTER (back BETWEEN 2 AND 21) v20 FROM b WHERE back <= 21 GROUP BY 1)
    SELECT s.security_code, CASE WHEN CAST(s.security_code AS INT) % 4 <> 0 THEN c1 / c6 - 1 END relative_return_5d, CASE WHEN CAST(s.security_code AS INT) % 4 <> 0 THEN c1 / c21 - 1 END relative_return_20d, t1 / t20 relative_value_20d, CASE WHEN CAST(s.security_code AS INT) % 4 <> 0 THEN v1 / v20 END relative_volume_20d, CAST(NULL AS DOUBLE) official_event_net_30d, 1 - nontrading_ratio liquidity_percentile FROM s JOIN liq USING (security_code)"""


def rank_features(v: Views):
    """Features of the heuristic rank from each security's last 21 bars; some are left unknown."""
    from pitmark.operators.signals import liquidity_metrics

    bars = v.gapped()
    back = F.row_number().over(Window.partitionBy("security_code").orderBy(F.desc("trade_date")))
    b, n = bars.withColumn("back", back).where("back <= 21"), F.col("back")
    at = lambda c, k: F.max(F.when(n == k, F.col(c)))
    mean = lambda c: F.avg(F.when(n >= 2, F.col(c)))
    some = F.col("security_code").cast("int") % 4 != 0
    g = b.groupBy("security_code").agg((at("close", 1) / at("close", 6) - 1).alias("r5"), (at("close", 1) / at("close", 21) - 1).alias("r20"), (at("turnover", 1) / mean("turnover")).alias("t"), (at("volume", 1) / mean("volume")).alias("vol"))
    m = liquidity_metrics(bars).select("security_code", (1 - F.col("nontrading_ratio")).alias("liquidity_percentile"))
    return g.join(m, "security_code").select("security_code", F.when(some, F.col("r5")).alias("relative_return_5d"), F.when(some, F.col("r20")).alias("relative_return_20d"), F.col("t").alias("relative_value_20d"), F.when(some, F.col("vol")).alias("relative_volume_20d"), F.lit(None).cast("double").alias("official_event_net_30d"), "liquidity_percentile")


@query("r1_heuristic_rank", """WITH c AS (SELECT *, ((relative_return_5d IS NOT NULL)::INT + (relative_return_20d IS NOT NULL)::INT + (relative_value_20d IS NOT NULL)::INT + (relative_volume_20d IS NOT NULL)::INT + (official_event_net_30d IS NOT NULL)::INT + (liquidity_percentile IS NOT NULL)::INT) / 6 cov FROM rf),
    s AS (SELECT *, CASE WHEN cov >= 0.67 THEN round(coalesce(0.25 * relative_return_5d, 0) + coalesce(0.15 * relative_return_20d, 0) + coalesce(0.20 * relative_value_20d, 0) + coalesce(0.15 * relative_volume_20d, 0) + coalesce(0.15 * official_event_net_30d, 0) + coalesce(0.10 * liquidity_percentile, 0), 9) END score FROM c), r AS (SELECT *, CASE WHEN score IS NOT NULL THEN row_number() OVER (PARTITION BY score IS NULL ORDER BY score DESC, security_code) END rk FROM s)
    SELECT security_code, round(score, 6) score, round(cov, 6) feature_coverage, score IS NULL abstained, rk "rank", coalesce(rk <= 10, false) selected FROM r""")
def _(v: Views):
    return rounded(R.heuristic_rank(rank_features(v), 10), "score", "feature_coverage")


POLICY = {"weights": {"CATALYST": 0.4, "TECHNICAL": 0.2, "SENTIMENT": 0.15, "FUNDAMENTAL": 0.25}, "quorum": {"CONFIRM": 2, "CONTEXT": 3}, "minimum_groups": 5, "minimum_coverage": 0.6, "community_cap": 0.05, "exact_universe": False}


@query("r2_mosaic_rank", """WITH strong AS (SELECT f.*, c.cluster FROM findings f JOIN clusters c USING (finding_id) WHERE direction <> 'NEUTRAL' AND strength > 0 AND materiality > 0),
    rp AS (SELECT s.*, CASE source_class WHEN 'PRIMARY' THEN 1.0 WHEN 'NEWS' THEN 0.7 ELSE 0.3 END rel FROM strong s WHERE finding_id IN (SELECT arg_max(finding_id, (round(CASE source_class WHEN 'PRIMARY' THEN 1.0 WHEN 'NEWS' THEN 0.7 ELSE 0.3 END * strength * materiality, 12), finding_id)) FROM strong GROUP BY cluster)),
    k AS (SELECT security_code, signal_kind, CASE signal_kind WHEN 'CATALYST' THEN 0.4 WHEN 'TECHNICAL' THEN 0.2 WHEN 'SENTIMENT' THEN 0.15 ELSE 0.25 END w, sum(CASE WHEN source_class <> 'COMMUNITY' THEN x ELSE 0 END) / count(*) a, sum(CASE WHEN source_class = 'COMMUNITY' THEN x ELSE 0 END) / count(*) b FROM (SELECT *, CASE direction WHEN 'POSITIVE' THEN 1 ELSE -1 END * strength * materiality * rel x FROM rp) GROUP BY 1, 2),
    c AS (SELECT security_code, sum(w) present, sum(abs(b * w)) community, CASE WHEN sum(abs(b * w)) > 0 THEN least(1.0, 0.05 / sum(abs(b * w))) ELSE 0 END sc FROM k GROUP BY 1),
    t AS (SELECT security_code, greatest(-1.0, least(1.0, sum(greatest(-1.0, least(1.0, a * w + b * w * sc))))) total, any_value(present) present FROM k JOIN c USING (security_code) GROUP BY 1),
    g AS (SELECT security_code, count(DISTINCT publisher_group) groups FROM rp GROUP BY 1),
    cf AS (SELECT security_code, list_sort(list_distinct(list(signal_kind || ':' || event_key))) conflicts FROM (SELECT security_code, signal_kind, event_key, list_sort(list_distinct(list(publisher_group) FILTER (direction = 'POSITIVE'))) p, list_sort(list_distinct(list(publisher_group) FILTER (direction = 'NEGATIVE'))) n FROM rp WHERE round(strength * materiality, 9) >= 0.35 GROUP BY 1, 2, 3) WHERE len(p) > 0 AND len(n) > 0 AND NOT (len(p) = 1 AND p = n) GROUP BY 1),
    rc AS (SELECT security_code, role, least(count(DISTINCT publisher_group), count(DISTINCT cluster)) n FROM (SELECT *, unnest(CASE source_class WHEN 'PRIMARY' THEN ['CONFIRM', 'FACT'] WHEN 'NEWS' THEN ['CONTEXT'] ELSE ['OPINION'] END) role FROM strong) GROUP BY 1, 2),
    gp AS (SELECT security_code, list_sort(list('PER_SECURITY_ROLE_QUORUM:' || role || ':' || coalesce(n, 0) || '/' || need)) gaps FROM (SELECT s.security_code, q.role, q.need, rc.n FROM (SELECT DISTINCT security_code FROM findings) s CROSS JOIN (VALUES ('CONFIRM', 2), ('CONTEXT', 3)) q(role, need) LEFT JOIN rc ON rc.security_code = s.security_code AND rc.role = q.role) WHERE coalesce(n, 0) < need GROUP BY 1),
    j AS (SELECT s.security_code, coalesce(round(50 + 50 * total, 4), 50.0) score, coalesce(round(present / 1.0, 6), 0.0) evidence_coverage, coalesce(groups, 0) groups, coalesce(conflicts, []) cf, coalesce(gaps, []) gaps FROM (SELECT DISTINCT security_code FROM findings) s LEFT JOIN t USING (security_code) LEFT JOIN g USING (security_code) LEFT JOIN cf USING (security_code) LEFT JOIN gp USING (security_code)),
    x AS (SELECT *, list_concat(gaps, CASE WHEN groups < 5 THEN ['INSUFFICIENT_SOURCE_DIVERSITY'] WHEN evidence_coverage < 0.6 THEN ['INSUFFICIENT_SIGNAL_COVERAGE'] WHEN len(cf) > 0 THEN ['INDEPENDENT_SOURCE_CONFLICT:' || array_to_string(cf, ',')] ELSE [] END) reasons FROM j), y AS (SELECT *, CASE WHEN groups < 5 OR evidence_coverage < 0.6 THEN 'ABSTAIN' WHEN len(reasons) > 0 THEN 'WATCH' ELSE 'RESEARCH_CANDIDATE' END status FROM x)
    SELECT security_code, round(score, 3) score, evidence_coverage, groups, status, reasons, 'CANDIDATE_SET_RESEARCH_RANK' scope_label, row_number() OVER (ORDER BY score DESC, security_code) "rank", status = 'RESEARCH_CANDIDATE' AND sum((status = 'RESEARCH_CANDIDATE')::INT) OVER (ORDER BY score DESC, security_code ROWS UNBOUNDED PRECEDING) <= 5 selected FROM y""")
def _(v: Views):
    f = v.findings().withColumn("roles", roles())
    return rounded(R.mosaic_rank(f, POLICY, reliability(), 5), "score", places=3)


SQL["snap"] = """SELECT CAST(c_custkey AS VARCHAR) security_code, f factor_id, f <> 'f3' required, CASE WHEN c_custkey % 10 = k THEN 'MISSING' WHEN c_custkey % 23 = k THEN 'REJECTED' ELSE 'OBSERVED' END status, CASE WHEN NOT (c_custkey % 10 = k) AND NOT (c_custkey % 23 = k) THEN c_acctbal * k END "value" FROM customer CROSS JOIN (VALUES ('f1', 1), ('f2', 2), ('f3', 3)) t(f, k)"""


def registry(v: Views):
    return v.spark.createDataFrame([("f1", True), ("f2", True), ("f3", False)], "factor_id string, required boolean")


def snapshot(v: Views):
    c, k = v.table("customer"), F.col("c_custkey")
    n = F.substring("factor_id", 2, 1).cast("int")
    inputs = c.select(k.cast("string").alias("security_code"), k, "c_acctbal", F.explode(F.array(*map(F.lit, ("f1", "f2", "f3")))).alias("factor_id")).where(k % 10 != n).select("security_code", "factor_id", F.when(k % 23 == n, "REJECTED").otherwise("OBSERVED").alias("status"), (F.col("c_acctbal") * n).alias("value"))
    return R.factor_snapshot(c.select(k.cast("string").alias("security_code")), registry(v), inputs)


@query("r3_factor_snapshot", """SELECT security_code, count(*) FILTER (status = 'OBSERVED') observed, count(*) FILTER (status = 'MISSING') missing, count(*) FILTER (status = 'REJECTED') rejected, avg(CAST(status = 'OBSERVED' AS INT)) FILTER (required) required_coverage, CASE WHEN count(*) FILTER (status = 'REJECTED') > 0 THEN 'REJECTED' WHEN avg(CAST(status = 'OBSERVED' AS INT)) FILTER (required) < 1 THEN 'INCOMPLETE' ELSE 'ELIGIBLE' END disposition FROM snap GROUP BY 1""")
def _(v: Views):
    return R.snapshot_dispositions(snapshot(v))


@query("r4_disposition_violations", """WITH d AS (SELECT security_code, count(*) FILTER (status = 'REJECTED') rejected, avg(CAST(status = 'OBSERVED' AS INT)) FILTER (required) cov FROM snap GROUP BY 1) SELECT security_code, 'SELECTED_WITHOUT_COVERAGE' code FROM d WHERE cov < 1 UNION ALL SELECT security_code, 'SELECTED_WITH_REJECTED_FACTOR' FROM d WHERE rejected > 0 UNION ALL SELECT security_code, 'SELECTED_NOT_TRADING' FROM d WHERE CAST(security_code AS INT) % 9 = 0""")
def _(v: Views):
    d = R.snapshot_dispositions(snapshot(v)).withColumn("disposition", F.lit("SELECTED")).withColumn("status", F.when(F.col("security_code").cast("int") % 9 == 0, "SUSPENDED").otherwise("TRADING")).withColumn("score", F.lit(1.0)).withColumn("stage", F.lit("RANKED"))
    return R.disposition_violations(d)


@query("r5_snapshot_violations", """SELECT security_code, factor_id, 'MISSING_CELL' code FROM snap WHERE CAST(security_code AS INT) % 40 = 0 AND factor_id = 'f2' UNION ALL SELECT security_code, factor_id, 'DUPLICATE_CELL' FROM snap WHERE CAST(security_code AS INT) % 60 = 1 UNION ALL SELECT security_code, factor_id, 'OBSERVED_WITHOUT_VALUE' FROM snap WHERE status = 'OBSERVED' AND CAST(security_code AS INT) % 70 = 2""")
def _(v: Views):
    s, k = snapshot(v), F.col("security_code").cast("int")
    bad = s.where(~((k % 40 == 0) & (F.col("factor_id") == "f2"))).withColumn("value", F.when(k % 70 != 2, F.col("value")))
    return R.snapshot_violations(bad.unionByName(bad.where(k % 60 == 1)), s, registry(v))


@query("r6_full_market_claim", "SELECT count(*) FILTER (c_custkey % 100 <> 0) ranked, count(*) FILTER (c_custkey % 100 = 0) missing, 0 extra, count(*) FILTER (c_custkey % 100 = 7) gaps, false allowed FROM customer")
def _(v: Views):
    c = v.table("customer").select(F.col("c_custkey").cast("string").alias("security_code"), (F.col("c_custkey") % 100 == 7).alias("has_gap"), "c_custkey")
    return R.full_market_claim(c.where("c_custkey % 100 <> 0"), c)


@query("r7_rank_consistency", """WITH e AS (SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY score DESC, CAST(security_code AS INT), security_code) er FROM outcomes), x AS (SELECT *, er + CASE WHEN CAST(security_code AS INT) % 33 = 0 THEN 1 ELSE 0 END r, er <= 5 AND CAST(security_code AS INT) % 10 <> 0 sel FROM e) SELECT decision_id, security_code, r "rank", er expected_rank, sel selected FROM x WHERE r <> er OR sel <> (er <= 5)""")
def _(v: Views):
    k = F.col("security_code").cast("int")
    er = F.row_number().over(Window.partitionBy("decision_id").orderBy(F.desc("score"), k, "security_code"))
    x = v.outcomes().withColumn("er", er).withColumn("rank", F.col("er") + F.when(k % 33 == 0, 1).otherwise(0)).withColumn("selected", (F.col("er") <= 5) & (k % 10 != 0))
    return R.rank_consistency(x, 5)


@query("r8_scope_violations", """SELECT o_orderkey request_id, 'PACKET_MISSING' code FROM orders WHERE o_orderkey % 21 = 0 UNION ALL SELECT o_orderkey, 'SCOPE_INCOMPATIBLE' FROM orders WHERE o_orderkey % 21 <> 0 AND o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey, 'SECURITY_UNRESOLVED' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 15 = 0 UNION ALL SELECT o_orderkey, 'LIST_IN_FULL_MARKET_CLAIM' FROM orders WHERE o_orderkey % 2 = 1""")
def _(v: Views):
    o, k = v.table("orders"), F.col("o_orderkey")
    scope = F.when(k % 2 == 0, "SECURITIES").otherwise("FULL_MARKET")
    req = o.select(k.alias("request_id"), scope.alias("scope"), F.array(F.col("o_custkey").cast("string")).alias("securities"))
    return R.scope_violations(req, o.where(k % 21 != 0).select(k.alias("request_id"), F.when(k % 10 == 0, "OTHER").otherwise(scope).alias("scope")), o.where(k % 15 != 0).select(k.alias("request_id"), F.col("o_custkey").cast("string").alias("security_code")))


@query("r9_candidate_contract", """WITH c AS (SELECT o_orderstatus run_id, CAST(o_orderkey AS VARCHAR) security_code, o_orderkey k, o_totalprice / 4800 score FROM orders) SELECT run_id, security_code, 'SCORE_OUT_OF_RANGE' code FROM c WHERE score > 100 UNION ALL SELECT run_id, security_code, 'PROBABILITY_RECORDED' FROM c WHERE k % 5 = 0 UNION ALL SELECT run_id, security_code, 'CANDIDATE_WITH_REASONS' FROM c WHERE k % 2 = 0 AND k % 7 = 0
    UNION ALL SELECT run_id, security_code, 'STATUS_WITHOUT_REASON' FROM c WHERE k % 2 = 1 AND k % 7 <> 0 UNION ALL SELECT run_id, security_code, 'SELECTED_NOT_CANDIDATE' FROM c WHERE k % 11 = 0 AND k % 2 = 1""")
def _(v: Views):
    k = F.col("o_orderkey")
    c = v.table("orders").select(F.col("o_orderstatus").alias("run_id"), k.cast("string").alias("security_code"), k.alias("rank"), (F.col("o_totalprice") / 4800).alias("score"), F.when(k % 5 == 0, 0.5).alias("probability"), F.when(k % 2 == 0, "RESEARCH_CANDIDATE").otherwise("WATCH").alias("status"), F.when(k % 7 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("reasons"), (k % 11 == 0).alias("selected"))
    return R.candidate_contract_violations(c)
