"""Event, signal and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitmark.operators import events as E
from pitmark.operators import signals as S
from pitmark.plans.registry import query
from pitmark.plans.views import SQL, Views

SQL["canonical"] = """WITH p AS (SELECT DISTINCT original_event_id pid FROM ev WHERE original_event_id IS NOT NULL)
    SELECT security_code, coalesce(CAST(original_event_id AS VARCHAR), CASE WHEN p.pid IS NOT NULL THEN CAST(event_id AS VARCHAR) END, content_hash) canonical_event_id, arg_min(direction, (first_available_at, event_id)) direction, arg_min(novelty, (first_available_at, event_id)) novelty, min(first_available_at) first_available_at, max(captured_at) last_captured_at,
    list_sort(list_distinct(list(source_id))) source_ids, count(*) diffusion_count, count(DISTINCT source_id) source_diversity, bool_or(source_role = 'PRIMARY_OFFICIAL') official_fact_seen FROM ev LEFT JOIN p ON p.pid = event_id GROUP BY 1, 2"""
SQL["toks"] = """SELECT finding_id, security_code, signal_kind, direction, available_at, list_distinct(regexp_extract_all(regexp_replace(lower(claim_text), 'https?://\\S+', ' ', 'g'), '[\\p{L}\\p{M}\\p{N}_]{3,}')) t FROM findings"""
SQL["stretches"] = """SELECT *, sum(CASE WHEN prior IS NOT NULL AND lo - prior <= 259200 THEN 0 ELSE 1 END) OVER (PARTITION BY security_code, signal_kind, direction, s ORDER BY stretch ROWS UNBOUNDED PRECEDING) run FROM (SELECT *, lag(hi) OVER w prior, lag(rep) OVER w last_rep FROM (
    SELECT security_code, signal_kind, direction, list_sort(t) s, CAST(floor(epoch(available_at) / 259200) AS BIGINT) stretch, min(finding_id) rep, min(epoch(available_at)) lo, max(epoch(available_at)) hi FROM toks WHERE direction <> 'NEUTRAL' AND len(t) >= 6 GROUP BY ALL) WINDOW w AS (PARTITION BY security_code, signal_kind, direction, s ORDER BY stretch))"""
SQL["runs"] = """SELECT security_code, signal_kind, direction, s, run, min(rep) rep, min(lo) lo, max(hi) hi FROM stretches GROUP BY ALL"""
SQL["near"] = """SELECT rep a, finding_id b FROM toks JOIN stretches c USING (security_code, signal_kind, direction) WHERE c.s = list_sort(t) AND stretch = CAST(floor(epoch(available_at) / 259200) AS BIGINT) AND finding_id <> rep
    UNION ALL SELECT least(last_rep, rep), greatest(last_rep, rep) FROM stretches WHERE lo - prior <= 259200
    UNION ALL SELECT least(a.rep, b.rep), greatest(a.rep, b.rep) FROM runs a JOIN runs b ON a.security_code = b.security_code AND a.signal_kind = b.signal_kind AND a.direction = b.direction AND a.s < b.s AND a.lo - b.hi <= 259200 AND b.lo - a.hi <= 259200 AND least(len(a.s), len(b.s)) >= 0.82 * greatest(len(a.s), len(b.s))
    WHERE len(list_intersect(a.s, b.s)) >= 0.9 * least(len(a.s), len(b.s)) AND len(list_intersect(a.s, b.s)) >= 0.82 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s)))"""


@query("e1_canonical_events", "SELECT * FROM canonical")
def _(v: Views):
    return E.canonical_events(v.events()).select("security_code", "canonical_event_id", "direction", "novelty", "first_available_at", "last_captured_at", "source_ids", "diffusion_count", "source_diversity", "official_fact_seen")


@query("e2_relation_violations", """WITH x AS (SELECT event_id, security_code, CASE WHEN event_id % 97 = 0 THEN event_id + 1000000 WHEN event_id % 89 = 0 THEN event_id - 1 ELSE original_event_id END o FROM ev)
    SELECT x.event_id, CASE WHEN p.event_id IS NULL THEN 'MISSING_ORIGINAL' ELSE 'RELATION_CROSSES_SECURITIES' END code FROM x LEFT JOIN ev p ON p.event_id = x.o WHERE x.o IS NOT NULL AND (p.event_id IS NULL OR p.security_code <> x.security_code)""")
def _(v: Views):
    k = F.col("event_id")
    return E.relation_violations(v.events().withColumn("original_event_id", F.when(k % 97 == 0, k + 1_000_000).when(k % 89 == 0, k - 1).otherwise(F.col("original_event_id"))))


SQL["ctx"] = """WITH RECURSIVE e AS (SELECT event_id a, min(event_id) OVER (PARTITION BY security_code, origin_id) b FROM ev UNION ALL SELECT event_id, min(event_id) OVER (PARTITION BY security_code, content_hash) FROM ev UNION ALL SELECT event_id, original_event_id FROM ev WHERE original_event_id IS NOT NULL),
    s AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b), r AS (SELECT event_id n, event_id c FROM ev UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.n WHERE r.c < s.b) SELECT n event_id, min(c) component FROM r GROUP BY 1"""


@query("e3_context_components", "SELECT event_id, component FROM ctx")
def _(v: Views):
    return E.context_components(v.events()).select("event_id", "component")


@query("e4_context_canonical", """SELECT 'ctx-' || substring(sha256(CAST(component AS VARCHAR)), 1, 16) context_id, arg_min(event_id, (first_available_at, event_id)) canonical_id, count(*) members, list_sort(list_distinct(list(source_id))) source_ids, min(first_available_at) first_available_at,
    list_filter([CASE WHEN d <= 120 THEN '120d' END, CASE WHEN d <= 30 THEN '30d' END, CASE WHEN d <= 7 THEN '7d' END, CASE WHEN d <= 3 THEN '72h' END], lambda x: x IS NOT NULL) windows, CASE WHEN count(DISTINCT direction) FILTER (direction <> 'NEUTRAL') > 1 THEN ['DIRECTION_CONFLICT'] ELSE [] END codes
    FROM (SELECT *, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(min(first_available_at) OVER (PARTITION BY component))) / 86400000000 d FROM ev JOIN ctx USING (event_id)) GROUP BY component, d""")
def _(v: Views):
    return E.context_canonical(E.context_components(v.events()), F.lit("2024-01-31").cast("timestamp_ntz"))


@query("e5_fold_fact_status", """WITH x AS (SELECT *, CAST(content_hash AS INT) h FROM ev) SELECT content_hash, CASE WHEN bool_or(source_id = 'error' AND h % 3 = 0) THEN 'DISPUTED' WHEN bool_or(source_id = 'purchase' AND h % 3 < 2) THEN 'CONFIRMED' ELSE 'UNCONFIRMED' END factual_status,
    CASE WHEN bool_or(direction = 'POSITIVE') AND bool_or(direction = 'NEGATIVE' AND h % 2 = 1) THEN 'CONTRADICTED' ELSE 'CONSISTENT' END contradiction_status, CASE WHEN bool_or(event_id % 40 = 0 AND h % 5 = 0) THEN 'CORRECTED' ELSE 'ORIGINAL' END correction_status FROM x GROUP BY 1""")
def _(v: Views):
    h, c, d = F.col("content_hash").cast("int"), F.col("source_id"), F.col("direction")
    fact = F.when((c == "error") & (h % 3 == 0), "DISPUTED").when((c == "purchase") & (h % 3 < 2), "CONFIRMED").otherwise("UNCONFIRMED")
    e = v.events().withColumn("factual_status", fact).withColumn("direction", F.when((d == "NEGATIVE") & (h % 2 == 0), "NEUTRAL").otherwise(d)).withColumn("corrected", (F.col("event_id") % 40 == 0) & (h % 5 == 0))
    return E.fold_fact_status(e, "content_hash")


@query("e6_claim_tokens", "SELECT finding_id, len(t) tokens FROM toks")
def _(v: Views):
    from pitmark.functions.columns import claim_tokens

    return v.findings().select("finding_id", F.size(claim_tokens(F.col("claim_text"))).cast("long").alias("tokens"))


STARS = """SELECT a, b, why FROM (SELECT min(finding_id) OVER (PARTITION BY security_code, signal_kind, direction, event_key) a, finding_id b, 'event_key' why FROM findings WHERE direction <> 'NEUTRAL' UNION ALL SELECT min(finding_id) OVER (PARTITION BY security_code, signal_kind, direction, origin_id), finding_id, 'origin_id' FROM findings WHERE direction <> 'NEUTRAL') WHERE a <> b"""


@query("e7_near_duplicate_pairs", f"SELECT a, b, 'claim_text' why FROM near UNION ALL {STARS}")
def _(v: Views):
    return E.near_duplicate_pairs(v.findings())


SQL["clusters"] = f"""WITH RECURSIVE e AS (SELECT a, b FROM near UNION SELECT a, b FROM ({STARS})), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT finding_id n, finding_id c FROM findings UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.n WHERE r.c < s.b) SELECT n finding_id, min(c) cluster FROM r GROUP BY 1"""


def clustered(v: Views):
    f = v.findings()
    return E.claim_clusters(f, E.near_duplicate_pairs(f))


@query("e8_claim_clusters", "SELECT finding_id, cluster FROM clusters")
def _(v: Views):
    return clustered(v).select("finding_id", "cluster")


RELIABLE = "CASE source_class WHEN 'PRIMARY' THEN 1.0 WHEN 'NEWS' THEN 0.7 ELSE 0.3 END"


def reliability():
    return F.when(F.col("source_class") == "PRIMARY", 1.0).when(F.col("source_class") == "NEWS", 0.7).otherwise(0.3)


SQL["reps"] = f"SELECT cluster, arg_max(finding_id, (round({RELIABLE} * strength * materiality, 12), finding_id)) finding_id, count(*) members, max(round({RELIABLE} * strength * materiality, 12)) weight FROM findings JOIN clusters USING (finding_id) GROUP BY 1"


@query("e9_cluster_representative", "SELECT cluster, finding_id, members, round(weight, 8) weight FROM reps")
def _(v: Views):
    return E.cluster_representatives(clustered(v), reliability()).withColumn("weight", F.round("weight", 8))


@query("e10_source_conflicts", """WITH s AS (SELECT * REPLACE (CAST(finding_id % 12 AS VARCHAR) AS event_key, CAST(finding_id // 60 AS VARCHAR) AS publisher_group) FROM findings WHERE direction <> 'NEUTRAL' AND round(strength * materiality, 9) >= 0.05), g AS (SELECT security_code, signal_kind, event_key, coalesce(list_sort(list_distinct(list(publisher_group) FILTER (direction = 'POSITIVE'))), []) positive, coalesce(list_sort(list_distinct(list(publisher_group) FILTER (direction = 'NEGATIVE'))), []) negative FROM s GROUP BY 1, 2, 3)
    SELECT * FROM g WHERE len(positive) > 0 AND len(negative) > 0 AND NOT (len(positive) = 1 AND positive = negative)""")
def _(v: Views):
    return E.source_conflicts(v.findings().withColumn("event_key", (F.col("finding_id") % 12).cast("string")).withColumn("publisher_group", F.floor(F.col("finding_id") / 60).cast("string")), 0.05)


@query("e11_exposure_violations", """WITH x AS (SELECT event_id exposure_id, CASE WHEN event_id % 31 = 0 THEN 'none' ELSE coalesce(CAST(original_event_id AS VARCHAR), content_hash) END c, CASE WHEN event_id % 17 = 0 THEN '99' ELSE security_code END code_, security_code, source_id, round(value / 500, 4) confidence, event_id % 3 = 0 eligible, CASE WHEN event_id % 5 = 0 THEN 'CONTRADICTED' ELSE 'CONSISTENT' END status FROM ev),
    c AS (SELECT canonical_event_id, list_distinct(flatten(list(source_ids))) s FROM canonical GROUP BY 1), j AS (SELECT x.*, c.s FROM x LEFT JOIN c ON c.canonical_event_id = x.c)
    SELECT exposure_id, 'EVENT_UNRESOLVED' code FROM j WHERE s IS NULL UNION ALL SELECT exposure_id, 'SECURITY_OUTSIDE_UNIVERSE' FROM j WHERE code_ = '99' UNION ALL SELECT exposure_id, 'EVIDENCE_DOES_NOT_OVERLAP' FROM j WHERE s IS NOT NULL AND NOT list_contains(s, source_id)
    UNION ALL SELECT exposure_id, 'FACTOR_NOT_ELIGIBLE' FROM j WHERE eligible AND (confidence < 0.5 OR status <> 'CONSISTENT')""")
def _(v: Views):
    e, k = v.events(), F.col("event_id")
    x = e.select(k.alias("exposure_id"), F.when(k % 31 == 0, "none").otherwise(F.coalesce(F.col("original_event_id").cast("string"), "content_hash")).alias("canonical_event_id"), F.when(k % 17 == 0, "99").otherwise(F.col("security_code")).alias("security_code"), F.array("source_id").alias("sources"), F.round(F.col("value") / 500, 4).alias("confidence"), (k % 3 == 0).alias("factor_eligible"), F.when(k % 5 == 0, "CONTRADICTED").otherwise("CONSISTENT").alias("contradiction_status"))
    canon = E.canonical_events(e).groupBy("canonical_event_id").agg(F.array_distinct(F.flatten(F.collect_list("source_ids"))).alias("source_ids"))
    return E.exposure_violations(x, canon, e)


@query("e12_repost_count", "SELECT count(*) - count(DISTINCT (security_code, origin_id, event_key, signal_kind)) reposts FROM findings")
def _(v: Views):
    return E.repost_count(v.findings())


@query("e13_window_tags", """SELECT event_id, list_filter(['120d', CASE WHEN d <= 30 THEN '30d' END, CASE WHEN d <= 7 THEN '7d' END, CASE WHEN d <= 3 THEN '72h' END], lambda x: x IS NOT NULL) windows FROM (SELECT event_id, (epoch_us(TIMESTAMP '2024-02-02') - epoch_us(first_available_at)) / 86400000000 d FROM ev)""")
def _(v: Views):
    age = (F.unix_micros(F.lit("2024-02-02").cast("timestamp")) - F.unix_micros(F.col("first_available_at").cast("timestamp"))) / 86_400_000_000
    return v.events().select("event_id", E.window_tags(age).alias("windows"))


@query("e14_claim_support_violations", """WITH x AS (SELECT event_id claim_id, source_role r, CASE WHEN event_id % 2 = 0 THEN 'PRIMARY_OFFICIAL' ELSE 'NEWS_CONTEXT' END need, CASE WHEN event_id % 3 = 0 THEN 'FACT' ELSE 'OPINION' END f, CASE WHEN event_id % 5 = 0 THEN 'CONFIRMED' ELSE 'OPEN' END s FROM ev)
    SELECT claim_id, 'REQUIRED_ROLE_MISSING' code FROM x WHERE r <> need UNION ALL SELECT claim_id, 'COMMUNITY_CANNOT_ESTABLISH_FACT' FROM x WHERE r = 'SOCIAL' AND f = 'FACT' UNION ALL SELECT claim_id, 'CONFIRMED_WITHOUT_PRIMARY' FROM x WHERE s = 'CONFIRMED' AND r <> 'PRIMARY_OFFICIAL'""")
def _(v: Views):
    e, k = v.events(), F.col("event_id")
    claims = e.select(k.alias("claim_id"), F.array("source_id").alias("source_ids"), F.when(k % 2 == 0, "PRIMARY_OFFICIAL").otherwise("NEWS_CONTEXT").alias("required_role"), F.when(k % 3 == 0, "FACT").otherwise("OPINION").alias("fact_type"), F.when(k % 5 == 0, "CONFIRMED").otherwise("OPEN").alias("status"))
    return E.claim_support_violations(claims, e.select("source_id", F.col("source_role").alias("role")).distinct())


@query("e15_empty_year_support", """SELECT o_orderkey record_id, list_filter([CASE WHEN o_orderkey % 4 = 0 THEN 'SOURCE_WITHOUT_RECEIPT' END, CASE WHEN o_orderkey % 6 = 0 THEN 'RECEIPT_OF_UNDECLARED_SOURCE' END, CASE WHEN o_orderkey % 9 = 0 THEN 'RECEIPT_INCOMPLETE' END], lambda x: x IS NOT NULL) codes FROM orders""")
def _(v: Views):
    k = F.col("o_orderkey")
    receipt = lambda s, ok: F.struct(F.lit(s).alias("source_id"), ok.alias("complete"))
    r = v.table("orders").select(k.alias("record_id"), F.when(k % 4 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("declared"), F.when(k % 6 == 0, F.array(receipt("a", k % 9 != 0), receipt("c", F.lit(True)))).otherwise(F.array(receipt("a", k % 9 != 0))).alias("receipts"))
    return E.empty_year_support(r)


@query("e16_annual_coverage_plan", """WITH s AS (SELECT r_name layer, n_name source_id, 1995 + n_nationkey % 8 y FROM nation JOIN region ON r_regionkey = n_regionkey), g AS (SELECT r_name layer, CAST(unnest(range(1994, 2003)) AS INT) "year" FROM region)
    SELECT layer, "year", l source_ids, CASE len(l) WHEN 0 THEN 'UNCOVERED' WHEN 1 THEN 'SINGLE_SOURCE' ELSE 'COVERED' END status FROM (SELECT g.layer, "year", coalesce(list_sort(list(source_id) FILTER (y <= "year")), []) l FROM g LEFT JOIN s USING (layer) GROUP BY 1, 2)""")
def _(v: Views):
    r, n = v.table("region"), v.table("nation")
    s = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("layer"), F.col("n_name").alias("source_id"), (1995 + F.col("n_nationkey") % 8).alias("from_year"))
    return E.annual_coverage_plan(r.select(F.col("r_name").alias("layer")), s, 1994, 2002)


SQL["trail"] = """SELECT *, "close" / lag("close") OVER (PARTITION BY security_code ORDER BY trade_date) - 1 ret FROM (SELECT *, row_number() OVER (PARTITION BY security_code ORDER BY trade_date DESC) back FROM gapped) WHERE back <= 20"""


def rounded(df, *columns, places: int = 6):
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("f1_price_window_signals", """SELECT security_code, n bars, round(r, 6) trailing_return, round(vol, 6) volatility, round(dd, 6) drawdown, CASE WHEN r > 0.005 THEN 'POSITIVE' WHEN r < -0.005 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(least(1.0, abs(r) / 0.10), 6) strength, round(least(1.0, 0.4 + n / 100), 6) materiality, CAST(NULL AS VARCHAR) code
    FROM (SELECT security_code, count(*) n, arg_max("close", trade_date) / arg_min("close", trade_date) - 1 r, stddev_pop(ret) vol, arg_max("close", trade_date) / max("close") - 1 dd FROM trail GROUP BY 1)""")
def _(v: Views):
    return rounded(S.price_window_signals(v.gapped()), "trailing_return", "volatility", "drawdown", "strength", "materiality")


@query("f2_price_activity_signal", """SELECT security_code, round(r, 6) last_return, round(q, 6) volume_ratio, CASE WHEN r > 0.002 THEN 'POSITIVE' WHEN r < -0.002 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(CASE WHEN q IS NULL THEN least(1.0, abs(r) / 0.05) ELSE least(1.0, least(1.0, abs(r) / 0.05) * least(2.0, greatest(0.5, q))) END, 6) strength, CASE WHEN q IS NULL THEN 0.35 ELSE 0.6 END materiality
    FROM (SELECT security_code, max(ret) FILTER (back = 1) r, max(volume) FILTER (back = 1) / median(volume) FILTER (back > 1 AND volume > 0) q FROM trail GROUP BY 1)""")
def _(v: Views):
    return rounded(S.price_activity_signal(v.gapped()), "last_return", "volume_ratio", "strength")


@query("f3_liquidity_signal", """SELECT security_code, missing, zero, round(q, 6) nontrading_ratio, CASE WHEN q >= 0.2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(least(1.0, q / 0.5), 6) strength FROM (SELECT security_code, count(*) FILTER (volume IS NULL) missing, count(*) FILTER (volume = 0) zero, (count(*) FILTER (volume IS NULL OR volume = 0)) / count(*) q FROM gapped GROUP BY 1)""")
def _(v: Views):
    return rounded(S.liquidity_signal(v.gapped()), "nontrading_ratio", "strength")


SQL["fund"] = """SELECT CAST(c_custkey AS VARCHAR) security_code, c_acctbal * 10 revenue, c_acctbal - 1000 net_income, c_acctbal - 500 - c_custkey % 7 * 200 ocf, 3000.0 total_debt, c_acctbal equity, 5000.0 + c_custkey % 11 * 5000 p_revenue, CASE WHEN c_custkey % 13 = 0 THEN 0.0 ELSE 900.0 END p_net_income FROM customer"""


@query("f4_fundamental_quality", """WITH x AS (SELECT security_code, CAST(net_income > 0 AS INT) + CAST(ocf > 0 AS INT) + CAST(ocf >= net_income AS INT) + CAST(revenue / p_revenue - 1 > 0 AS INT) + CAST(p_net_income > 0 AND net_income / nullif(p_net_income, 0) - 1 > 0 AS INT) + CAST(equity > 0 AND total_debt / nullif(equity, 0) <= 1.5 AS INT) votes FROM fund)
    SELECT security_code, votes, CASE WHEN votes >= 4 THEN 'POSITIVE' WHEN votes <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(abs(votes / 6 - 0.5) * 2, 6) strength FROM x""")
def _(v: Views):
    c, k, a = v.table("customer"), F.col("c_custkey"), F.col("c_acctbal")
    code = k.cast("string").alias("security_code")
    cur = c.select(code, (a * 10).alias("revenue"), (a - 1000).alias("net_income"), (a - 500 - k % 7 * 200).alias("operating_cash_flow"), F.lit(3000.0).alias("total_debt"), a.alias("equity"))
    old = c.select(code, (5000.0 + k % 11 * 5000).alias("revenue"), F.when(k % 13 == 0, 0.0).otherwise(900.0).alias("net_income"), F.lit(0.0).alias("operating_cash_flow"), F.lit(0.0).alias("total_debt"), F.lit(1.0).alias("equity"))
    return rounded(S.fundamental_quality(cur, old), "strength")


@query("f5_sentiment_signal", """WITH o AS (SELECT security_code, origin_id, arg_max(struct_pack(author_id, tone, reliability), (reliability, -seq)) b FROM posts GROUP BY 1, 2), g AS (SELECT security_code, count(*) origins, count(DISTINCT b.author_id) authors, coalesce(sum(b.tone * b.reliability) / nullif(sum(b.reliability), 0), 0) t FROM o GROUP BY 1)
    SELECT security_code, origins, authors, round(t, 6) weighted_tone, CASE WHEN authors < 2 THEN 'NEUTRAL' WHEN t > 0.1 THEN 'POSITIVE' WHEN t < -0.1 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(CASE WHEN authors >= 2 THEN least(1.0, abs(t) / 0.75) ELSE 0 END, 6) strength, least(0.5, authors / 10) materiality FROM g""")
def _(v: Views):
    return rounded(S.sentiment_signal(v.posts()), "weighted_tone", "strength")


SQL["liq"] = """SELECT security_code, count(*) sessions, count(*) FILTER (volume > 0) traded_sessions, count(*) FILTER (volume IS NULL) missing_volume_sessions, count(*) FILTER (volume = 0) zero_volume_sessions, count(*) FILTER (abs(ret) < 1e-15) zero_return_sessions, (count(*) FILTER (coalesce(volume, 0) = 0)) / count(*) nontrading_ratio,
    median(volume) FILTER (volume > 0) median_volume, median(turnover) FILTER (turnover > 0) median_turnover, avg(abs(ret) / turnover) FILTER (turnover > 0 AND volume > 0) amihud_illiquidity FROM (SELECT *, "close" / lag("close") OVER (PARTITION BY security_code ORDER BY trade_date) - 1 ret FROM gapped) GROUP BY 1"""


@query("f6_liquidity_metrics", "SELECT * REPLACE (round(nontrading_ratio, 6) AS nontrading_ratio, round(median_turnover, 4) AS median_turnover, round(amihud_illiquidity, 12) AS amihud_illiquidity) FROM liq")
def _(v: Views):
    m = rounded(S.liquidity_metrics(v.gapped()), "nontrading_ratio")
    return m.withColumn("median_turnover", F.round("median_turnover", 4)).withColumn("amihud_illiquidity", F.round("amihud_illiquidity", 12))


@query("f7_capped_fill", """WITH o AS (SELECT o_orderkey order_id, CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END side, CAST(floor(o_totalprice / 1000) AS BIGINT) + 1 quantity, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey % 9000 END vol, CASE WHEN o_orderkey % 17 <> 0 THEN 100.0 END bid, 101.0 ask, CASE WHEN o_orderkey % 19 = 0 THEN 'HALTED' ELSE 'TRADED' END st FROM orders),
    w AS (SELECT *, CASE side WHEN 'BUY' THEN ask ELSE bid END q, list_filter([CASE WHEN st <> 'TRADED' THEN 'TRADING_NOT_AVAILABLE' END, CASE WHEN vol IS NULL THEN 'SESSION_VOLUME_MISSING' END, CASE WHEN vol = 0 THEN 'ZERO_SESSION_VOLUME' END, CASE WHEN (CASE side WHEN 'BUY' THEN ask ELSE bid END) IS NULL THEN 'SIDE_QUOTE_MISSING' END], lambda x: x IS NOT NULL) why FROM o),
    f AS (SELECT *, CASE WHEN len(why) = 0 THEN least(quantity, CAST(floor(vol * 0.05) AS BIGINT)) ELSE 0 END filled FROM w), i AS (SELECT *, CASE WHEN filled > 0 THEN 0.005 * least(1.0, filled / vol / 0.05) END imp FROM f)
    SELECT order_id, CASE WHEN filled = 0 THEN 'NO_FILL' WHEN filled = quantity THEN 'FILLED' ELSE 'PARTIAL_FILL' END status, filled filled_quantity, round(q * (1 + imp * CASE side WHEN 'BUY' THEN 1 ELSE -1 END), 6) fill_price, round(coalesce(q * (1 + imp * CASE side WHEN 'BUY' THEN 1 ELSE -1 END) * filled / 1000, 0), 6) gross_notional, round(coalesce(q * (1 + imp * CASE side WHEN 'BUY' THEN 1 ELSE -1 END) * filled / 1000 * (0.001 + imp), 0), 6) estimated_cost,
    CASE WHEN len(why) > 0 THEN why WHEN filled = 0 THEN ['PARTICIPATION_CAP_ROUNDS_TO_ZERO'] WHEN filled < quantity THEN ['ORDER_EXCEEDS_PARTICIPATION_CAP'] ELSE [] END reasons FROM i""")
def _(v: Views):
    k = F.col("o_orderkey")
    o = v.table("orders").select(k.alias("order_id"), F.when(k % 2 == 0, "BUY").otherwise("SELL").alias("side"), (F.floor(F.col("o_totalprice") / 1000) + 1).alias("quantity"), F.when(k % 11 == 0, None).when(k % 13 == 0, 0).otherwise(k % 9000).alias("session_volume"), F.when(k % 17 != 0, 100.0).alias("bid"), F.lit(101.0).alias("ask"), F.when(k % 19 == 0, "HALTED").otherwise("TRADED").alias("trading_status"), F.lit(False).alias("upper_limit_queue"), F.lit(False).alias("lower_limit_queue"))
    return rounded(S.capped_fill(o), "fill_price", "gross_notional", "estimated_cost")


@query("f8_execution_checks", """SELECT event_id quote_id, CASE WHEN len(w) = 0 THEN 'EXECUTABLE' ELSE 'DETECTED_NOT_EXECUTABLE' END status, w reasons FROM (SELECT event_id, list_filter([CASE WHEN event_id % 7 = 0 THEN 'EXECUTION_TIMESTAMP_ORDER' END, CASE WHEN event_id % 7 = 0 THEN 'DELAY_DECLARATION_MISMATCH' END, CASE WHEN event_id % 5 = 0 THEN 'STALE_OR_FUTURE_EXECUTION_SNAPSHOT' END, CASE WHEN source_id = 'error' THEN 'NON_EXECUTABLE_MARKET_PHASE' END, CASE WHEN source_id = 'signup' THEN 'TRADING_STATUS_NOT_TRADED' END,
    CASE WHEN value < 10 THEN 'CROSSED_QUOTE' END, CASE WHEN (100 + value - 10) / 100 >= 1.10 - 1e-12 THEN 'UPPER_LIMIT_QUEUE_OR_CENSORING' END], lambda x: x IS NOT NULL) w FROM ev)""")
def _(v: Views):
    e, k, at = v.events(), F.col("event_id"), F.col("event_at")
    q = e.select(k.alias("quote_id"), at.alias("provider_as_of"), F.when(k % 7 == 0, at - F.expr("interval 3 minutes")).otherwise(at).alias("observed_at"), (at + F.when(k % 5 == 0, F.expr("interval 3 minutes")).otherwise(F.expr("interval 1 minutes"))).alias("decision_at"), F.lit(0.0).alias("delay_minutes"), F.when(F.col("source_id") == "error", "CLOSED").otherwise("CONTINUOUS").alias("market_phase"), F.when(F.col("source_id") == "signup", "HALTED").otherwise("TRADED").alias("trading_status"), F.lit(100.0).alias("bid"), (100 + F.col("value") - 10).alias("ask"), F.lit(100.0).alias("reference_price"))
    return S.execution_checks(q)


FEATURE_SQL = """WITH e30 AS (SELECT * FROM ev WHERE first_available_at <= TIMESTAMP '2024-01-25' AND first_available_at >= TIMESTAMP '2024-01-25' - INTERVAL 30 DAY), e7 AS (SELECT * FROM e30 WHERE first_available_at >= TIMESTAMP '2024-01-25' - INTERVAL 7 DAY),
    c30 AS (SELECT security_code, arg_min(direction, (first_available_at, event_id)) d, arg_min(novelty, (first_available_at, event_id)) n, list(source_id) s, list_distinct(list(source_role)) r, bool_or(source_role = 'PRIMARY_OFFICIAL') o FROM e30 LEFT JOIN (SELECT DISTINCT original_event_id pid FROM e30 WHERE original_event_id IS NOT NULL) ON pid = event_id GROUP BY security_code, coalesce(CAST(original_event_id AS VARCHAR), CASE WHEN pid IS NOT NULL THEN CAST(event_id AS VARCHAR) END, content_hash)),
    c7 AS (SELECT security_code, arg_min(direction, (first_available_at, event_id)) d, arg_min(novelty, (first_available_at, event_id)) n, count(*) k, list_distinct(list(source_role)) r FROM e7 LEFT JOIN (SELECT DISTINCT original_event_id pid FROM e7 WHERE original_event_id IS NOT NULL) ON pid = event_id GROUP BY security_code, coalesce(CAST(original_event_id AS VARCHAR), CASE WHEN pid IS NOT NULL THEN CAST(event_id AS VARCHAR) END, content_hash)),
    m AS (SELECT security_code, sum(CASE WHEN o THEN n * CASE d WHEN 'POSITIVE' THEN 1 WHEN 'NEGATIVE' THEN -1 ELSE 0 END ELSE 0 END) f1, CAST(count(*) FILTER (o) AS DOUBLE) f2, sum(CASE WHEN NOT o AND list_has_any(r, ['NEWS_CONTEXT', 'FINANCIAL_CONTEXT']) THEN n * CASE d WHEN 'POSITIVE' THEN 1 WHEN 'NEGATIVE' THEN -1 ELSE 0 END ELSE 0 END) f3, CAST(len(list_distinct(flatten(list(s)))) AS DOUBLE) f6 FROM c30 GROUP BY 1),
    w AS (SELECT security_code, sum(n * CASE d WHEN 'POSITIVE' THEN 1 WHEN 'NEGATIVE' THEN -1 ELSE 0 END) f4, CAST(sum(k) AS DOUBLE) f5 FROM c7 WHERE list_contains(r, 'SOCIAL') GROUP BY 1),
    x AS (SELECT u.security_code, unnest([struct_pack(feature_name := 'official_event_net_30d', v := f1), struct_pack(feature_name := 'official_event_count_30d', v := f2), struct_pack(feature_name := 'context_event_net_30d', v := f3), struct_pack(feature_name := 'social_event_net_7d', v := CASE WHEN f1 IS NOT NULL THEN coalesce(f4, 0) END), struct_pack(feature_name := 'social_diffusion_7d', v := CASE WHEN f1 IS NOT NULL THEN coalesce(f5, 0) END), struct_pack(feature_name := 'source_diversity_30d', v := f6), struct_pack(feature_name := 'event_window_observed_30d', v := CASE WHEN f1 IS NOT NULL THEN 1.0 END)]) f FROM (SELECT DISTINCT security_code FROM ev) u LEFT JOIN m USING (security_code) LEFT JOIN w USING (security_code))
    SELECT security_code, f.feature_name feature_name, round(f.v, 6) feature_value, CASE WHEN f.v IS NULL THEN 'UNKNOWN_NOT_OBSERVED' ELSE 'OBSERVED' END source_availability_state FROM x"""


@query("f9_event_features", FEATURE_SQL)
def _(v: Views):
    return rounded(S.event_features(v.events(), F.lit("2024-01-25").cast("timestamp_ntz")), "feature_value")


@query("f10_feature_violations", """WITH f AS (SELECT event_id, event_id decision_id, security_code, source_id feature_name FROM ev) SELECT decision_id, security_code, feature_name, 'LOOK_AHEAD' code FROM f WHERE event_id % 6 = 0 UNION ALL SELECT decision_id, security_code, feature_name, 'OBSERVED_WITHOUT_VALUE' FROM f WHERE event_id % 4 = 0 UNION ALL SELECT decision_id, security_code, feature_name, 'LATE_PROSPECTIVE_FETCH' FROM f WHERE event_id % 9 = 0""")
def _(v: Views):
    e, k = v.events(), F.col("event_id")
    f = e.select(k.alias("decision_id"), "security_code", F.col("source_id").alias("feature_name"), F.when(k % 6 == 0, F.col("captured_at")).otherwise(F.col("published_at")).alias("available_at"), F.col("event_at").alias("decision_at"), F.lit("PROSPECTIVE").alias("capture_mode"), F.when(k % 9 == 0, F.col("captured_at")).otherwise(F.col("event_at")).alias("fetched_at"), F.lit("OBSERVED").alias("source_availability_state"), F.when(k % 4 != 0, F.col("value")).alias("feature_value"))
    return S.feature_violations(f)


@query("f11_price_findings", """SELECT security_code, trade_date, CASE WHEN c > 0.05 THEN 'POSITIVE' WHEN c < -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END direction, round(least(1.0, abs(c) / 5), 6) strength, round(least(1.0, abs(c) / 3), 6) materiality, substring(sha256(concat_ws('|', security_code, CAST(trade_date AS VARCHAR), 'PRICE_ACTIVITY')), 1, 24) finding_id
    FROM (SELECT security_code, max(trade_date) trade_date, arg_max(c, trade_date) c FROM (SELECT *, 100 * ("close" / lag("close") OVER (PARTITION BY security_code ORDER BY trade_date) - 1) c FROM bars) GROUP BY 1) WHERE c IS NOT NULL""")
def _(v: Views):
    return rounded(S.price_findings(v.bars()), "strength", "materiality")


@query("f12_classify_profiles", """WITH p AS (SELECT CAST(c_custkey AS VARCHAR) security_code, c_custkey % 100 / 100 vp, ['HIGH', 'MEDIUM', 'LOW', 'THIN'][c_custkey % 4 + 1] lb, c_custkey % 10 / 10 q FROM customer), l AS (SELECT security_code, list_filter([CASE WHEN vp >= 0.75 OR lb = 'THIN' THEN 'SPECULATIVE_PROFILE' END, CASE WHEN q >= 0.6 AND lb IN ('HIGH', 'MEDIUM') THEN 'INVESTMENT_PROFILE' END], lambda x: x IS NOT NULL) x FROM p)
    SELECT security_code, CASE WHEN len(x) > 0 THEN x ELSE ['UNCLASSIFIED_PROFILE'] END profiles FROM l""")
def _(v: Views):
    k = F.col("c_custkey")
    f = v.table("customer").select(k.cast("string").alias("security_code"), (k % 100 / 100).alias("volatility_percentile"), F.element_at(F.array(*map(F.lit, ("HIGH", "MEDIUM", "LOW", "THIN"))), (k % 4 + 1).cast("int")).alias("liquidity_bucket"), F.lit(False).alias("discontinuity_flag"), (k % 10 / 10).alias("quality_score"), F.lit(0.2).alias("balance_sheet_risk"), F.lit(0.9).alias("cash_flow_quality"))
    return S.classify_profiles(f)


@query("f13_decision_status", """WITH w AS (SELECT c_custkey k, list_filter([CASE WHEN c_custkey % 5 = 0 THEN 'IDENTITY_GATE_FAILED' END, CASE WHEN c_custkey % 7 = 0 THEN 'TIMING_GATE_FAILED' END, CASE WHEN c_custkey % 3 = 0 THEN 'MODEL_NOT_PROSPECTIVELY_VALIDATED' END, CASE WHEN c_acctbal < 0 THEN 'EDGE_OR_COST_MISSING' END, CASE WHEN c_acctbal >= 0 AND c_acctbal / 10000 <= 0.3 + 0.1 THEN 'EDGE_NOT_ABOVE_COST_AND_MARGIN' END], lambda x: x IS NOT NULL) r FROM customer)
    SELECT CAST(k AS VARCHAR) security_code, CASE WHEN len(r) = 0 AND k % 2 = 0 THEN 'HIGH_BUY_OPPORTUNITY' WHEN len(r) = 0 THEN 'QUALIFIED_RESEARCH_NOT_YET_EXECUTABLE' WHEN k % 5 = 0 OR k % 7 = 0 OR k % 3 = 0 THEN 'WATCH' ELSE 'ABSTAIN' END status, r reasons FROM w""")
def _(v: Views):
    k, a = F.col("c_custkey"), F.col("c_acctbal")
    d = v.table("customer").select(k.cast("string").alias("security_code"), (k % 5 != 0).alias("identity"), (k % 7 != 0).alias("timing"), (k % 3 != 0).alias("model_validated"), F.lit(None).cast("double").alias("probability"), F.lit(False).alias("probability_allowed"), F.when(a >= 0, a / 10000).alias("edge"), F.lit(0.3).alias("cost"), F.lit(False).alias("execution_required"), (k % 2 == 0).alias("executable"))
    return S.decision_status(d, ["identity", "timing"], 0.1)
