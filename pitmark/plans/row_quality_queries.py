"""Row-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitmark.functions.columns import host, isin_is_valid, registrable_domain
from pitmark.operators import row_quality as Q
from pitmark.plans.registry import query
from pitmark.plans.views import Views

KEY = ["security_code", "trade_date"]


@query("q1_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(v: Views):
    return Q.duplicate_keys(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


def _spoiled(v: Views):
    day = F.dayofmonth("trade_date")
    b = v.bars()
    return b.withColumn("high", F.when(day == 3, F.col("low") - 1).otherwise(F.col("high"))).withColumn("low", F.when(day == 5, F.lit(-1.0)).otherwise(F.col("low")))


@query("q2_ohlc_violations", """WITH b AS (SELECT security_code, trade_date, "open", "close", CASE WHEN day(trade_date) = 3 THEN low - 1 ELSE high END high, CASE WHEN day(trade_date) = 5 THEN -1.0 ELSE low END low FROM bars)
    SELECT security_code, trade_date, 'HIGH_BELOW_PRICES' code FROM b WHERE high < greatest("open", "close", low) UNION ALL SELECT security_code, trade_date, 'LOW_ABOVE_PRICES' FROM b WHERE low > least("open", "close", high)
    UNION ALL SELECT security_code, trade_date, 'NON_POSITIVE_PRICE' FROM b WHERE least("open", high, low, "close") <= 0""")
def _(v: Views):
    return Q.ohlc_violations(_spoiled(v), KEY)


@query("q3_state_activity_violations", """WITH b AS (SELECT *, CASE WHEN day(trade_date) % 9 = 0 THEN 'SUSPENDED' ELSE 'TRADED' END s FROM gapped)
    SELECT security_code, trade_date, 'TRADED_WITHOUT_ACTIVITY' code FROM b WHERE s = 'TRADED' AND (coalesce(volume, 0) = 0 OR turnover = 0 OR trade_count = 0)
    UNION ALL SELECT security_code, trade_date, 'NON_TRADED_WITH_PRICES' FROM b WHERE s <> 'TRADED' UNION ALL SELECT security_code, trade_date, 'NON_TRADED_WITH_ACTIVITY' FROM b WHERE s <> 'TRADED'""")
def _(v: Views):
    return Q.state_activity_violations(v.gapped().withColumn("trading_state", F.when(F.dayofmonth("trade_date") % 9 == 0, "SUSPENDED").otherwise("TRADED")), KEY)


@query("q4_vocabulary_violations", """SELECT o_orderkey, 'O_ORDERSTATUS_NOT_IN_ENUM' code FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL
    SELECT o_orderkey, 'O_ORDERPRIORITY_PATTERN' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')""")
def _(v: Views):
    return Q.vocabulary_violations(v.table("orders"), ["o_orderkey"], {"o_orderstatus": ["F", "O"]}, {"o_orderpriority": "^[1-5]-[A-Z]+$"})


@query("q5_isin_check_digit", """WITH i AS (SELECT c_custkey, 'KW' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || (c_custkey % 10) isin FROM customer),
    d AS (SELECT c_custkey, isin, string_split(reverse('2032' || substring(isin, 3)), '') x FROM i)
    SELECT c_custkey, isin, list_sum([CASE WHEN k % 2 = 0 THEN CASE WHEN CAST(x[k] AS INT) * 2 > 9 THEN CAST(x[k] AS INT) * 2 - 9 ELSE CAST(x[k] AS INT) * 2 END ELSE CAST(x[k] AS INT) END FOR k IN range(1, len(x) + 1)]) % 10 = 0 valid FROM d""")
def _(v: Views):
    isin = F.concat(F.lit("KW"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), (F.col("c_custkey") % 10).cast("string"))
    return v.table("customer").select("c_custkey", isin.alias("isin")).withColumn("valid", isin_is_valid(F.col("isin")))


@query("q6_timestamp_order_violations", """SELECT event_id, 'PUBLISHED_AFTER_AVAILABLE' code FROM ev WHERE CASE WHEN event_id % 50 = 0 THEN published_at + INTERVAL 1 HOUR ELSE published_at END > first_available_at
    UNION ALL SELECT event_id, 'PROSPECTIVE_CAPTURED_AFTER_DECISION' FROM ev WHERE event_id % 2 = 0 AND captured_at > TIMESTAMP '2024-01-29'""")
def _(v: Views):
    e = v.events().withColumn("published_at", F.when(F.col("event_id") % 50 == 0, F.col("published_at") + F.expr("interval 1 hour")).otherwise(F.col("published_at")))
    e = e.withColumn("capture_mode", F.when(F.col("event_id") % 2 == 0, "PROSPECTIVE").otherwise("HISTORICAL")).withColumn("decision_at", F.lit("2024-01-29").cast("timestamp_ntz"))
    return Q.timestamp_order_violations(e, ["event_id"])


@query("q7_change_pct_mismatch", """SELECT security_code, trade_date, round(measured, 4) measured FROM (SELECT security_code, trade_date, 100 * ("close" / lag("close") OVER w - 1) measured, 100 * ("close" / lag("close") OVER w - 1) + CASE WHEN day(trade_date) = 11 THEN 0.1 ELSE 0 END d FROM bars WINDOW w AS (PARTITION BY security_code ORDER BY trade_date)) WHERE abs(measured - d) > 0.06""")
def _(v: Views):
    from pyspark.sql.window import Window

    w = Window.partitionBy("security_code").orderBy("trade_date")
    b = v.bars().withColumn("declared", 100 * (F.col("close") / F.lag("close").over(w) - 1) + F.when(F.dayofmonth("trade_date") == 11, 0.1).otherwise(0.0))
    return Q.change_pct_mismatch(b, "declared").select(*KEY, F.round("measured", 4).alias("measured"))


@query("q8_unresolved_hashes", "SELECT sha256(text) sha256, doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 4 <> 0)")
def _(v: Views):
    d = v.table("documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return Q.unresolved_hashes(d, ["doc_id"], "h", d.where("doc_id % 4 <> 0").select(F.col("h").alias("sha256")))


@query("q9_source_bound_evidence", """WITH m AS (SELECT DISTINCT source source_id, sha256(text) sha256 FROM documents), h AS (SELECT doc_id attest_id, sha256(text) sha256 FROM documents), s AS (SELECT doc_id attest_id, unnest(['src' || (doc_id % 20), 'src1']) source_id FROM documents),
    b AS (SELECT h.attest_id, h.sha256, s.source_id FROM h JOIN m USING (sha256) JOIN s ON s.attest_id = h.attest_id AND s.source_id = m.source_id)
    SELECT DISTINCT attest_id, sha256 what, 'HASH_NOT_OF_DECLARED_SOURCE' code FROM h WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.attest_id = h.attest_id AND b.sha256 = h.sha256) UNION ALL
    SELECT DISTINCT attest_id, source_id, 'SOURCE_WITHOUT_HASH' FROM s WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.attest_id = s.attest_id AND b.source_id = s.source_id)""")
def _(v: Views):
    d = v.table("documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    attest = d.select(F.col("doc_id").alias("attest_id"), F.array("h").alias("sha256s"), F.array(F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string")), F.lit("src1")).alias("source_ids"))
    return Q.source_bound_evidence(attest, d.select(F.col("source").alias("source_id"), F.col("h").alias("sha256")))


@query("q10_look_ahead_rows", "SELECT event_id, captured_at FROM ev WHERE greatest(first_available_at, captured_at) > TIMESTAMP '2024-01-25'")
def _(v: Views):
    return Q.look_ahead_rows(v.events(), F.lit("2024-01-25").cast("timestamp_ntz"), ["first_available_at", "captured_at"]).select("event_id", "captured_at")


@query("q11_denominator_gap", """WITH e AS (SELECT trade_date, security_code FROM (SELECT trade_date FROM calendar WHERE is_trading_day), (SELECT DISTINCT security_code FROM bars)), a AS (SELECT DISTINCT trade_date, security_code FROM bars)
    SELECT *, 'MISSING' gap FROM (SELECT * FROM e EXCEPT SELECT * FROM a) UNION ALL SELECT *, 'EXTRA' FROM (SELECT * FROM a EXCEPT SELECT * FROM e)""")
def _(v: Views):
    # the denominator is a grid, every security on every session
    return Q.grid_gaps(v.bars(), v.calendar().where("is_trading_day"), "security_code", "trade_date").select("trade_date", "security_code", "gap")


@query("q12_quarantine_split", """SELECT security_code, trade_date, ['LOW_ABOVE_PRICES'] codes, false clean FROM bars WHERE 1 = 0 UNION ALL SELECT security_code, trade_date, NULL, true FROM bars WHERE day(trade_date) NOT IN (3, 5)
    UNION ALL SELECT security_code, trade_date, CASE WHEN day(trade_date) = 5 THEN ['NON_POSITIVE_PRICE'] WHEN low - 1 <= 0 THEN ['HIGH_BELOW_PRICES', 'LOW_ABOVE_PRICES', 'NON_POSITIVE_PRICE'] ELSE ['HIGH_BELOW_PRICES', 'LOW_ABOVE_PRICES'] END, false FROM bars WHERE day(trade_date) IN (3, 5)""")
def _(v: Views):
    rows = _spoiled(v)
    clean, held = Q.quarantine_split(rows, Q.ohlc_violations(rows, KEY), KEY)
    return clean.select(*KEY, F.lit(None).cast("array<string>").alias("codes"), F.lit(True).alias("clean")).unionByName(held.select(*KEY, "codes", F.lit(False).alias("clean")))


@query("q13_series_coverage", """SELECT benchmark_code, count(*) n_rows, min(trade_date) first_date, max(trade_date) last_date, (SELECT count(*) FROM calendar WHERE is_trading_day) - count(*) FILTER (c.is_trading_day) missing_dates, count(*) FILTER (NOT coalesce(c.is_trading_day, false)) extra_dates
    FROM benchmark_series b LEFT JOIN calendar c USING (trade_date) GROUP BY 1""")
def _(v: Views):
    return Q.series_coverage(v.benchmark_series(), v.calendar(), "benchmark_code")


@query("q13_series_gaps", """WITH s AS (SELECT DISTINCT security_code, trade_date FROM bars), c AS (SELECT trade_date FROM calendar WHERE is_trading_day) SELECT k security_code, c.trade_date, 'MISSING' gap FROM (SELECT DISTINCT security_code k FROM s) CROSS JOIN c WHERE (k, c.trade_date) NOT IN (SELECT (security_code, trade_date) FROM s) UNION ALL SELECT security_code, trade_date, 'EXTRA' FROM s WHERE trade_date NOT IN (SELECT trade_date FROM c)""")
def _(v: Views):
    return Q.series_gaps(v.bars(), v.calendar(), "security_code")


@query("q14_query_ledger_violations", """WITH q AS (SELECT o_orderkey query_id, o_orderkey % 7 a, o_orderkey % 7 - CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END b, o_orderkey % 5 n, o_orderkey % 5 = 0 OR o_orderkey % 31 = 0 z, CAST(o_orderdate AS DATE) f FROM orders)
    SELECT query_id, 'PAGES_DECLARED_NOT_RECEIVED' code FROM q WHERE a <> b UNION ALL SELECT query_id, 'ZERO_RESULT_WITH_ROWS' FROM q WHERE z AND n <> 0 UNION ALL SELECT query_id, 'ZERO_ROWS_WITHOUT_ZERO_RESULT' FROM q WHERE NOT z AND n = 0
    UNION ALL SELECT query_id, 'WINDOW_OUTSIDE_COLLECTION' FROM q WHERE f < DATE '1996-01-01' OR f + 30 > DATE '2001-01-01'""")
def _(v: Views):
    k = F.col("o_orderkey")
    q = v.table("orders").select(k.alias("query_id"), (k % 7).alias("pages_declared"), (k % 7 - F.when(k % 29 == 0, 1).otherwise(0)).alias("pages_received"), (k % 5).alias("result_count_declared"), (k % 5).alias("rows_normalized"), ((k % 5 == 0) | (k % 31 == 0)).alias("zero_result"), F.to_date("o_orderdate").alias("window_from"), F.date_add(F.to_date("o_orderdate"), 30).alias("window_to"), F.lit("1996-01-01").cast("date").alias("collection_from"), F.lit("2001-01-01").cast("date").alias("collection_to"))
    return Q.query_ledger_violations(q)


@query("q15_declared_vs_actual_counts", """WITH d AS (SELECT CAST(o_orderkey % 50 AS INT) part, sum(1) declared FROM orders WHERE o_orderkey % 500 <> 3 GROUP BY 1), a AS (SELECT CAST(o_orderkey % 50 AS INT) part, count(*) actual FROM orders WHERE o_orderkey % 50 < 48 GROUP BY 1)
    SELECT part, CAST(coalesce(declared, 0) AS BIGINT) declared, coalesce(actual, 0) actual, CASE WHEN coalesce(declared, 0) <> coalesce(actual, 0) THEN 'COUNT_MISMATCH' ELSE 'OK' END code FROM d FULL JOIN a USING (part)""")
def _(v: Views):
    o = v.table("orders").select((F.col("o_orderkey") % 50).cast("int").alias("part"), "o_orderkey", F.lit(1).alias("rows_normalized"), F.lit(False).alias("zero_result"))
    return Q.declared_vs_actual_counts(o.where("o_orderkey % 500 <> 3"), o.where("part < 48"), ["part"])


@query("q16_price_coverage", """SELECT security_code, count(*) n_rows, min(trade_date) first_date, max(trade_date) last_date, count(*) FILTER (volume = 0) zero_volume_rows, list_sort(list_distinct(list(u))) units, ['RAW'] bases, count(DISTINCT u) > 1 mixed_units, false mixed_bases
    FROM (SELECT *, CASE WHEN CAST(security_code AS INT) % 10 = 0 AND month(trade_date) = 1 THEN 'KWD' ELSE 'fils' END u FROM gapped) GROUP BY 1""")
def _(v: Views):
    return Q.price_coverage(v.gapped().withColumn("unit", F.when((F.col("security_code").cast("int") % 10 == 0) & (F.month("trade_date") == 1), "KWD").otherwise("fils")).withColumn("price_basis", F.lit("RAW")))


@query("q17_rollup_status", """SELECT o_orderstatus || substring(o_orderpriority, 1, 1) dataset, coalesce(list_sort(list_distinct(list(c) FILTER (c IS NOT NULL))), []) codes, CASE WHEN bool_or(coalesce(c = 'BIG', false)) THEN 'BLOCKED' WHEN count(c) > 0 THEN 'PARTIAL' ELSE 'PASS' END status
    FROM (SELECT *, CASE WHEN o_totalprice > 499500 THEN 'BIG' WHEN o_totalprice < 1060 THEN 'SMALL' END c FROM orders) GROUP BY 1""")
def _(v: Views):
    o = v.table("orders").withColumn("dataset", F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1))).withColumn("code", F.when(F.col("o_totalprice") > 499500, "BIG").when(F.col("o_totalprice") < 1060, "SMALL"))
    return Q.rollup_status(o.where("code is not null"), o, ["BIG"])


@query("q18_fold_evidence_class", """WITH c AS (SELECT security_code, CASE WHEN (source_id = 'error' AND s > 0) OR (source_id = 'click' AND s > 1) OR (source_id = 'view' AND s > 2) THEN 'signup' ELSE source_id END cls FROM (SELECT *, CAST(security_code AS INT) % 4 s FROM ev))
    SELECT security_code, CASE WHEN bool_or(cls = 'error') THEN 'error' WHEN bool_or(cls = 'click') THEN 'click' WHEN bool_or(cls = 'view') THEN 'view' WHEN bool_or(cls = 'purchase') THEN 'purchase' ELSE 'signup' END evidence_class FROM c GROUP BY 1""")
def _(v: Views):
    s, c = F.col("security_code").cast("int") % 4, F.col("source_id")
    mild = ((c == "error") & (s > 0)) | ((c == "click") & (s > 1)) | ((c == "view") & (s > 2))
    return Q.fold_evidence_class(v.events().withColumn("evidence_class", F.when(mild, "signup").otherwise(c)), ["security_code"], ["error", "click", "view", "purchase", "signup"])


@query("q19_parse_vendor_numbers", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE round(CAST(o_orderkey AS DOUBLE) / 100 * CASE o_orderkey % 4 WHEN 0 THEN 1000.0 WHEN 1 THEN 1000000.0 ELSE 1.0 END, 4) END volume_value,
    CAST(o_orderkey % 9 AS DOUBLE) - 4 percent_value, CAST(o_orderdate AS DATE) date_value FROM orders""")
def _(v: Views):
    k = F.col("o_orderkey")
    raw = v.table("orders").select(
        k, F.when(k % 4 == 3, "n/a").otherwise(F.concat((k / 100).cast("decimal(18,2)").cast("string"), F.when(k % 4 == 0, "K").when(k % 4 == 1, "M").otherwise(""))).alias("v"),
        F.concat(F.when(k % 9 >= 4, "+").otherwise(""), (k % 9 - 4).cast("string"), F.lit("%")).alias("p"), F.when(k % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"))
    return Q.parse_vendor_numbers(raw, "v", "p", "d").select("o_orderkey", "volume_value", "percent_value", "date_value")


@query("q20_forbidden_feature_names", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'future_' || p_type WHEN 1 THEN 't_plus_1' ELSE p_name END feature_name FROM part WHERE p_partkey % 5 < 2")
def _(v: Views):
    p = v.table("part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("future_"), "p_type")).when(F.col("p_partkey") % 5 == 1, "t_plus_1").otherwise(F.col("p_name")).alias("feature_name"))
    return Q.forbidden_feature_names(p, "feature_name")


@query("q21_unsafe_urls", """WITH u AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url || '#top' WHEN 1 THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'token=x' ELSE url END url FROM pages) SELECT page_id, 'NOT_HTTPS' code FROM u WHERE url NOT LIKE 'https://%' UNION ALL SELECT page_id, 'FRAGMENT' FROM u WHERE url LIKE '%#%'
    UNION ALL SELECT page_id, 'CREDENTIAL_QUERY_KEY' FROM u WHERE regexp_matches(url, '[?&](token|api_?key|password|secret|auth|signature|access_token)=') UNION ALL SELECT page_id, 'PORT' FROM u WHERE regexp_matches(url, '^[a-z]+://[^/?#]*:[0-9]+') UNION ALL SELECT page_id, 'USERINFO' FROM u WHERE regexp_matches(url, '^[a-z]+://[^/?#]*@')""")
def _(v: Views):
    u = F.when(F.col("page_id") % 6 == 0, F.concat("url", F.lit("#top"))).when(F.col("page_id") % 6 == 1, F.concat("url", F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("token=x"))).otherwise(F.col("url"))
    return Q.unsafe_urls(v.table("pages").select("page_id", u.alias("url")), "url", ["page_id"])


@query("q22_registrable_domain", """WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) h FROM pages), l AS (SELECT page_id, h, string_split(h, '.') x FROM h) SELECT page_id, h host, array_to_string(x[greatest(len(x) - 1, 1):], '.') registrable_domain FROM l""")
def _(v: Views):
    return v.table("pages").select("page_id", host(F.col("url")).alias("host")).withColumn("registrable_domain", registrable_domain(F.col("host")))


@query("q23_host_allowed", """SELECT page_id, regexp_matches(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '(^|\\.)example\\.(com|org)$') allowed FROM pages""")
def _(v: Views):
    sources = v.spark.createDataFrame([("example.com",), ("example.org",)], "domain string")
    return Q.host_allowed(v.table("pages"), "url", sources).select("page_id", "allowed")


@query("q24_phrase_evidence", """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 2 = 0 THEN substring(text, 3, 25) ELSE 'zzz not there' END phrase, doc_id % 5 <> 0 AND doc_id % 2 = 0 AND trim(regexp_replace(lower(substring(text, 3, 25)), '\\s+', ' ', 'g')) <> '' AND contains(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), trim(regexp_replace(lower(substring(text, 3, 25)), '\\s+', ' ', 'g'))) found FROM documents""")
def _(v: Views):
    d = v.table("documents")
    phrase = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 2 == 0, F.substring("text", 3, 25)).otherwise("zzz not there")
    return Q.phrase_evidence(d.select("doc_id", "text"), d.select("doc_id", phrase.alias("phrase")), "doc_id")


@query("q25_derive_evidence_class", """SELECT event_id, CASE WHEN source_id = 'signup' THEN 'UNREGISTERED' WHEN source_id = 'error' THEN 'RETIRED_SOURCE' WHEN event_id % 3 <> 0 THEN 'RIGHTS_PENDING' WHEN event_id % 2 = 0 THEN 'PROVEN' ELSE 'RECONSTRUCTED' END evidence_class,
    CASE WHEN NOT (source_id NOT IN ('signup', 'error') AND event_id % 3 = 0 AND event_id % 2 = 0) THEN 'SELF_DECLARED_PROVEN_LOWERED' END code FROM ev""")
def _(v: Views):
    e = v.events().select("event_id", "source_id", F.when(F.col("event_id") % 2 == 0, "PROSPECTIVE").otherwise("HISTORICAL").alias("capture_mode"), F.when(F.col("event_id") % 3 == 0, "GRANTED").otherwise("PENDING").alias("rights_status"), F.lit("PROVEN").alias("declared_class"))
    registry = v.spark.createDataFrame([("purchase", "ACTIVE"), ("view", "ACTIVE"), ("click", "ACTIVE"), ("error", "RETIRED")], "source_id string, state string")
    return Q.derive_evidence_class(e, registry).select("event_id", "evidence_class", "code")


@query("q26_attestation_coverage", """SELECT event_id attest_id, list_filter([CASE WHEN event_id % 4 = 0 THEN 'INCOMPLETE_COVERAGE' END, CASE WHEN event_id % 9 = 0 THEN 'VERSION_MISMATCH' END, CASE WHEN source_role = 'SOCIAL' THEN 'CAPABILITY_NOT_ALLOWED_FOR_ROLE' END], lambda x: x IS NOT NULL) codes,
    CASE WHEN event_id % 4 = 0 OR event_id % 9 = 0 OR source_role = 'SOCIAL' THEN 'FAIL' ELSE 'PASS' END status FROM ev""")
def _(v: Views):
    k = F.col("event_id")
    a = v.events().select(k.alias("attest_id"), F.col("source_role").alias("role"), F.lit("EOD").alias("capability"), F.lit(10).alias("denominator"), F.when(k % 4 == 0, 9).otherwise(10).alias("numerator"), F.when(k % 9 == 0, "v1").otherwise("v2").alias("version"), F.lit("v2").alias("registry_version"), F.col("first_available_at").alias("observed_at"), F.col("captured_at").alias("attested_at"))
    allowed = v.spark.createDataFrame([(r, "EOD") for r in ("PRIMARY_OFFICIAL", "NEWS_CONTEXT", "FINANCIAL_CONTEXT")], "role string, capability string")
    return Q.attestation_coverage(a, allowed)
