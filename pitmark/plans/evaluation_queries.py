"""Evaluation and ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import wilson
from pitmark.operators import evaluation as V
from pitmark.operators import ledger as L
from pitmark.plans.event_queries import rounded
from pitmark.plans.registry import query
from pitmark.plans.views import SQL, Views

SQL["decided"] = """SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY score DESC, security_code) <= 5 selected, outcome > 0 positive FROM outcomes"""


def decided(v: Views):
    rank = F.row_number().over(Window.partitionBy("decision_id").orderBy(F.desc("score"), "security_code"))
    return v.outcomes().withColumn("selected", rank <= 5).withColumn("positive", F.col("outcome") > 0)


@query("v1_join_outcomes", """WITH p AS (SELECT * FROM outcomes WHERE CAST(security_code AS INT) % 10 <> 0), o AS (SELECT * FROM outcomes WHERE CAST(security_code AS INT) % 11 <> 0), l AS (SELECT decision_id, security_code, CASE WHEN CAST(security_code AS INT) % 13 = 0 THEN score + 1 ELSE score END score FROM outcomes WHERE CAST(security_code AS INT) % 17 <> 0)
    SELECT decision_id, security_code, list_filter([CASE WHEN CAST(security_code AS INT) % 10 = 0 THEN 'NO_PREDICTION' END, CASE WHEN CAST(security_code AS INT) % 11 = 0 THEN 'NO_OUTCOME' END, CASE WHEN CAST(security_code AS INT) % 17 = 0 THEN 'NOT_RECORDED' END, CASE WHEN p.score <> l.score THEN 'SCORE_DIFFERS' END], lambda x: x IS NOT NULL) codes FROM p FULL JOIN o USING (decision_id, security_code) FULL JOIN l USING (decision_id, security_code)""")
def _(v: Views):
    o, k = v.outcomes(), F.col("security_code").cast("int")
    return V.join_outcomes(o.where(k % 10 != 0), o.where(k % 11 != 0), o.where(k % 17 != 0).withColumn("score", F.when(k % 13 == 0, F.col("score") + 1).otherwise(F.col("score"))), ["decision_id", "security_code"], ["score"])


SQL["ics"] = """SELECT decision_id, count(*) n, CASE WHEN stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN corr(a, b) END rank_ic FROM (SELECT decision_id, rank() OVER (PARTITION BY decision_id ORDER BY score) + (count(*) OVER (PARTITION BY decision_id, score) - 1) / 2 a, rank() OVER (PARTITION BY decision_id ORDER BY outcome) + (count(*) OVER (PARTITION BY decision_id, outcome) - 1) / 2 b FROM outcomes) GROUP BY 1"""


@query("v2_rank_ic", "SELECT decision_id, n, round(rank_ic, 6) rank_ic FROM ics")
def _(v: Views):
    return rounded(V.rank_ic(v.outcomes()), "rank_ic")


SQL["pr"] = """SELECT decision_id, count(*) FILTER (selected) n_selected, count(*) FILTER (selected AND positive) hits, count(*) FILTER (selected AND best) found, count(*) FILTER (best) n_best FROM (SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY outcome DESC, security_code) <= 5 best FROM decided) GROUP BY 1"""


@query("v3_precision_recall_at_k", "SELECT decision_id, n_selected, hits, round(hits / n_selected, 6) \"precision\", round(found / n_best, 6) recall FROM pr WHERE n_selected > 0")
def _(v: Views):
    return rounded(V.precision_recall_at_k(decided(v), 5), "precision", "recall")


@query("v4_brier", "SELECT decision_id, count(*) n, round(avg((probability - \"label\") ** 2), 6) brier FROM predictions GROUP BY 1")
def _(v: Views):
    return rounded(V.brier(v.predictions(), ["decision_id"]), "brier")


@query("v5_event_labels", """SELECT decision_id, security_code, CASE CAST(security_code AS INT) % 4 WHEN 0 THEN outcome - 0.01 > 0 WHEN 1 THEN outcome >= 0.05 WHEN 2 THEN outcome >= 0.10 ELSE outcome > 0 AND outcome - 0.01 > 0 END::INT "label" FROM outcomes""")
def _(v: Views):
    k = (F.col("security_code").cast("int") % 4 + 1).cast("int")
    o = v.outcomes().withColumn("target_rule", F.element_at(F.array(*map(F.lit, ("NET_EXCESS_GT_0", "GROSS_GE_5", "GROSS_GE_10", "TOTAL_AND_EXCESS"))), k)).withColumn("gross", F.col("outcome")).withColumn("net_excess", F.col("outcome") - 0.01)
    return V.event_labels(o).select("decision_id", "security_code", "label")


@query("v6_forecast_metrics", """SELECT count(*) n, count(DISTINCT decision_id) dates, round(avg((CAST(security_code AS INT) % 9 <> 0)::INT), 6) coverage, round(avg((CAST(security_code AS INT) % 9 = 0)::INT), 6) abstention, round(avg((CAST(security_code AS INT) % 7 = 0)::INT) FILTER (selected), 6) non_fill_rate, round(avg(outcome - 0.01) FILTER (selected), 6) mean_net_excess, CASE WHEN count(DISTINCT decision_id) < 60 THEN 'STOP_INFERENCE' ELSE 'MEASURED' END status FROM decided""")
def _(v: Views):
    k = F.col("security_code").cast("int")
    d = decided(v).withColumn("abstained", k % 9 == 0).withColumn("fill_status", F.when(k % 7 == 0, "NOT_FILLED").otherwise("FILLED")).withColumn("net_excess", F.col("outcome") - 0.01)
    return rounded(V.forecast_metrics(d, 60), "coverage", "abstention", "non_fill_rate", "mean_net_excess")


@query("v7_replay_returns", """WITH r AS (SELECT *, exit_price * factor / entry_price - 1 + distribution g, CASE WHEN selected THEN exit_price / entry_price - 1 - 0.003 ELSE exit_price * factor / entry_price - 1 + distribution END n FROM trades) SELECT l_orderkey, l_linenumber, round(g, 6) gross, round(n, 6) net, g > 0 gross_up, n > 0 net_up, g > 0.0123456 beats_market FROM r""")
def _(v: Views):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    exit_ = unit * (1 + F.col("l_discount") - 0.04)
    r = v.table("lineitem").select("l_orderkey", "l_linenumber", unit.alias("entry_price"), exit_.alias("exit_price"), (1 + F.col("l_tax") / 10).alias("factor"), F.col("l_tax").alias("distribution"), (F.col("l_returnflag") == "A").alias("selected"), unit.alias("executed_entry"), exit_.alias("executed_exit"), *[F.lit(0.001).alias(c) for c in ("fees", "spread", "slippage")], F.lit(0.0123456).alias("benchmark_return"), F.lit(0.0).alias("sector_return"))
    return rounded(V.replay_returns(r).select("l_orderkey", "l_linenumber", "gross", "net", "gross_up", "net_up", "beats_market"), "gross", "net")


@query("v8_replay_metrics", """WITH p AS (SELECT sum(hits) h, sum(n_selected) n, avg(found / n_best) r, count(*) d FROM pr WHERE n_selected > 0), t AS (SELECT sum(positive::INT) top1 FROM (SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY score DESC, security_code) k FROM decided) WHERE k = 1), i AS (SELECT avg(rank_ic) ic, count(rank_ic) e FROM ics),
    w AS (SELECT *, h / n p, 1.959963984540054 z FROM p) SELECT CAST(h AS BIGINT) hits, CAST(n AS BIGINT) n, round(r, 6) recall_at_k, d decisions, CAST(top1 AS BIGINT) top1_hits, round(ic, 6) mean_rank_ic, e effective_decisions, round(p, 6) hit_rate,
    round(greatest(0, (p + z*z/(2*n)) / (1 + z*z/n) - z / (1 + z*z/n) * sqrt(p*(1-p)/n + z*z/(4*n*n))), 6) wilson_low, round(least(1, (p + z*z/(2*n)) / (1 + z*z/n) + z / (1 + z*z/n) * sqrt(p*(1-p)/n + z*z/(4*n*n))), 6) wilson_high FROM w, t, i""")
def _(v: Views):
    return rounded(V.replay_metrics(decided(v), 5), "recall_at_k", "mean_rank_ic", "hit_rate", "wilson_low", "wilson_high")


@query("v9_wilson_interval", """WITH g AS (SELECT l_suppkey, count(*) n, count(*) FILTER (l_returnflag = 'A') h, 1.959963984540054 z FROM lineitem GROUP BY 1) SELECT l_suppkey, h hits, n, round(greatest(0, (h/n + z*z/(2*n)) / (1 + z*z/n) - z / (1 + z*z/n) * sqrt(h/n*(1-h/n)/n + z*z/(4*n*n))), 6) low, round(least(1, (h/n + z*z/(2*n)) / (1 + z*z/n) + z / (1 + z*z/n) * sqrt(h/n*(1-h/n)/n + z*z/(4*n*n))), 6) high FROM g""")
def _(v: Views):
    g = v.table("lineitem").groupBy("l_suppkey").agg(F.sum((F.col("l_returnflag") == "A").cast("int")).alias("hits"), F.count("*").alias("n"))
    lo, hi = wilson(F.col("hits"), F.col("n"))
    return rounded(g.withColumn("low", lo).withColumn("high", hi), "low", "high")


def samples(v: Views):
    o = v.table("orders").select(F.col("o_orderkey").alias("sample_id"), F.to_date("o_orderdate").alias("feature_cutoff"), F.date_add(F.to_date("o_orderdate"), 20).alias("label_end"))
    return o.where("sample_id % 5 <> 0"), o.where(F.col("sample_id") % 5 == 0).where("feature_cutoff >= date '2000-01-01'")


PURGE = """WITH s AS (SELECT o_orderkey sample_id, CAST(o_orderdate AS DATE) fc, CAST(o_orderdate AS DATE) + 20 le FROM orders), c AS (SELECT min(fc) m FROM s WHERE sample_id % 5 = 0 AND fc >= DATE '2000-01-01')"""


@query("v10_purge_embargo", PURGE + " SELECT sample_id, coalesce(le < m, false) kept FROM s, c WHERE sample_id % 5 <> 0")
def _(v: Views):
    return V.purge_embargo(*samples(v)).select("sample_id", "kept")


@query("v11_causal_leaks", PURGE + " SELECT sample_id FROM s, c WHERE sample_id % 5 <> 0 AND le >= m")
def _(v: Views):
    return V.causal_leaks(*samples(v)).select("sample_id")


@query("v12_pit_row_violations", """SELECT event_id decision_id, security_code, 'FEATURE_AFTER_DECISION' code FROM ev WHERE event_id % 6 = 0 UNION ALL SELECT event_id, security_code, 'SCORE_AFTER_DECISION' FROM ev WHERE event_id % 10 = 0 UNION ALL SELECT event_id, security_code, 'OUTCOME_BEFORE_SESSION_CLOSE' FROM ev WHERE event_id % 14 = 0""")
def _(v: Views):
    k, at = F.col("event_id"), F.col("event_at")
    late = lambda n: F.when(k % n == 0, at + F.expr("interval 1 minute")).otherwise(at)
    e = v.events().select(k.alias("decision_id"), "security_code", at.alias("decision_at"), at.alias("identity_available_at"), at.alias("sector_available_at"), late(6).alias("feature_available_at"), late(10).alias("score_available_at"), F.when(k % 14 == 0, at).otherwise(at + F.expr("interval 2 days")).alias("outcome_observed_at"), (at + F.expr("interval 1 day")).alias("session_close"))
    return V.pit_row_violations(e)


@query("v13_metric_identity_violations", """SELECT l_suppkey metric_id, unnest(list_filter([CASE WHEN l_suppkey % 10 = 0 THEN 'HITS_EXCEED_DENOMINATOR' END, CASE WHEN l_suppkey % 7 = 0 THEN 'RATE_DIFFERS' END, 'WILSON_DIFFERS', CASE WHEN l_suppkey % 9 = 0 THEN 'RANK_IC_OUT_OF_RANGE' END], lambda x: x IS NOT NULL)) code FROM (SELECT DISTINCT l_suppkey FROM lineitem)""")
def _(v: Views):
    k = F.col("l_suppkey")
    g = v.table("lineitem").groupBy("l_suppkey").agg(F.sum((F.col("l_returnflag") == "A").cast("int")).alias("h"), F.count("*").alias("denominator")).withColumn("hits", F.when(k % 10 == 0, F.col("denominator") + 1).otherwise(F.col("h")))
    m = g.select(k.alias("metric_id"), "hits", "denominator", (F.col("hits") / F.col("denominator") + F.when(k % 7 == 0, 0.01).otherwise(0.0)).alias("rate"), F.lit(2.0).alias("wilson_low"), F.lit(2.0).alias("wilson_high"), F.when(k % 9 == 0, 1.5).otherwise(0.1).alias("rank_ic"))
    return V.metric_identity_violations(m)


@query("l1_chain_violations", """SELECT ledger_id, seq, 'PREVIOUS_HASH_BREAK' code FROM ledger WHERE ledger_id % 11 = 0 AND seq = 2""")
def _(v: Views):
    return L.chain_violations(v.ledger())


@query("l2_revision_violations", """WITH r AS (SELECT ledger_id claim_id, seq, unnest(list_filter([CASE WHEN ledger_id % 5 = 0 AND seq = 2 THEN 'REVISION_NUMBER' END, CASE WHEN ledger_id % 11 = 0 AND seq = 2 THEN 'SUPERSEDES_BREAK' END, CASE WHEN ledger_id % 7 = 0 AND seq > 1 THEN 'ORIGIN_CHANGED' END, CASE WHEN ledger_id % 13 = 0 AND seq = 3 THEN 'BACKDATED' END], lambda x: x IS NOT NULL)) code FROM ledger) SELECT * FROM r""")
def _(v: Views):
    k, n = F.col("ledger_id"), F.col("seq")
    e = v.ledger().select(k.alias("claim_id"), n, "event_hash", F.col("previous_hash").alias("supersedes_hash"), F.when((k % 5 == 0) & (n == 2), 9).otherwise(n).alias("revision"), F.when((k % 7 == 0) & (n > 1), "other").otherwise("o").alias("origin_id"), F.lit("m").alias("mode"), F.when((k % 13 == 0) & (n == 3), 0).otherwise(n).alias("recorded_at"))
    return L.revision_violations(e)


@query("l3_outcome_link_violations", """SELECT o_orderkey outcome_id, unnest(list_filter([CASE WHEN o_orderkey % 20 = 0 THEN 'DECISION_MISSING' END, CASE WHEN o_orderkey % 20 <> 0 AND o_orderkey % 9 = 0 THEN 'NOT_A_CANDIDATE' END, CASE WHEN o_orderkey % 20 <> 0 AND o_orderkey % 8 = 0 THEN 'OBSERVED_BEFORE_DECISION' END], lambda x: x IS NOT NULL)) code FROM orders""")
def _(v: Views):
    o, k, at = v.table("orders"), F.col("o_orderkey"), F.to_date("o_orderdate")
    out = o.select(k.alias("outcome_id"), k.alias("decision_id"), F.when(k % 9 == 0, "zz").otherwise(F.col("o_custkey").cast("string")).alias("security_code"), F.date_add(at, F.when(k % 8 == 0, -1).otherwise(1)).alias("observed_at"))
    return L.outcome_link_violations(out, o.where(k % 20 != 0).select(k.alias("decision_id"), at.alias("decided_at"), F.array(F.col("o_custkey").cast("string"), F.lit("x")).alias("candidates")))


@query("l4_stream_seal", """SELECT ledger_id, CAST(sum(n) AS BIGINT) n, arg_min(f, part) first_hash, arg_max(l, part) last_hash, CASE WHEN count(*) = 1 THEN min(d) ELSE sha256(string_agg(d, chr(10) ORDER BY part)) END digest FROM (SELECT ledger_id, (seq - 1) // 4096 part, count(*) n, arg_min(event_hash, seq) f, arg_max(event_hash, seq) l, sha256(string_agg(event_hash, chr(10) ORDER BY seq)) d FROM ledger GROUP BY 1, 2) GROUP BY 1""")
def _(v: Views):
    return L.stream_seal(v.ledger())


@query("l4_ledger_seal", """SELECT ledger_id, count(*) event_count, arg_min(event_hash, seq) first_event_hash, arg_max(event_hash, seq) last_event_hash, sha256(string_agg('{"event_hash":"' || event_hash || '","seq":' || seq || '}' || chr(10), '' ORDER BY seq)) content_sha256 FROM ledger GROUP BY 1""")
def _(v: Views):
    line = F.concat(F.lit('{"event_hash":"'), "event_hash", F.lit('","seq":'), F.col("seq").cast("string"), F.lit("}"))
    return L.ledger_seal(v.ledger().withColumn("line", line))


@query("l5_packet_hash", """SELECT source || '-' || (doc_id // 1000) packet_id, count(*) n_files, sha256('[' || string_agg('{"path":"d' || doc_id || '","sha256":"' || sha256(text) || '"}', ',' ORDER BY 'd' || doc_id) || ']' || chr(10)) packet_sha256 FROM documents GROUP BY 1""")  # packets of a bounded number of files
def _(v: Views):
    return L.packet_hash(v.table("documents").select(F.concat_ws("-", "source", F.floor(F.col("doc_id") / 1000).cast("string")).alias("packet_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256")))


@query("l6_manifest_inventory", """SELECT 'd' || doc_id path, unnest(list_filter([CASE WHEN doc_id % 10 = 0 THEN 'MISSING_FILE' END, CASE WHEN doc_id % 11 = 0 AND doc_id % 10 <> 0 THEN 'UNREFERENCED_FILE' END, CASE WHEN doc_id % 13 = 0 AND doc_id % 11 <> 0 THEN 'DUPLICATE_PATH' END, CASE WHEN doc_id % 17 = 0 AND doc_id % 11 <> 0 AND doc_id % 10 <> 0 THEN 'SIZE_MISMATCH' END], lambda x: x IS NOT NULL)) code FROM documents WHERE doc_id % 10 <> 0 OR doc_id % 11 <> 0""")
def _(v: Views):
    d, k = v.table("documents"), F.col("doc_id")
    path = F.concat(F.lit("d"), k.cast("string")).alias("path")
    m = d.where(k % 11 != 0).select(path, F.col("n_chars").alias("size_bytes"), k)
    return L.manifest_inventory(m.unionByName(m.where(k % 13 == 0)), d.where(k % 10 != 0).select(path, (F.col("n_chars") + F.when(k % 17 == 0, 1).otherwise(0)).alias("size_bytes")))


@query("l7_outcome_payload_violations", """SELECT event_id outcome_id, unnest(list_filter([CASE WHEN event_id % 3 = 0 AND NOT (value / 100 - 1 BETWEEN -1 AND 10) THEN 'RETURN_OUT_OF_RANGE' END, CASE WHEN event_id % 3 = 1 AND value / 100 - 1 <= 0 THEN 'PRICE_NOT_POSITIVE' END, CASE WHEN event_id % 3 = 2 THEN 'UNKNOWN_UNIT' END, CASE WHEN event_id % 7 = 0 THEN 'TIMES_OUT_OF_ORDER' END], lambda x: x IS NOT NULL)) code FROM ev""")
def _(v: Views):
    k, at = F.col("event_id"), F.col("event_at")
    o = v.events().select(k.alias("outcome_id"), F.when(k % 3 == 0, "RETURN").when(k % 3 == 1, "FILS").otherwise("X").alias("unit"), (F.col("value") / 100 - 1).alias("value"), at.alias("decided_at"), at.alias("start_at"), F.when(k % 7 == 0, at - F.expr("interval 1 day")).otherwise(at).alias("end_at"), F.col("captured_at").alias("observed_at"))
    return L.outcome_payload_violations(o)


@query("l8_receipt_mismatches", """SELECT 'c' || doc_id component, 'd' || doc_id upstream, CASE WHEN doc_id % 9 = 0 THEN 'UPSTREAM_MISSING' ELSE 'UPSTREAM_CHANGED' END code FROM documents WHERE doc_id % 9 = 0 OR doc_id % 14 = 0""")
def _(v: Views):
    d = v.table("documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("component"), F.sha2("text", 256).alias("sha256"))
    r = d.select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("component"), F.col("component").alias("upstream"), F.when(F.col("doc_id") % 14 == 0, "old").otherwise(F.col("sha256")).alias("recorded_sha256"))
    return L.receipt_mismatches(r, d.where("doc_id % 9 <> 0"))


@query("l9_lineage_violations", """SELECT o_orderkey run_id, 'b' stage, unnest(list_filter([CASE WHEN o_orderkey % 6 = 0 THEN 'PREDECESSORS_DIFFER' END, CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 6 <> 0 THEN 'PREDECESSOR_ABSENT' END, CASE WHEN o_orderkey % 15 = 1 AND o_orderkey % 10 <> 0 AND o_orderkey % 6 <> 0 THEN 'BATCH_DIFFERS' END], lambda x: x IS NOT NULL)) code FROM orders""")
def _(v: Views):
    o, k = v.table("orders"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    a = o.where(k % 10 != 0).select(k.alias("run_id"), F.lit("a").alias("stage"), F.when(k % 15 == 1, "x").otherwise("y").alias("batch_id"), none.alias("predecessors"))
    b = o.select(k.alias("run_id"), F.lit("b").alias("stage"), F.lit("y").alias("batch_id"), F.when(k % 6 == 0, none).otherwise(F.array(F.lit("a"))).alias("predecessors"))
    return L.lineage_violations(a.unionByName(b), v.spark.createDataFrame([("a", []), ("b", ["a"])], "stage string, expected array<string>"))


@query("l10_forecast_payload_violations", """SELECT event_id, unnest(list_filter([CASE WHEN event_id % 6 = 0 THEN 'OUTCOME_FIELD' END, CASE WHEN event_id % 6 = 0 THEN 'FIELD_NOT_ALLOWED' END, CASE WHEN event_id % 4 = 0 THEN 'SELECTED_AND_ABSTAINED' END, CASE WHEN event_id % 10 = 1 THEN 'SCORE_MISSING' END], lambda x: x IS NOT NULL)) code FROM ev""")
def _(v: Views):
    k = F.col("event_id")
    flag = lambda c: F.when(c, "true").otherwise("false")
    payload = F.concat(F.lit('{"selected":'), flag(k % 2 == 0), F.lit(',"abstained":'), flag(k % 4 == 0), F.when(k % 10 != 1, F.lit(',"score":1.5')).otherwise(""), F.when(k % 6 == 0, F.lit(',"outcome_return":2')).otherwise(""), F.lit("}"))
    return L.forecast_payload_violations(v.events().select("event_id", payload.alias("payload")), ["selected", "abstained", "score"])


#: A forecast for each event, with faults that depend on it in several ways; the rules below look at the text alone.
SQL["forecasts"] = """SELECT event_id, '{"decision_id":"d","security_code":"' || (user_id % 20) || '","product_id":"p","target_rule":"t","model_version":"m","entry_rule":"e","thesis_episode_id":' || CASE WHEN event_id % 23 = 0 THEN 'null' ELSE '"th"' END || ',"decision_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 29 = 0 THEN '' ELSE 'Z' END || '","outcome_due_at":"' || strftime(ts + to_days(CAST(event_id % 4 AS INT)), '%Y-%m-%dT%H:%M:%S') || 'Z","horizon_sessions":' || (event_id % 6)
    || ',"eligible":' || CASE WHEN event_id % 5 = 0 THEN 'false' ELSE 'true' END || ',"selected":' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END || ',"abstained":' || CASE WHEN event_id % 7 = 0 THEN 'true' WHEN event_id % 31 = 0 THEN '"no"' ELSE 'false' END || CASE WHEN event_id % 2 = 0 THEN ',"probability":' || (CAST(user_id AS INT) % 12) || 'e-1' ELSE '' END || CASE WHEN event_id % 11 <> 0 THEN ',"score":1.5' ELSE '' END
    || CASE WHEN event_id % 13 = 0 THEN ',"rank":' || (event_id % 3 - 1) ELSE '' END || CASE WHEN event_id % 17 = 0 THEN ',"reason_codes":{"a":[{"realized_gain":1}]}' WHEN event_id % 19 = 0 THEN ',"reason_codes":["outcome: none"]' ELSE '' END || '}' payload FROM events"""


def forecasts(v: Views):
    k, at = F.col("event_id"), F.col("ts")
    flag = lambda c, yes="true", no="false": F.when(c, yes).otherwise(no)
    stamp = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    parts = [
        '{"decision_id":"d","security_code":"', (F.col("user_id") % 20).cast("string"), '","product_id":"p","target_rule":"t","model_version":"m","entry_rule":"e","thesis_episode_id":', flag(k % 23 == 0, "null", '"th"'), ',"decision_at":"', stamp(at), flag(k % 29 == 0, "", "Z"),
        '","outcome_due_at":"', stamp(at + F.make_interval(days=(k % 4).cast("int"))), 'Z","horizon_sessions":', (k % 6).cast("string"), ',"eligible":', flag(k % 5 == 0, "false", "true"), ',"selected":', flag(k % 3 == 0), ',"abstained":', F.when(k % 7 == 0, "true").when(k % 31 == 0, '"no"').otherwise("false"),
        F.when(k % 2 == 0, F.concat(F.lit(',"probability":'), (F.col("user_id").cast("int") % 12).cast("string"), F.lit("e-1"))).otherwise(""), flag(k % 11 != 0, ',"score":1.5', ""), F.when(k % 13 == 0, F.concat(F.lit(',"rank":'), (k % 3 - 1).cast("string"))).otherwise(""),
        F.when(k % 17 == 0, ',"reason_codes":{"a":[{"realized_gain":1}]}').when(k % 19 == 0, ',"reason_codes":["outcome: none"]').otherwise(""), "}",
    ]
    return v.table("events").select("event_id", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("payload"))


@query("l10_forecast_payload_rules", """WITH j AS (SELECT event_id, payload, json_extract_string(payload, '$.decision_at') da, json_extract_string(payload, '$.outcome_due_at') du, json_extract_string(payload, '$.selected') sel, json_extract_string(payload, '$.abstained') ab, json_extract_string(payload, '$.eligible') el, json_extract_string(payload, '$.probability') pr, json_extract_string(payload, '$.score') sc, json_extract_string(payload, '$.rank') rk, json_extract_string(payload, '$.horizon_sessions') hz, json_extract_string(payload, '$.thesis_episode_id') th FROM forecasts)
    SELECT event_id, unnest(list_filter([CASE WHEN regexp_matches(payload, '"realized_[a-z]*" *:') THEN 'OUTCOME_FIELD' END, CASE WHEN th IS NULL THEN 'FIELD_MISSING' END, CASE WHEN NOT ends_with(da, 'Z') THEN 'TIME_UNREADABLE' END, CASE WHEN CAST(replace(du, 'Z', '') AS TIMESTAMP) <= CAST(replace(da, 'Z', '') AS TIMESTAMP) THEN 'OUTCOME_DUE_NOT_AFTER_DECISION' END, CASE WHEN CAST(hz AS INT) < 1 THEN 'HORIZON_NOT_POSITIVE' END, CASE WHEN ab NOT IN ('true', 'false') THEN 'FLAG_NOT_BOOLEAN' END,
    CASE WHEN sel = 'true' AND (ab = 'true' OR el = 'false') THEN 'SELECTED_AND_ABSTAINED' END, CASE WHEN sc IS NULL AND pr IS NULL THEN 'SCORE_MISSING' END, CASE WHEN CAST(pr AS DOUBLE) > 1 THEN 'PROBABILITY_OUT_OF_RANGE' END, CASE WHEN CAST(rk AS INT) < 1 THEN 'RANK_NOT_POSITIVE' END, CASE WHEN json_type(payload, '$.reason_codes') NOT IN ('ARRAY', 'NULL') THEN 'LIST_EXPECTED' END], lambda x: x IS NOT NULL)) code FROM j""")
def _(v: Views):
    return L.forecast_payload_violations(forecasts(v), required=L.FORECAST_REQUIRED)


@query("v8_replay_metrics_excess", """WITH r AS (SELECT *, outcome - avg(outcome) OVER (PARTITION BY decision_id) + 0.001 x FROM outcomes), k AS (SELECT decision_id, rank() OVER (PARTITION BY decision_id ORDER BY score) + (count(*) OVER (PARTITION BY decision_id, score) - 1) / 2 a, rank() OVER (PARTITION BY decision_id ORDER BY x) + (count(*) OVER (PARTITION BY decision_id, x) - 1) / 2 b FROM r)
    SELECT round(avg(ic), 6) mean_market_rank_ic, count(ic) market_rank_ic_decisions FROM (SELECT CASE WHEN count(*) >= 2 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN corr(a, b) END ic FROM k GROUP BY decision_id)""")
def _(v: Views):
    from pyspark.sql.window import Window

    mean = F.avg("outcome").over(Window.partitionBy("decision_id"))
    rows = v.outcomes().withColumn("market_excess", F.col("outcome") - mean + 0.001).withColumn("positive", F.col("outcome") > 0).withColumn("selected", F.col("score") > 0)
    return V.replay_metrics(rows, 5).select(F.round("mean_market_rank_ic", 6).alias("mean_market_rank_ic"), "market_rank_ic_decisions")
