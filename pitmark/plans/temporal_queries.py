"""Identity, calendar and status queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitmark.functions.columns import names_compatible
from pitmark.operators import temporal as J
from pitmark.plans.registry import query
from pitmark.plans.views import SQL, Views

FIRST, LAST = "1995-01-01", "2002-12-31"

SQL["st"] = f"""SELECT security_code, status, effective_from, effective_to FROM (SELECT security_code, s status, since effective_from, lead(since) OVER (PARTITION BY security_code ORDER BY k) - 1 e0, CASE WHEN lead(since) OVER (PARTITION BY security_code ORDER BY k) IS NULL THEN DATE '{LAST}' ELSE CAST(lead(since) OVER (PARTITION BY security_code ORDER BY k) - 1 AS DATE) END effective_to FROM st_steps WHERE ok) WHERE effective_to >= effective_from"""
SQL["st_steps"] = f"""WITH RECURSIVE n AS (SELECT security_code, effective_date, event_type, row_number() OVER (PARTITION BY security_code ORDER BY effective_date, notice_id) k FROM notices WHERE effective_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
    r AS (SELECT DISTINCT security_code, CAST(0 AS BIGINT) k, 'TRADING' s, DATE '{FIRST}' since, true ok, '' prev, '' ev FROM n UNION ALL
    SELECT n.security_code, n.k, coalesce(t.c, r.s), CASE WHEN t.c IS NULL THEN n.effective_date ELSE n.effective_date END, t.c IS NOT NULL, r.s, n.event_type FROM r JOIN n ON n.security_code = r.security_code AND n.k = r.k + 1
    LEFT JOIN (VALUES ('TRADING', 'SUSPEND', 'SUSPENDED'), ('SUSPENDED', 'RESUME', 'TRADING'), ('TRADING', 'DELIST', 'DELISTED'), ('SUSPENDED', 'DELIST', 'DELISTED'), ('DELISTED', 'RELIST', 'TRADING')) t(a, b, c) ON t.a = r.s AND t.b = n.event_type) SELECT * FROM r"""


def statuses(v: Views):
    return J.status_intervals(v.notices(), FIRST, LAST)


def facts(v: Views):
    return v.table("orders").select(F.col("o_orderkey").alias("fact_id"), F.col("o_custkey").cast("string").alias("security_code"), F.to_date("o_orderdate").alias("fact_date"))


SQL["facts"] = "SELECT o_orderkey fact_id, CAST(o_custkey AS VARCHAR) security_code, CAST(o_orderdate AS DATE) fact_date FROM orders"


@query("j1_overlapping_intervals", """SELECT security_code, board, valid_from, valid_to, next_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY security_code, board ORDER BY valid_from, coalesce(valid_to, DATE '9999-12-31')) next_from FROM identity) WHERE next_from <= coalesce(valid_to, DATE '9999-12-31')""")
def _(v: Views):
    return J.overlapping_intervals(v.identity(), ["security_code", "board"])


@query("j2_identifier_collisions", """SELECT a.isin, a.security_code a_security_code, b.security_code b_security_code, a.valid_from a_valid_from, b.valid_from b_valid_from FROM identity a JOIN identity b ON a.isin = b.isin AND (a.security_code < b.security_code OR a.security_code = b.security_code AND a.board < b.board)
    AND a.valid_from <= coalesce(b.valid_to, DATE '9999-12-31') AND b.valid_from <= coalesce(a.valid_to, DATE '9999-12-31')""")
def _(v: Views):
    return J.identifier_collisions(v.identity())


@query("j2_identifier_collision_links", """WITH i AS (SELECT isin, security_code, board, valid_from, coalesce(valid_to, DATE '9999-12-31') e, '{"security_code":"' || security_code || '","board":"' || board || '"}' l FROM identity),
    p AS (SELECT a.isin, a.security_code, a.board, a.valid_from, a.e, a.l, max(row(b.e, b.l, b.valid_from)) x FROM i a JOIN i b ON a.isin = b.isin AND a.l <> b.l AND row(b.valid_from, b.e, b.l) < row(a.valid_from, a.e, a.l) AND b.e >= a.valid_from GROUP BY ALL)
    SELECT isin, security_code, board, valid_from, struct_extract(x, 2) with_listing, struct_extract(x, 3) with_from, nullif(struct_extract(x, 1), DATE '9999-12-31') with_to FROM p""")
def _(v: Views):
    return J.collision_links(v.identity())


@query("j3_resolve_identity", """SELECT fact_id, f.security_code, fact_date, CASE WHEN count(i.isin) = 1 THEN min(i.isin) END isin, CASE count(i.isin) WHEN 1 THEN 'MATCHED' WHEN 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END resolution
    FROM facts f LEFT JOIN identity i ON i.security_code = f.security_code AND fact_date >= valid_from AND fact_date <= coalesce(valid_to, DATE '9999-12-31') GROUP BY ALL""")
def _(v: Views):
    return J.resolve_as_of(facts(v), ["fact_id"], "fact_date", v.identity(), "isin")


@query("j4_status_as_of", """SELECT fact_id, f.security_code, fact_date, CASE WHEN count(st.status) = 1 THEN min(st.status) END status, CASE count(st.status) WHEN 1 THEN 'MATCHED' WHEN 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END resolution
    FROM facts f LEFT JOIN st ON st.security_code = f.security_code AND fact_date BETWEEN effective_from AND effective_to GROUP BY ALL""")
def _(v: Views):
    return J.resolve_as_of(facts(v), ["fact_id"], "fact_date", statuses(v), "status", "effective_from", "effective_to")


@query("j5_eligible_universe", """WITH d AS (SELECT DISTINCT c.trade_date, i.security_code, st.status, st.effective_from, st.effective_to FROM identity i JOIN st ON st.security_code = i.security_code JOIN calendar c ON c.trade_date >= greatest(valid_from, effective_from) AND c.trade_date <= least(coalesce(valid_to, DATE '9999-12-31'), effective_to) WHERE c.is_trading_day)
    SELECT trade_date, security_code, min(status) status FROM d GROUP BY 1, 2 HAVING count(*) = 1 AND min(status) IN ('TRADING', 'SUSPENDED', 'HALTED')""")
def _(v: Views):
    return J.eligible_universe(v.calendar(), v.identity(), statuses(v))


@query("j6_build_calendar", """SELECT trade_date, k session_type, k = 'NORMAL' is_trading_day, CASE WHEN k = 'NORMAL' THEN 'R1' END session_regime_id, CASE WHEN k = 'NORMAL' THEN '09:00' END continuous_start FROM (
    SELECT d trade_date, CASE WHEN d IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 400 = 0) THEN 'HOLIDAY' WHEN dayofweek(d) IN (5, 6) THEN 'WEEKEND' ELSE 'NORMAL' END k FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) d))""")
def _(v: Views):
    holidays = v.table("orders").where("o_orderkey % 400 = 0").select(F.to_date("o_orderdate").alias("trade_date"))
    return J.build_calendar(v.spark, "1996-01-01", "2000-12-31", holidays, [1, 2, 3, 4, 5], {"session_regime_id": "R1", "continuous_start": "09:00"})


@query("j7_calendar_gaps", """WITH c AS (SELECT * FROM calendar WHERE day(trade_date) <> 9) SELECT d trade_date, 'MISSING_DAY' code FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) d) WHERE d NOT IN (SELECT trade_date FROM c)
    UNION ALL SELECT trade_date, 'EXTRA_DAY' FROM c WHERE trade_date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' UNION ALL SELECT trade_date, 'SESSION_WITHOUT_TIMES' FROM c WHERE is_trading_day AND day(trade_date) = 8""")
def _(v: Views):
    c = v.calendar().where(F.dayofmonth("trade_date") != 9).withColumn("close_time", F.when(F.dayofmonth("trade_date") != 8, "13:15"))
    return J.calendar_gaps(c, F.lit("1996-01-01").cast("date"), F.lit("2000-12-31").cast("date"))


@query("j8_status_intervals", "SELECT * FROM st")
def _(v: Views):
    return statuses(v)


@query("j8_status_errors", "SELECT security_code, prev status, ev event_type, since effective_date FROM st_steps WHERE k > 0 AND NOT ok")
def _(v: Views):
    return J.status_transition_errors(v.notices(), FIRST, LAST)


@query("j9_snapshot_reconcile", """WITH h AS (SELECT security_code, arg_max(status, effective_from) history_status FROM st GROUP BY 1), s AS (SELECT CAST(c_custkey AS VARCHAR) security_code, CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'TRADING' END snapshot_status FROM customer)
    SELECT security_code, history_status, snapshot_status, CASE WHEN history_status IS NULL THEN 'NOT_IN_HISTORY' WHEN snapshot_status IS NULL THEN 'MISSING_CURRENT_STATUS' WHEN history_status <> snapshot_status THEN 'STATUS_MISMATCH' ELSE 'OK' END code FROM h FULL JOIN s USING (security_code)""")
def _(v: Views):
    snap = v.table("customer").select(F.col("c_custkey").cast("string").alias("security_code"), F.when(F.col("c_acctbal") < 0, "SUSPENDED").otherwise("TRADING").alias("status"))
    return J.snapshot_reconcile(statuses(v), snap)


@query("j10_delisting_checks", """WITH d AS (SELECT security_code, effective_date FROM notices WHERE event_type = 'DELIST') SELECT security_code, 'DUPLICATE_DELISTED_IDENTITY' code FROM d GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT security_code, 'FUTURE_DELISTING_DATE' FROM d WHERE effective_date > DATE '2000-06-30'""")
def _(v: Views):
    d = v.notices().where("event_type = 'DELIST'").select("security_code", F.col("effective_date").alias("delisted_on"))
    return J.delisting_checks(d, F.lit("2000-06-30").cast("date"))


@query("j11_name_compatible", """WITH t AS (SELECT p_partkey, list_distinct(list_filter(string_split(upper(p_name || ' Company'), ' '), lambda x: x <> '')) a, list_distinct(list_filter(string_split(upper(p_type || ' ' || p_name), ' '), lambda x: x <> '')) b FROM part)
    SELECT p_partkey, len(list_intersect(a, b)) >= 0.8 * least(len(a), len(b)) compatible FROM t""")
def _(v: Views):
    p = v.table("part")
    return p.select("p_partkey", names_compatible(F.concat("p_name", F.lit(" Co.")), F.concat_ws(" ", "p_type", "p_name")).alias("compatible"))


@query("j12_reconcile_identity_sources", """WITH a AS (SELECT p_partkey k, p_brand isin, p_type ticker, p_name n FROM part WHERE p_partkey % 11 <> 0), b AS (SELECT p_partkey k, CASE WHEN p_partkey % 13 = 0 THEN 'X' ELSE p_brand END isin, CASE WHEN p_partkey % 17 = 0 THEN 'Y' ELSE p_type END ticker, CASE WHEN p_partkey % 19 = 0 THEN 'other words' ELSE p_name END n FROM part WHERE p_partkey % 7 <> 0), s AS (SELECT p_partkey k FROM part WHERE p_partkey % 5 <> 0)
    SELECT CAST(p_partkey AS VARCHAR) security_code, list_filter([CASE WHEN a.k IS NULL THEN 'MISSING_IN_A' END, CASE WHEN b.k IS NULL THEN 'MISSING_IN_B' END, CASE WHEN s.k IS NULL THEN 'NOT_IN_SEED' END, CASE WHEN a.isin <> b.isin THEN 'ISIN_CONFLICT' END, CASE WHEN a.ticker <> b.ticker THEN 'TICKER_CONFLICT' END, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL AND p_partkey % 19 = 0 THEN 'NAME_CONFLICT' END], lambda x: x IS NOT NULL) codes
    FROM part LEFT JOIN a ON a.k = p_partkey LEFT JOIN b ON b.k = p_partkey LEFT JOIN s ON s.k = p_partkey WHERE a.k IS NOT NULL OR b.k IS NOT NULL OR s.k IS NOT NULL""")
def _(v: Views):
    p, k = v.table("part"), F.col("p_partkey")
    code = k.cast("string").alias("security_code")
    a = p.where(k % 11 != 0).select(code, F.col("p_brand").alias("isin"), F.col("p_type").alias("ticker"), F.col("p_name").alias("name"))
    b = p.where(k % 7 != 0).select(code, F.when(k % 13 == 0, "X").otherwise(F.col("p_brand")).alias("isin"), F.when(k % 17 == 0, "Y").otherwise(F.col("p_type")).alias("ticker"), F.when(k % 19 == 0, "other words").otherwise(F.col("p_name")).alias("name"))
    return J.reconcile_identity_sources(a, b, p.where(k % 5 != 0).select(code))


@query("j13_nth_session_due", """WITH d AS (SELECT o_orderkey decision_id, CAST(o_custkey AS VARCHAR) security_code, CAST(o_orderdate AS DATE) decision_date FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT trade_date FROM calendar)),
    s AS (SELECT decision_id, c.trade_date, row_number() OVER (PARTITION BY decision_id ORDER BY c.trade_date) rn FROM d JOIN st ON st.security_code = d.security_code AND st.status = 'TRADING' JOIN calendar c ON c.is_trading_day AND c.trade_date > d.decision_date AND c.trade_date BETWEEN st.effective_from AND st.effective_to)
    SELECT d.*, s.trade_date due_date, CASE WHEN s.trade_date IS NULL THEN 'HORIZON_NOT_COVERED' ELSE 'OK' END code FROM d LEFT JOIN s ON s.decision_id = d.decision_id AND rn = 5""")
def _(v: Views):
    cal = v.calendar()
    d = facts(v).select(F.col("fact_id").alias("decision_id"), "security_code", F.col("fact_date").alias("decision_date"))
    d = d.join(F.broadcast(cal.select(F.col("trade_date").alias("decision_date"))), "decision_date", "left_semi")
    # intervals are cut to the calendar's days
    span = cal.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    s = statuses(v).crossJoin(F.broadcast(span)).select("security_code", "status", F.greatest("effective_from", "lo").alias("effective_from"), F.least("effective_to", "hi").alias("effective_to")).where("effective_from <= effective_to")
    return J.nth_session_due(d, cal, s, 5)


@query("j14_session_pairs", "SELECT * FROM (SELECT trade_date, lead(trade_date) OVER (ORDER BY trade_date) next_session FROM calendar WHERE is_trading_day) WHERE next_session IS NOT NULL")
def _(v: Views):
    return J.session_pairs(v.calendar())


@query("j15_trust_entry_as_of", """SELECT fact_id, f.security_code, fact_date, CASE WHEN count(i.isin) = 1 THEN min(i.isin) END isin, CASE count(i.isin) WHEN 1 THEN 'MATCHED' WHEN 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END resolution
    FROM facts f LEFT JOIN identity i ON i.security_code = f.security_code AND fact_date >= valid_from AND fact_date < coalesce(valid_to, DATE '9999-12-31') GROUP BY ALL""")
def _(v: Views):
    return J.resolve_as_of(facts(v), ["fact_id"], "fact_date", v.identity(), "isin", half_open=True)


@query("j16_state_status_conflicts", """SELECT DISTINCT b.security_code, trade_date, s trading_state, st.status FROM (SELECT security_code, trade_date, CASE WHEN day(trade_date) % 4 = 0 THEN 'SUSPENDED' ELSE 'TRADED' END s FROM bars) b JOIN st ON st.security_code = b.security_code AND trade_date BETWEEN effective_from AND effective_to WHERE NOT (st.status = 'TRADING' AND s = 'TRADED' OR st.status = 'SUSPENDED' AND s = 'SUSPENDED')""")
def _(v: Views):
    b = v.bars().withColumn("trading_state", F.when(F.dayofmonth("trade_date") % 4 == 0, "SUSPENDED").otherwise("TRADED"))
    allowed = v.spark.createDataFrame([("TRADING", "TRADED"), ("SUSPENDED", "SUSPENDED")], "status string, trading_state string")
    return J.state_status_conflicts(b, statuses(v), allowed)


@query("j17_observed_before_close", """SELECT fact_id, fact_date trade_date FROM facts JOIN calendar ON trade_date = fact_date WHERE fact_id % 24 < 13""")
def _(v: Views):
    rows = facts(v).select("fact_id", F.col("fact_date").alias("trade_date"), (F.col("fact_date").cast("timestamp_ntz") + F.make_interval(hours=(F.col("fact_id") % 24).cast("int"))).alias("observed_at"))
    cal = v.calendar().withColumn("close_at", F.col("trade_date").cast("timestamp_ntz") + F.expr("interval 13 hours"))
    return J.observed_before_close(rows, cal).select("fact_id", "trade_date")


@query("j18_derive_status_snapshot", """SELECT CAST(c_custkey AS VARCHAR) security_code, CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'TRADING' END status, list_filter([CASE WHEN c_acctbal < 0 AND c_custkey % 3 = 0 THEN 'TICKER_CONFLICT' END, CASE WHEN c_custkey % 10 = 0 THEN 'ALREADY_DELISTED' END], lambda x: x IS NOT NULL) codes FROM customer""")
def _(v: Views):
    c = v.table("customer").select(F.col("c_custkey").cast("string").alias("security_code"), F.col("c_name").alias("ticker"), "c_acctbal", "c_custkey")
    s = c.where("c_acctbal < 0").withColumn("ticker", F.when(F.col("c_custkey") % 3 == 0, "other").otherwise(F.col("ticker")))
    return J.derive_status_snapshot(c, s, c.where("c_custkey % 10 = 0"))
