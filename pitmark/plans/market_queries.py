"""Corporate-action and market queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitmark.operators import actions as C
from pitmark.operators import market as A
from pitmark.operators import row_quality as Q
from pitmark.plans.registry import query
from pitmark.plans.temporal_queries import statuses
from pitmark.plans.views import SQL, Views

SQL["factors"] = """SELECT *, factor_status IN ('official', 'reproducible') accepted FROM (SELECT *,
    CASE WHEN error_code IS NOT NULL THEN 'error' WHEN formula_mode = 'NO_AUTOMATIC_FORMULA' THEN 'pending' WHEN formula_mode = 'REPRODUCIBLE_MECHANICAL' THEN 'reproducible' ELSE 'official' END factor_status,
    CASE WHEN error_code IS NULL THEN price END theoretical_ex_price, CASE WHEN error_code IS NULL THEN CASE formula_mode WHEN 'OFFICIAL_FACTOR' THEN CAST(official_factor AS DOUBLE) WHEN 'NO_AUTOMATIC_FORMULA' THEN NULL ELSE price / previous_close END END adjustment_factor,
    error_code IS NULL AND ready return_ready FROM (SELECT *,
    CASE WHEN formula_mode = 'OFFICIAL_FACTOR' THEN CAST(previous_close AS DOUBLE) * official_factor WHEN formula_mode = 'OFFICIAL_REFERENCE_PRICE' THEN CAST(official_reference AS DOUBLE) WHEN formula_mode = 'NO_AUTOMATIC_FORMULA' THEN NULL
      WHEN action_type LIKE 'CASH%' THEN CAST(previous_close - cash AS DOUBLE) WHEN action_type = 'BONUS_SHARES' THEN CAST(previous_close AS DOUBLE) / (1 + new_shares) WHEN action_type = 'RIGHTS_ISSUE' THEN (CAST(previous_close AS DOUBLE) + CAST(rights_ratio AS DOUBLE) * subscription_price) / (1 + rights_ratio) ELSE CAST(previous_close AS DOUBLE) / new_shares END price,
    CASE WHEN formula_mode = 'REPRODUCIBLE_MECHANICAL' AND action_type = 'STOCK_SPLIT' AND new_shares <= 1 THEN 'SPLIT_RATIO_OUT_OF_RANGE' END error_code,
    CASE WHEN formula_mode = 'NO_AUTOMATIC_FORMULA' OR action_type = 'RIGHTS_ISSUE' THEN false WHEN action_type LIKE 'CASH%' THEN true WHEN formula_mode = 'REPRODUCIBLE_MECHANICAL' THEN fractional_policy = 'NOT_APPLICABLE' ELSE official_quantity IS NOT NULL END ready FROM actions))"""


def factors(v: Views):
    return C.adjustment_factors(v.actions())


@query("c1_schedule_violations", """SELECT action_id, 'EX_AFTER_RECORD' code FROM actions WHERE ex_date > record_date UNION ALL SELECT action_id, 'OUTSIDE_WINDOW' FROM actions WHERE ex_date > DATE '2024-02-15' UNION ALL SELECT action_id, 'SCHEDULE_OUTSIDE_WINDOW' FROM actions WHERE least(cum_date, ex_date, record_date, payment_date) > DATE '2024-02-15' OR greatest(cum_date, ex_date, record_date, payment_date) < DATE '2024-01-01'""")
def _(v: Views):
    return C.schedule_violations(v.actions().withColumn("window_from", F.lit("2024-01-01").cast("date")).withColumn("window_to", F.lit("2024-02-15").cast("date")))


@query("c2_stable_action_id", "SELECT action_id, 'ca-schedule-' || substring(sha256(concat_ws(chr(0), security_code, action_type, CAST(ex_date AS VARCHAR))), 1, 24) stable_id FROM actions")
def _(v: Views):
    return v.actions().select("action_id", C.stable_action_id("security_code", "action_type", "ex_date").alias("stable_id"))


@query("c3_adjustment_factors", "SELECT action_id, factor_status, error_code, round(theoretical_ex_price, 6) theoretical_ex_price, round(adjustment_factor, 6) adjustment_factor, return_ready FROM factors")
def _(v: Views):
    f = factors(v)
    return f.select("action_id", "factor_status", "error_code", F.round(F.col("theoretical_ex_price").cast("double"), 6).alias("theoretical_ex_price"), F.round(F.col("adjustment_factor").cast("double"), 6).alias("adjustment_factor"), "return_ready")


@query("c4_factor_ledger", """SELECT count(*) actions, count(*) FILTER (accepted) accepted, count(*) FILTER (factor_status = 'pending') pending, count(*) FILTER (factor_status = 'error') errors, count(*) FILTER (NOT return_ready) queued,
    CASE WHEN count(*) FILTER (factor_status = 'error') > 0 THEN 'BLOCKED' WHEN count(*) FILTER (NOT return_ready) > 0 THEN 'PARTIAL' ELSE 'PASS' END status FROM factors""")
def _(v: Views):
    return C.ledger_status(factors(v))


SQL["trades"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / l_quantity entry_price, l_extendedprice / l_quantity * (1 + l_discount - 0.04) exit_price, 1 + l_tax / 10 factor, l_tax distribution, 100.0 benchmark_entry, 100 + l_discount * 50 benchmark_exit,
    l_returnflag = 'A' selected, CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_orderkey % 3 = 0 THEN 'NOT_FILLED' WHEN l_orderkey % 50 = 1 THEN '' ELSE 'FILLED' END ELSE 'MARKET_OBSERVED' END fill_status, l_quantity FROM lineitem"""


@query("c5_adjusted_returns", """WITH r AS (SELECT *, exit_price * factor / entry_price - 1 + distribution g, benchmark_exit / benchmark_entry - 1 b FROM trades)
    SELECT l_orderkey, l_linenumber, round(g, 6) gross_return, round(g - b, 6) net_excess, round(CASE WHEN selected AND fill_status = 'FILLED' THEN g - b - 0.004 WHEN selected AND fill_status = 'NOT_FILLED' THEN -b END, 6) executed_net_excess, CASE WHEN selected AND fill_status = '' THEN 'NO_FILL_DISPOSITION' END error_code FROM r""")
def _(v: Views):
    lt, unit = v.table("lineitem"), F.col("l_extendedprice") / F.col("l_quantity")
    sel = F.col("l_returnflag") == "A"
    fill = F.when(sel, F.when(F.col("l_orderkey") % 3 == 0, "NOT_FILLED").when(F.col("l_orderkey") % 50 == 1, "").otherwise("FILLED")).otherwise("MARKET_OBSERVED")
    exit_ = unit * (1 + F.col("l_discount") - 0.04)
    o = lt.select("l_orderkey", "l_linenumber", unit.alias("entry_price"), exit_.alias("exit_price"), (1 + F.col("l_tax") / 10).alias("factor"), F.col("l_tax").alias("distribution"), F.lit(100.0).alias("benchmark_entry"), (100 + F.col("l_discount") * 50).alias("benchmark_exit"), *[F.lit(0.001).alias(c) for c in ("fees", "spread", "slippage", "impact")], sel.alias("selected"), fill.alias("fill_status"), unit.alias("executed_entry"), exit_.alias("executed_exit"))
    r = C.adjusted_returns(o)
    return r.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("gross_return", "net_excess", "executed_net_excess")], "error_code")


SQL["dated_actions"] = "SELECT action_id, CAST(CAST(security_code AS INT) + 1 AS VARCHAR) security_code, ex_date - CAST(7 * 365 + CAST(action_id AS INT) % 900 AS INT) ex_date FROM actions"


@query("c6_audit_integration", """WITH w AS (SELECT a.action_id, a.security_code, a.ex_date, count(i.isin) n FROM dated_actions a LEFT JOIN identity i ON i.security_code = a.security_code AND a.ex_date >= i.valid_from AND a.ex_date <= coalesce(i.valid_to, DATE '9999-12-31') GROUP BY ALL),
    s AS (SELECT a.action_id, CASE WHEN count(st.status) = 1 THEN min(st.status) END status FROM dated_actions a LEFT JOIN st ON st.security_code = a.security_code AND a.ex_date BETWEEN st.effective_from AND st.effective_to GROUP BY 1),
    j AS (SELECT w.action_id, w.security_code, list_filter([CASE WHEN n <> 1 THEN 'IDENTITY_UNRESOLVED' END, CASE WHEN NOT coalesce(c.is_trading_day, false) THEN 'NOT_A_SESSION' END, CASE WHEN s.status IS NULL THEN 'STATUS_UNRESOLVED' END, CASE WHEN s.status = 'DELISTED' THEN 'DELISTED_AT_EX_DATE' END, CASE WHEN b.security_code IS NULL THEN 'NO_PRICE_ROW' END, CASE WHEN m.trade_date IS NULL THEN 'NO_BENCHMARK_ROW' END], lambda x: x IS NOT NULL) codes
    FROM w JOIN s USING (action_id) LEFT JOIN calendar c ON c.trade_date = w.ex_date LEFT JOIN bars b ON b.security_code = w.security_code AND b.trade_date = w.ex_date LEFT JOIN (SELECT trade_date FROM benchmark_series WHERE benchmark_code = 'BROAD') m ON m.trade_date = w.ex_date)
    SELECT *, CASE WHEN len(codes) = 0 THEN 'PASS' WHEN list_has_any(codes, ['IDENTITY_UNRESOLVED', 'DELISTED_AT_EX_DATE']) THEN 'BLOCKED' ELSE 'PARTIAL' END audit_status FROM j""")
def _(v: Views):
    a = v.actions().select("action_id", (F.col("security_code").cast("int") + 1).cast("string").alias("security_code"), F.date_sub("ex_date", 7 * 365 + F.col("action_id").cast("int") % 900).alias("ex_date"))
    return C.audit_integration(a, v.identity(), v.calendar(), statuses(v), v.bars(), v.benchmark_series().where("benchmark_code = 'BROAD'"))


@query("c7_policy_factor_links", """WITH q AS (SELECT action_id, security_code, CASE WHEN CAST(action_id AS INT) % 23 = 0 THEN 'OTHER' ELSE action_type END action_type FROM factors WHERE NOT return_ready), f AS (SELECT * FROM factors WHERE accepted)
    SELECT q.action_id, CASE WHEN f.action_id IS NULL THEN 'NO_FACTOR' WHEN q.action_type <> f.action_type THEN 'KEY_FIELDS_DIFFER' ELSE 'OK' END code FROM q LEFT JOIN f USING (action_id)""")
def _(v: Views):
    q = C.policy_queue(factors(v)).withColumn("action_type", F.when(F.col("action_id").cast("int") % 23 == 0, "OTHER").otherwise(F.col("action_type")))
    return C.policy_factor_links(q, C.factor_ledger(factors(v)))


@query("c8_price_reference_precedes_ex", """SELECT action_id, 'REFERENCE_NOT_BEFORE_EX' code FROM actions WHERE CAST(action_id AS INT) % 6 = 0 UNION ALL SELECT action_id, 'REFERENCE_PRICE_DIFFERS' FROM actions WHERE CAST(action_id AS INT) % 9 = 0""")
def _(v: Views):
    k = F.col("action_id").cast("int")
    return C.price_reference_violations(v.actions().withColumn("reference_date", F.date_sub("ex_date", F.when(k % 6 == 0, 0).otherwise(1))).withColumn("reference_price", F.when(k % 9 == 0, F.col("previous_close") + 1).otherwise(F.col("previous_close"))))


@query("a1_merge_providers", """SELECT security_code, trade_date, count(DISTINCT ("close", volume)) = 1 agreed, min(provider_id) primary_provider, CASE WHEN count(DISTINCT ("close", volume)) = 1 THEN round(min("close"), 6) END "close", list_sort(list(evidence_hash) FILTER (provider_id <> 'A')) supporting_hashes FROM provider_rows GROUP BY 1, 2""")
def _(v: Views):
    m = A.merge_providers(v.provider_rows(), ["security_code", "trade_date"], ["close", "volume"])
    return m.select("security_code", "trade_date", "agreed", "primary_provider", F.round("close", 6).alias("close"), F.when(F.size("supporting_hashes") > 0, F.col("supporting_hashes")).alias("supporting_hashes"))


TOTALS = "SELECT trade_date, count(DISTINCT security_code) traded_securities, round(sum(volume), 4) total_volume, round(sum(turnover), 2) total_value, CAST(sum(trade_count) AS BIGINT) total_trades FROM gapped WHERE volume > 0 GROUP BY 1"


def totals(v: Views):
    return A.market_totals(v.gapped(), one_a_day=True).withColumn("total_volume", F.round("total_volume", 4)).withColumn("total_value", F.round("total_value", 2))


@query("a2_market_totals", TOTALS)
def _(v: Views):
    return totals(v)


@query("a2_market_totals_by_state", """SELECT trade_date, count(DISTINCT security_code) traded_securities, sum(volume) total_volume, sum(turnover) total_value, sum(trade_count) total_trades FROM gapped WHERE day(trade_date) % 5 <> 0 AND (CAST(security_code AS INTEGER) + day(trade_date)) % 4 < 2 GROUP BY 1""")
def _(v: Views):
    """Bars with missing and with zero volumes among those that traded, and with volumes among those that did not."""
    k = (F.col("security_code").cast("int") + F.dayofmonth("trade_date")) % 4
    states = F.when(F.dayofmonth("trade_date") % 5 == 0, "NO_TRADE").when(k == 0, "TRADED").when(k == 1, "TRADED_THEN_SUSPENDED").when(k == 2, "SUSPENDED")
    return A.market_totals(v.gapped().withColumn("trading_state", states), one_a_day=True)


@query("a3_reconcile_totals", f"""WITH t AS ({TOTALS}) SELECT trade_date, CASE WHEN day(trade_date) = 4 THEN 'NOT_RECONCILABLE' WHEN day(trade_date) = 6 AND month(trade_date) <= 6 THEN 'MISMATCH' WHEN day(trade_date) = 6 THEN 'MISMATCH_WARNING' ELSE 'OK' END code FROM t""")
def _(v: Views):
    t, day = totals(v), F.dayofmonth("trade_date")
    declared = t.withColumn("total_value", F.when(day == 6, F.col("total_value") + 1).when(day != 4, F.col("total_value")))
    return A.reconcile_totals(t, declared, t.select("trade_date", (F.month("trade_date") <= 6).alias("complete")))


@query("a4_eod_readiness", "SELECT 'PARTIAL' denominator, 'PASS' price, 'PARTIAL' totals, 'PASS' queries, 'PARTIAL' overall")
def _(v: Views):
    b, t, day = v.bars(), totals(v), F.dayofmonth("trade_date")
    gaps = Q.denominator_gap(v.calendar().where("is_trading_day"), b, ["trade_date"])
    rec = A.reconcile_totals(t, t.withColumn("total_value", F.when(day != 4, F.col("total_value"))), t.select("trade_date", F.lit(True).alias("complete")))
    return A.eod_readiness(gaps, Q.ohlc_violations(b, ["security_code", "trade_date"]), rec, Q.duplicate_keys(t, ["trade_date"]))


@query("a5_benchmark_contract", """SELECT benchmark_code, trade_date, 'NOT_REGISTERED' code FROM benchmark_series WHERE benchmark_code = 'ASIA' UNION ALL SELECT benchmark_code, trade_date, 'BASIS_DIFFERS' FROM benchmark_series WHERE benchmark_code = 'EUROPE' UNION ALL SELECT benchmark_code, trade_date, 'VALUE_OUT_OF_RANGE' FROM benchmark_series WHERE benchmark_value > 3000""")
def _(v: Views):
    registry = v.spark.createDataFrame([(c, "TOTAL_RETURN_INDEX" if c == "EUROPE" else "PRICE_INDEX", "points") for c in ("BROAD", "AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST")], "benchmark_code string, basis string, unit string")
    s = v.benchmark_series().withColumn("basis", F.lit("PRICE_INDEX")).withColumn("unit", F.lit("points"))
    return A.benchmark_contract_violations(s, registry, 0.0, 3000.0)


@query("a6_comparison_readiness", """WITH c AS (SELECT benchmark_code, (SELECT count(*) FROM calendar WHERE is_trading_day) = count(*) FILTER (c.is_trading_day) complete FROM benchmark_series LEFT JOIN calendar c USING (trade_date) GROUP BY 1), r AS (SELECT 'p' || p product_id, unnest(list_distinct(['BROAD', CASE p WHEN 1 THEN 'BROAD' WHEN 2 THEN 'ASIA' ELSE 'NONE' END])) benchmark_code FROM range(1, 4) t(p))
    SELECT product_id, CASE WHEN bool_and(coalesce(complete, false)) THEN 'READY' WHEN bool_and(complete IS NOT NULL) THEN 'CONTRACT_ONLY' ELSE 'BLOCKED' END readiness FROM r LEFT JOIN c USING (benchmark_code) GROUP BY 1""")
def _(v: Views):
    rules = v.spark.createDataFrame([("p1", ["BROAD"]), ("p2", ["BROAD", "ASIA"]), ("p3", ["BROAD", "NONE"])], "product_id string, required array<string>")
    return A.comparison_readiness(Q.series_coverage(v.benchmark_series(), v.calendar(), "benchmark_code"), rules)


@query("a7_benchmark_returns", """WITH r AS (SELECT benchmark_code, trade_date, benchmark_value / lag(benchmark_value) OVER (PARTITION BY benchmark_code ORDER BY trade_date) - 1 r FROM benchmark_series), b AS (SELECT security_code, trade_date, "close" / lag("close") OVER (PARTITION BY security_code ORDER BY trade_date) - 1 r FROM bars)
    SELECT b.security_code, b.trade_date, round(b.r - m.r, 6) excess_market, round(b.r - o.r, 6) excess_sector FROM b JOIN sectors USING (security_code) JOIN r m ON m.benchmark_code = 'BROAD' AND m.trade_date = b.trade_date JOIN r o ON o.benchmark_code = sector AND o.trade_date = b.trade_date WHERE b.r IS NOT NULL AND m.r IS NOT NULL AND o.r IS NOT NULL""")
def _(v: Views):
    e = A.excess_returns(v.bars(), v.benchmark_series(), v.sectors())
    return e.select("security_code", "trade_date", F.round("excess_market", 6).alias("excess_market"), F.round("excess_sector", 6).alias("excess_sector"))


@query("a8_normalise_vendor_bars", """WITH v AS (SELECT security_code, trade_date, round("close", 8) "close", volume, CASE WHEN CAST(security_code AS INT) % 2 = 0 THEN 'APPLIED_BY_VENDOR' ELSE 'UNADJUSTED' END corporate_action_status FROM bars)
    SELECT *, CAST([] AS VARCHAR[]) codes FROM v""")
def _(v: Views):
    raw = v.bars().select("security_code", F.round("close", 8).alias("close"), F.concat((F.col("volume") / 1000).cast("decimal(18,6)").cast("string"), F.lit("K")).alias("vol"), F.date_format("trade_date", "MM/dd/yyyy").alias("d"), F.lit("1%").alias("p"), (-F.unix_date("trade_date")).alias("line"), F.when(F.col("security_code").cast("int") % 2 == 0, "ADJUSTED").otherwise("RAW").alias("price_basis"))
    return A.normalise_vendor_bars(Q.parse_vendor_numbers(raw, "vol", "p", "d"))


@query("a9_gate_matrix", """WITH c AS (SELECT substring(o_orderpriority, 1, 1) gate, CASE WHEN o_totalprice > 499500 THEN 2 WHEN o_totalprice < 1060 THEN 1 ELSE 0 END r FROM orders) SELECT gate, ['PASS', 'PARTIAL', 'BLOCKED'][max(r) + 1] status, count(*) FILTER (r > 0) open_components, count(*) components FROM c GROUP BY 1""")
def _(v: Views):
    return A.gate_matrix(v.table("orders").select(F.substring("o_orderpriority", 1, 1).alias("gate"), F.when(F.col("o_totalprice") > 499500, "BLOCKED").when(F.col("o_totalprice") < 1060, "PARTIAL").otherwise("PASS").alias("status")))


@query("a10_stop_gate_verdict", """SELECT CASE WHEN bad > 0 THEN 'STOP_BACKTEST' WHEN dates < 60 OR e < 100 THEN 'STOP_INFERENCE' ELSE 'READY_TO_SCORE' END verdict, bad, dates, e events FROM (SELECT (SELECT count(*) FROM range(0, 6) t(g) WHERE g NOT IN (SELECT r_regionkey FROM region) OR g = 2) bad), (SELECT count(DISTINCT CAST(ts AS DATE)) dates, count(*) e FROM events)""")
def _(v: Views):
    gates = v.table("region").select(F.col("r_regionkey").alias("gate"), F.when(F.col("r_regionkey") == 2, "FAIL").otherwise("PASS").alias("status"))
    required = v.spark.range(6).select(F.col("id").cast("int").alias("gate"))
    return A.stop_gate_verdict(gates, required, v.table("events").agg(F.count_distinct(F.to_date("ts")).alias("dates"), F.count("*").alias("events")), 60, 100)
