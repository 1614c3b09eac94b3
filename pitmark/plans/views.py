"""Domain inputs derived from the test tables, as DataFrames and as SQL for the oracle.

The same derivation is written twice on purpose, so that the oracle does not
depend on Spark. Nothing is random and nothing depends on the current time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Views:
    """The derived inputs of one folder of tables; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def bars(self) -> DataFrame:
        """Daily bars: one row per security (supplier) and day."""
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").cast("string").alias("security_code"), F.to_date("l_shipdate").alias("trade_date"))
            .agg(
                F.min_by(unit, order).alias("open"), F.max(unit).alias("high"), F.min(unit).alias("low"), F.max_by(unit, order).alias("close"),
                F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("turnover"), F.count("*").alias("trade_count"),
            )
        )

    def gapped(self) -> DataFrame:
        """Bars with missing volume on the 13th and none on the 27th."""
        day = F.dayofmonth("trade_date")
        return self.bars().withColumn("volume", F.when(day == 27, F.lit(0.0)).when(day != 13, F.col("volume")))

    def provider_rows(self) -> DataFrame:
        """Bars of two providers; the second disagrees for every 17th security."""
        bars = self.bars().select("security_code", "trade_date", "close", "volume")
        other = bars.withColumn("close", F.when(F.col("security_code").cast("int") % 17 == 0, F.col("close") + 1).otherwise(F.col("close")))
        both = bars.withColumn("provider_id", F.lit("A")).unionByName(other.where(F.dayofmonth("trade_date") % 2 == 0).withColumn("provider_id", F.lit("B")))
        return both.withColumn("evidence_hash", F.sha2(F.concat_ws("|", "provider_id", "security_code", F.col("trade_date").cast("string")), 256))

    def calendar(self) -> DataFrame:
        """Every civil day from the first to the last bar."""
        span = self.table("lineitem").agg(F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b"))
        days = span.select(F.explode(F.sequence("a", "b")).alias("trade_date"))
        kind = F.when((F.dayofmonth("trade_date") == 1) & (F.month("trade_date") == 1), "HOLIDAY").when(F.dayofweek("trade_date").isin(6, 7), "WEEKEND").otherwise("NORMAL")
        return days.withColumn("session_type", kind).withColumn("is_trading_day", F.col("session_type") == "NORMAL")

    def sectors(self) -> DataFrame:
        """The region of each security."""
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        return s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").cast("string").alias("security_code"), F.col("r_name").alias("sector"))

    def benchmark_series(self) -> DataFrame:
        """Turnover-weighted price of the market and of each sector by day."""
        bars = self.bars().join(self.sectors(), "security_code")
        parts = bars.select("trade_date", "volume", "turnover", F.explode(F.array(F.lit("BROAD"), F.col("sector"))).alias("benchmark_code"))
        return parts.groupBy("benchmark_code", "trade_date").agg((F.sum("turnover") / F.sum("volume")).alias("benchmark_value"))

    def identity(self) -> DataFrame:
        """Identity intervals of customers; a second, overlapping one for every 50th."""
        span = self.table("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("valid_from"), F.to_date(F.max("o_orderdate")).alias("last"))
        base = span.select(F.col("o_custkey").cast("string").alias("security_code"), F.lit("MAIN").alias("board"), F.concat(F.lit("ISIN"), (F.col("o_custkey") % 400).cast("string")).alias("isin"), "valid_from", F.when(F.col("o_custkey") % 3 != 0, F.col("last")).alias("valid_to"))
        extra = base.where("cast(security_code as int) % 50 = 0").withColumn("valid_from", F.date_add("valid_from", 10)).withColumn("board", F.lit("MAIN"))
        return base.unionByName(extra)

    def notices(self) -> DataFrame:
        """One status notice per customer and day."""
        o = self.table("orders")
        event = F.element_at(F.create_map(*[F.lit(x) for p in (("1", "SUSPEND"), ("2", "RESUME"), ("3", "DELIST"), ("4", "RELIST"), ("5", "SUSPEND")) for x in p]), F.substring("o_orderpriority", 1, 1))
        first = o.groupBy(F.col("o_custkey").cast("string").alias("security_code"), F.to_date("o_orderdate").alias("effective_date")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"), F.min("o_orderkey").alias("notice_id"))
        return first.select("security_code", "effective_date", "notice_id", event.alias("event_type"))

    def actions(self) -> DataFrame:
        """Corporate actions with their terms, one per part."""
        kinds = ["CASH_DIVIDEND_NORMAL", "BONUS_SHARES", "STOCK_SPLIT", "REVERSE_SPLIT", "RIGHTS_ISSUE", "MERGER"]
        kind = F.element_at(F.array(*map(F.lit, kinds)), F.col("p_size") % 6 + 1)
        mode = F.when(kind == "MERGER", "NO_AUTOMATIC_FORMULA").when(F.col("p_partkey") % 10 == 3, "OFFICIAL_FACTOR").when(F.col("p_partkey") % 10 == 4, "OFFICIAL_REFERENCE_PRICE").otherwise("REPRODUCIBLE_MECHANICAL")
        dec = lambda c: c.cast("decimal(18,8)")
        size, base = F.col("p_size"), F.lit("2024-01-01").cast("date")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("action_id"), (F.col("p_partkey") % 100).cast("string").alias("security_code"), kind.alias("action_type"), mode.alias("formula_mode"),
            dec(F.col("p_retailprice")).alias("previous_close"), F.when(kind.startswith("CASH"), dec(size)).alias("cash"),
            F.when(kind == "BONUS_SHARES", dec(size / 100)).when(kind == "STOCK_SPLIT", dec(size + 1)).when(kind == "REVERSE_SPLIT", dec(F.lit(0.5))).alias("new_shares"),
            F.when(kind == "RIGHTS_ISSUE", dec(size / 50)).alias("rights_ratio"), F.when(kind == "RIGHTS_ISSUE", dec(F.lit(60))).alias("subscription_price"),
            F.when(mode == "OFFICIAL_FACTOR", dec(F.lit(0.9))).alias("official_factor"), F.when(mode == "OFFICIAL_REFERENCE_PRICE", dec(F.col("p_retailprice") - 5)).alias("official_reference"),
            F.when((mode == "OFFICIAL_FACTOR") & (F.col("p_partkey") % 20 == 3), dec(F.lit(2))).alias("official_quantity"),
            F.when(F.col("p_partkey") % 7 == 0, "FRACTIONAL_POLICY_UNKNOWN").otherwise("NOT_APPLICABLE").alias("fractional_policy"),
            F.date_add(base, size).alias("cum_date"), F.date_add(base, size + 1).alias("ex_date"), F.date_add(base, size + F.when(F.col("p_partkey") % 13 == 0, -1).otherwise(2)).alias("record_date"), F.when(size % 2 == 0, F.date_add(base, size + 20)).alias("payment_date"),
        )

    def events(self) -> DataFrame:
        """Events with relations: every tenth repeats the one before, where the security is the same."""
        e = self.table("events")
        code = (F.col("user_id") % 20).cast("string")
        prev = e.select((F.col("event_id") + 1).alias("event_id"), (F.col("user_id") % 20).cast("string").alias("prev_code"))
        out = e.join(prev, "event_id", "left").withColumn("security_code", code)
        parent = F.when((F.col("event_id") % 10 == 7) & (F.col("prev_code") == F.col("security_code")), F.col("event_id") - 1)
        return out.select(
            "event_id", "security_code", F.col("event_type").alias("source_id"),
            F.when(F.col("event_type") == "purchase", "PRIMARY_OFFICIAL").when(F.col("event_type") == "view", "NEWS_CONTEXT").when(F.col("event_type") == "click", "SOCIAL").otherwise("FINANCIAL_CONTEXT").alias("source_role"),
            F.element_at(F.array(F.lit("POSITIVE"), F.lit("NEGATIVE"), F.lit("NEUTRAL")), (F.col("event_id") % 3 + 1).cast("int")).alias("direction"),
            F.round(F.col("value") / 1000, 6).alias("novelty"), F.col("ts").alias("event_at"), (F.col("ts") - F.expr("interval 5 minutes")).alias("published_at"), F.col("ts").alias("first_available_at"), (F.col("ts") + F.expr("interval 10 minutes")).alias("captured_at"),
            F.regexp_extract("props", r"(\d+)", 1).alias("content_hash"), F.concat(F.lit("o"), (F.col("event_id") % 997).cast("string")).alias("origin_id"), parent.alias("original_event_id"), "user_id", "value",
        )

    def findings(self) -> DataFrame:
        """Claims: documents blocked by language; kind and direction follow from the first words, so copies share them."""
        d = self.table("documents")
        word = lambda n: F.length(F.regexp_extract(F.coalesce("text", F.lit("")), rf"^[ \t\n]*(?:[^ \t\n]+[ \t\n]+){{{n}}}([^ \t\n]+)", 1))
        cls = F.element_at(F.array(F.lit("PRIMARY"), F.lit("NEWS"), F.lit("COMMUNITY")), (F.col("doc_id") % 3 + 1).cast("int"))
        return d.select(
            F.col("doc_id").alias("finding_id"), F.col("lang").alias("security_code"), F.col("source").alias("publisher_group"), cls.alias("source_class"),
            F.element_at(F.array(F.lit("CATALYST"), F.lit("TECHNICAL"), F.lit("SENTIMENT"), F.lit("FUNDAMENTAL")), word(0) % 4 + 1).alias("signal_kind"),
            F.element_at(F.array(F.lit("POSITIVE"), F.lit("NEGATIVE"), F.lit("NEUTRAL")), word(1) % 3 + 1).alias("direction"),
            F.least(F.lit(1.0), F.round(F.col("n_chars") / 2000, 4)).alias("strength"), F.round((F.col("doc_id") % 10) / 10, 4).alias("materiality"),
            (F.col("doc_id") % 300).cast("string").alias("event_key"), (F.col("doc_id") % 700).cast("string").alias("origin_id"), F.col("text").alias("claim_text"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=(F.col("doc_id") % 500).cast("int"))).alias("available_at"), "lang",
        )

    def posts(self) -> DataFrame:
        e = self.table("events")
        tone = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("value") - 50) / 500))
        return e.select((F.col("user_id") % 20).cast("string").alias("security_code"), F.regexp_extract("props", r"(\d+)", 1).alias("origin_id"), F.col("user_id").cast("string").alias("author_id"), tone.alias("tone"), ((F.col("user_id") % 10) / 10).alias("reliability"), F.col("event_id").alias("seq"))

    def predictions(self) -> DataFrame:
        d, lab = self.table("documents"), self.table("labels")
        return d.join(lab, "doc_id").select("doc_id", F.col("source").alias("decision_id"), F.least(F.lit(1.0), F.col("n_chars") / 5000).alias("probability"), F.col("quality").alias("label"))

    def outcomes(self) -> DataFrame:
        """Month-end decisions: trailing return as score, next bar's return as outcome."""
        from pyspark.sql.window import Window

        w = Window.partitionBy("security_code").orderBy("trade_date")
        b = self.bars().select("security_code", "trade_date", (F.col("close") / F.lag("close", 20).over(w) - 1).alias("score"), (F.lead("close").over(w) / F.col("close") - 1).alias("outcome"), F.row_number().over(Window.partitionBy("security_code", F.date_trunc("month", "trade_date")).orderBy(F.desc("trade_date"))).alias("last"))
        return b.where("last = 1 and score is not null and outcome is not null").select(F.date_format("trade_date", "yyyy-MM").alias("decision_id"), "security_code", F.round("score", 8).alias("score"), F.round("outcome", 8).alias("outcome"))

    def ledger(self) -> DataFrame:
        """Turns of conversations as a hash chain, broken in every eleventh."""
        from pyspark.sql.window import Window

        w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
        c = self.table("conversations").select(F.col("conv_id").alias("ledger_id"), F.col("conv_id").alias("conv_id"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
        own = lambda t: F.sha2(F.concat_ws("|", F.col("conv_id").cast("string"), t), 256)
        n = F.row_number().over(w)
        c = c.select("ledger_id", n.alias("seq"), own(F.col("text")).alias("event_hash"), F.lag("text").over(w).alias("before"), "conv_id")
        prev = F.when((F.col("conv_id") % 11 == 0) & (F.col("seq") == 2), F.lit("broken")).otherwise(own(F.col("before")))
        return c.select("ledger_id", "seq", "event_hash", F.when(F.col("before").isNotNull(), prev).alias("previous_hash"))

    def attempts(self) -> DataFrame:
        return self.table("events").select(F.col("user_id").alias("route_id"), "event_id", "ts", F.when(F.col("event_type") == "purchase", "COMPLETE").when(F.col("event_type") == "error", "FAILED").otherwise("RETRY").alias("state"), (F.col("user_id") % 10).alias("source_id"), F.col("value").alias("items"))


#: The same views for DuckDB. {view} names another view.
SQL = {
    "bars": """SELECT CAST(l_suppkey AS VARCHAR) security_code, CAST(l_shipdate AS DATE) trade_date,
        arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) "open", max(l_extendedprice / l_quantity) high, min(l_extendedprice / l_quantity) low,
        arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) "close", sum(l_quantity) volume, sum(l_extendedprice) turnover, count(*) trade_count FROM lineitem GROUP BY ALL""",
    "gapped": """SELECT * REPLACE (CASE WHEN day(trade_date) = 27 THEN 0.0 WHEN day(trade_date) <> 13 THEN volume END AS volume) FROM bars""",
    "provider_rows": """SELECT *, sha256(concat_ws('|', provider_id, security_code, CAST(trade_date AS VARCHAR))) evidence_hash FROM (
        SELECT security_code, trade_date, "close", volume, 'A' provider_id FROM bars UNION ALL
        SELECT security_code, trade_date, CASE WHEN CAST(security_code AS INT) % 17 = 0 THEN "close" + 1 ELSE "close" END, volume, 'B' FROM bars WHERE day(trade_date) % 2 = 0)""",
    "calendar": """SELECT trade_date, session_type, session_type = 'NORMAL' is_trading_day FROM (SELECT trade_date, CASE WHEN day(trade_date) = 1 AND month(trade_date) = 1 THEN 'HOLIDAY' WHEN dayofweek(trade_date) IN (5, 6) THEN 'WEEKEND' ELSE 'NORMAL' END session_type FROM (
        SELECT CAST(unnest(generate_series((SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem), (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem), INTERVAL 1 DAY)) AS DATE) trade_date))""",
    "sectors": """SELECT CAST(s_suppkey AS VARCHAR) security_code, r_name sector FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "benchmark_series": """SELECT benchmark_code, trade_date, sum(turnover) / sum(volume) benchmark_value FROM (SELECT trade_date, volume, turnover, unnest(['BROAD', sector]) benchmark_code FROM bars JOIN sectors USING (security_code)) GROUP BY ALL""",
    "identity_base": """SELECT CAST(o_custkey AS VARCHAR) security_code, 'MAIN' board, 'ISIN' || (o_custkey % 400) isin, CAST(min(o_orderdate) AS DATE) valid_from, CASE WHEN o_custkey % 3 <> 0 THEN CAST(max(o_orderdate) AS DATE) END valid_to FROM orders GROUP BY o_custkey""",
    "identity": """SELECT * FROM identity_base UNION ALL SELECT * REPLACE (valid_from + 10 AS valid_from) FROM identity_base WHERE CAST(security_code AS INT) % 50 = 0""",
    "notices": """SELECT security_code, effective_date, notice_id, CASE substring(p, 1, 1) WHEN '1' THEN 'SUSPEND' WHEN '2' THEN 'RESUME' WHEN '3' THEN 'DELIST' WHEN '4' THEN 'RELIST' ELSE 'SUSPEND' END event_type FROM (
        SELECT CAST(o_custkey AS VARCHAR) security_code, CAST(o_orderdate AS DATE) effective_date, min(o_orderkey) notice_id, arg_min(o_orderpriority, o_orderkey) p FROM orders GROUP BY ALL)""",
    "actions": """SELECT action_id, security_code, action_type, formula_mode, previous_close,
        CASE WHEN action_type LIKE 'CASH%' THEN CAST(p_size AS DECIMAL(18,8)) END cash,
        CASE action_type WHEN 'BONUS_SHARES' THEN CAST(p_size / 100 AS DECIMAL(18,8)) WHEN 'STOCK_SPLIT' THEN CAST(p_size + 1 AS DECIMAL(18,8)) WHEN 'REVERSE_SPLIT' THEN CAST(0.5 AS DECIMAL(18,8)) END new_shares,
        CASE WHEN action_type = 'RIGHTS_ISSUE' THEN CAST(p_size / 50 AS DECIMAL(18,8)) END rights_ratio, CASE WHEN action_type = 'RIGHTS_ISSUE' THEN CAST(60 AS DECIMAL(18,8)) END subscription_price,
        CASE WHEN formula_mode = 'OFFICIAL_FACTOR' THEN CAST(0.9 AS DECIMAL(18,8)) END official_factor, CASE WHEN formula_mode = 'OFFICIAL_REFERENCE_PRICE' THEN CAST(p_retailprice - 5 AS DECIMAL(18,8)) END official_reference,
        CASE WHEN formula_mode = 'OFFICIAL_FACTOR' AND p_partkey % 20 = 3 THEN CAST(2 AS DECIMAL(18,8)) END official_quantity,
        CASE WHEN p_partkey % 7 = 0 THEN 'FRACTIONAL_POLICY_UNKNOWN' ELSE 'NOT_APPLICABLE' END fractional_policy,
        DATE '2024-01-01' + p_size cum_date, DATE '2024-01-01' + (p_size + 1) ex_date, DATE '2024-01-01' + (p_size + CASE WHEN p_partkey % 13 = 0 THEN -1 ELSE 2 END) record_date, CASE WHEN p_size % 2 = 0 THEN DATE '2024-01-01' + (p_size + 20) END payment_date
        FROM (SELECT *, CASE WHEN action_type = 'MERGER' THEN 'NO_AUTOMATIC_FORMULA' WHEN p_partkey % 10 = 3 THEN 'OFFICIAL_FACTOR' WHEN p_partkey % 10 = 4 THEN 'OFFICIAL_REFERENCE_PRICE' ELSE 'REPRODUCIBLE_MECHANICAL' END formula_mode FROM (
        SELECT *, CAST(p_partkey AS VARCHAR) action_id, CAST(p_partkey % 100 AS VARCHAR) security_code, CAST(p_retailprice AS DECIMAL(18,8)) previous_close,
        ['CASH_DIVIDEND_NORMAL', 'BONUS_SHARES', 'STOCK_SPLIT', 'REVERSE_SPLIT', 'RIGHTS_ISSUE', 'MERGER'][p_size % 6 + 1] action_type FROM part))""",
    "ev": """SELECT e.event_id, CAST(e.user_id % 20 AS VARCHAR) security_code, e.event_type source_id,
        CASE e.event_type WHEN 'purchase' THEN 'PRIMARY_OFFICIAL' WHEN 'view' THEN 'NEWS_CONTEXT' WHEN 'click' THEN 'SOCIAL' ELSE 'FINANCIAL_CONTEXT' END source_role,
        ['POSITIVE', 'NEGATIVE', 'NEUTRAL'][e.event_id % 3 + 1] direction, round(e.value / 1000, 6) novelty, e.ts event_at, e.ts - INTERVAL 5 MINUTE published_at, e.ts first_available_at, e.ts + INTERVAL 10 MINUTE captured_at,
        regexp_extract(e.props, '(\\d+)', 1) content_hash, 'o' || (e.event_id % 997) origin_id, CASE WHEN e.event_id % 10 = 7 AND p.user_id % 20 = e.user_id % 20 THEN e.event_id - 1 END original_event_id, e.user_id, e.value
        FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1""",
    "findings": r"""SELECT doc_id finding_id, lang security_code, source publisher_group, ['PRIMARY', 'NEWS', 'COMMUNITY'][doc_id % 3 + 1] source_class, ['CATALYST', 'TECHNICAL', 'SENTIMENT', 'FUNDAMENTAL'][length(regexp_extract(coalesce(text, ''), '^[ \t\n]*([^ \t\n]+)', 1)) % 4 + 1] signal_kind,
        ['POSITIVE', 'NEGATIVE', 'NEUTRAL'][length(regexp_extract(coalesce(text, ''), '^[ \t\n]*(?:[^ \t\n]+[ \t\n]+){1}([^ \t\n]+)', 1)) % 3 + 1] direction, least(1.0, round(n_chars / 2000, 4)) strength, round((doc_id % 10) / 10, 4) materiality, CAST(doc_id % 300 AS VARCHAR) event_key, CAST(doc_id % 700 AS VARCHAR) origin_id, text claim_text,
        TIMESTAMP '2024-01-01' + to_hours(doc_id % 500) available_at, lang FROM documents""",
    "posts": """SELECT CAST(user_id % 20 AS VARCHAR) security_code, regexp_extract(props, '(\\d+)', 1) origin_id, CAST(user_id AS VARCHAR) author_id, greatest(-1.0, least(1.0, (value - 50) / 500)) tone, (user_id % 10) / 10 reliability, event_id seq FROM events""",
    "predictions": """SELECT doc_id, source decision_id, least(1.0, n_chars / 5000) probability, quality "label" FROM documents JOIN labels USING (doc_id)""",
    "outcomes": """SELECT strftime(trade_date, '%Y-%m') decision_id, security_code, round(score, 8) score, round(outcome, 8) outcome FROM (
        SELECT security_code, trade_date, "close" / lag("close", 20) OVER w - 1 score, lead("close") OVER w / "close" - 1 outcome, row_number() OVER (PARTITION BY security_code, date_trunc('month', trade_date) ORDER BY trade_date DESC) r FROM bars WINDOW w AS (PARTITION BY security_code ORDER BY trade_date))
        WHERE r = 1 AND score IS NOT NULL AND outcome IS NOT NULL""",
    "ledger": """SELECT conv_id ledger_id, seq, sha256(conv_id || '|' || t) event_hash, CASE WHEN b IS NOT NULL THEN CASE WHEN conv_id % 11 = 0 AND seq = 2 THEN 'broken' ELSE sha256(conv_id || '|' || b) END END previous_hash FROM (
        SELECT conv_id, coalesce(text, '') t, row_number() OVER w seq, lag(coalesce(text, '')) OVER w b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, coalesce(text, '')))""",
    "attempts": """SELECT user_id route_id, event_id, ts, CASE event_type WHEN 'purchase' THEN 'COMPLETE' WHEN 'error' THEN 'FAILED' ELSE 'RETRY' END state, user_id % 10 source_id, value items FROM events""",
}


def with_views(body: str) -> str:
    """``body`` behind a WITH clause that holds the views it names, and theirs."""
    used: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if re.search(rf"\b{name}\b", text) and name not in used:
                need(SQL[name])
                used.append(name)

    need(body)
    ctes = [f"{n} AS MATERIALIZED ({SQL[n]})" for n in used]
    own = body.lstrip()
    if own[:5].upper() == "WITH ":
        recursive = own[5:15].upper() == "RECURSIVE "
        return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join([*ctes, own[15:] if recursive else own[5:]])
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + own
