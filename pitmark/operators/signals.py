"""Signals, liquidity, execution and event features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import FUTURE_TOKENS, codes, direction, signed
from pitmark.operators.events import canonical_events
from pitmark.operators.row_quality import with_codes

def series():
    """One spec for all per-security series: Spark sorts once."""
    return Window.partitionBy("security_code").orderBy("trade_date")


def _trailing(bars: DataFrame, n: int) -> DataFrame:
    """The last n bars of each security with their returns inside the window."""
    newest = F.row_number().over(Window.partitionBy("security_code").orderBy(F.desc("trade_date")))
    last = bars.withColumn("back", newest).where(F.col("back") <= n)
    return last.withColumn("ret", F.col("close") / F.lag("close").over(series()) - 1)


def strength(value: Column, scale: float) -> Column:
    return F.least(F.lit(1.0), F.abs(value) / scale)


def price_window_signals(bars: DataFrame, n: int = 20) -> DataFrame:
    """Momentum over the last n bars: return, population volatility, drawdown; at least five bars are needed."""
    g = _trailing(bars, n).groupBy("security_code").agg(
        F.count("*").alias("bars"), (F.max_by("close", "trade_date") / F.min_by("close", "trade_date") - 1).alias("trailing_return"), F.stddev_pop("ret").alias("volatility"), (F.max_by("close", "trade_date") / F.max("close") - 1).alias("drawdown"),
    )
    ok = F.col("bars") >= 5
    r = F.col("trailing_return")
    return g.select("security_code", "bars", *[F.when(ok, F.col(c)).alias(c) for c in ("trailing_return", "volatility", "drawdown")], F.when(ok, direction(r, 0.005)).alias("direction"), F.when(ok, strength(r, 0.10)).alias("strength"), F.when(ok, F.least(F.lit(1.0), 0.4 + F.col("bars") / 100)).alias("materiality"), F.when(~ok, "FEWER_THAN_FIVE_BARS").alias("code"))


def price_activity_signal(bars: DataFrame, n: int = 20) -> DataFrame:
    """The last return, stronger or weaker by the last volume against the median of earlier positive ones."""
    g = _trailing(bars, n).groupBy("security_code").agg(
        F.max_by("ret", "trade_date").alias("last_return"), F.max_by(F.struct("volume"), "trade_date").alias("v"), F.median(F.when((F.col("back") > 1) & (F.col("volume") > 0), F.col("volume"))).alias("usual"),
    )
    ratio = F.col("v.volume") / F.col("usual")
    s = strength(F.col("last_return"), 0.05)
    scaled = F.when(ratio.isNotNull(), F.least(F.lit(1.0), s * F.least(F.lit(2.0), F.greatest(F.lit(0.5), ratio)))).otherwise(s)
    return g.select("security_code", "last_return", ratio.alias("volume_ratio"), direction(F.col("last_return"), 0.002).alias("direction"), scaled.alias("strength"), F.when(ratio.isNotNull(), 0.6).otherwise(0.35).alias("materiality"))


def liquidity_signal(bars: DataFrame) -> DataFrame:
    g = bars.groupBy("security_code").agg(F.sum(F.col("volume").isNull().cast("int")).alias("missing"), F.sum(F.when(F.col("volume") == 0, 1).otherwise(0)).alias("zero"), F.count("*").alias("n"))
    ratio = (F.col("missing") + F.col("zero")) / F.col("n")
    return g.select("security_code", "missing", "zero", ratio.alias("nontrading_ratio"), F.when(ratio >= 0.20, "NEGATIVE").otherwise("NEUTRAL").alias("direction"), F.least(F.lit(1.0), ratio / 0.5).alias("strength"))


def growth(current: Column, prior: Column) -> Column:
    return F.when(F.abs(prior) >= 1e-12, current / F.abs(prior) - F.when(prior > 0, 1).otherwise(-1))


def fundamental_quality(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Six votes; positive from two thirds on, negative up to one third."""
    fields = ("revenue", "net_income", "operating_cash_flow", "total_debt", "equity")
    j = current.select("security_code", *fields).join(prior.select("security_code", *[F.col(c).alias(f"p_{c}") for c in fields]), "security_code")
    c, vote = F.col, lambda x: F.coalesce(x, F.lit(False)).cast("int")
    votes = vote(c("net_income") > 0) + vote(c("operating_cash_flow") > 0) + vote(c("operating_cash_flow") >= c("net_income")) + vote(growth(c("revenue"), c("p_revenue")) > 0) + vote(growth(c("net_income"), c("p_net_income")) > 0) + vote(F.when(c("equity") > 0, c("total_debt") / c("equity")) <= 1.5)
    return j.select("security_code", votes.alias("votes"), F.when(votes >= 4, "POSITIVE").when(votes <= 2, "NEGATIVE").otherwise("NEUTRAL").alias("direction"), (F.abs(votes / 6 - 0.5) * 2).alias("strength"))


def sentiment_signal(posts: DataFrame) -> DataFrame:
    """The most reliable post of each origin (the first of equals), weighted by reliability; two authors at least."""
    best = F.struct("reliability", -F.col("seq"))
    one = posts.groupBy("security_code", "origin_id").agg(F.max_by(F.struct("author_id", "tone", "reliability"), best).alias("b")).select("security_code", "origin_id", "b.*")
    g = one.groupBy("security_code").agg(F.count("*").alias("origins"), F.count_distinct("author_id").alias("authors"), (F.sum(F.col("tone") * F.col("reliability")) / F.nullif(F.sum("reliability"), F.lit(0.0))).alias("t"))
    t = F.coalesce("t", F.lit(0.0))
    return g.select("security_code", "origins", "authors", t.alias("weighted_tone"), F.when(F.col("authors") >= 2, direction(t, 0.10)).otherwise("NEUTRAL").alias("direction"), F.when(F.col("authors") >= 2, strength(t, 0.75)).otherwise(0.0).alias("strength"), F.least(F.lit(0.5), F.col("authors") / 10).alias("materiality"))


def liquidity_metrics(bars: DataFrame) -> DataFrame:
    """Sessions by kind, medians, and Amihud illiquidity; missing volume is not zero volume, though neither trades."""
    b = bars.withColumn("ret", F.col("close") / F.lag("close").over(series()) - 1)
    one = lambda test: F.sum(F.when(test, 1).otherwise(0))
    live = (F.col("turnover") > 0) & (F.col("volume") > 0)
    return b.groupBy("security_code").agg(
        F.count("*").alias("sessions"), one(F.col("volume") > 0).alias("traded_sessions"), one(F.col("volume").isNull()).alias("missing_volume_sessions"), one(F.col("volume") == 0).alias("zero_volume_sessions"), one(F.abs("ret") < 1e-15).alias("zero_return_sessions"),
        (one(F.coalesce("volume", F.lit(0)) == 0) / F.count("*")).alias("nontrading_ratio"), F.median(F.when(F.col("volume") > 0, F.col("volume"))).alias("median_volume"), F.median(F.when(F.col("turnover") > 0, F.col("turnover"))).alias("median_turnover"), F.avg(F.when(live, F.abs("ret") / F.col("turnover"))).alias("amihud_illiquidity"),
    )


def capped_fill(orders: DataFrame, participation: float = 0.05, fees_bps: float = 10.0, impact_bps: float = 50.0) -> DataFrame:
    """Fills of an order table joined with its session: no more than a share of the volume, at a price with impact."""
    c = F.col
    buy = c("side") == "BUY"
    quote = F.when(buy, c("ask")).otherwise(c("bid"))
    why = codes(
        (c("trading_status") != "TRADED", "TRADING_NOT_AVAILABLE"), (buy & c("upper_limit_queue"), "UPPER_LIMIT_QUEUE_NO_FILL_ASSUMPTION"), (~buy & c("lower_limit_queue"), "LOWER_LIMIT_QUEUE_NO_FILL_ASSUMPTION"),
        (c("session_volume").isNull(), "SESSION_VOLUME_MISSING"), (c("session_volume") == 0, "ZERO_SESSION_VOLUME"), (quote.isNull(), "SIDE_QUOTE_MISSING"),
    )
    may = F.size(why) == 0
    filled = F.when(may, F.least(c("quantity"), F.floor(c("session_volume") * participation))).otherwise(0)
    share = F.when(may & (filled > 0), filled / c("session_volume"))
    impact = F.when(share.isNotNull(), impact_bps / 10_000 * F.least(F.lit(1.0), share / participation))
    price = quote * (1 + impact * F.when(buy, 1).otherwise(-1))
    notional = price * filled / 1000
    status = F.when(filled <= 0, "NO_FILL").when(filled == c("quantity"), "FILLED").otherwise("PARTIAL_FILL")
    reasons = F.when(~may, why).when(filled <= 0, F.array(F.lit("PARTICIPATION_CAP_ROUNDS_TO_ZERO"))).when(filled < c("quantity"), F.array(F.lit("ORDER_EXCEEDS_PARTICIPATION_CAP"))).otherwise(F.array().cast("array<string>"))
    return orders.select("order_id", status.alias("status"), filled.cast("long").alias("filled_quantity"), price.alias("fill_price"), F.coalesce(notional, F.lit(0.0)).alias("gross_notional"), F.coalesce(notional * (fees_bps / 10_000 + impact), F.lit(0.0)).alias("estimated_cost"), reasons.alias("reasons"))


def execution_checks(quotes: DataFrame, max_age_minutes: float = 2.0) -> DataFrame:
    """Can the quote be traded on at the decision? With all reasons against it."""
    c = F.col
    minutes = lambda a, b: (F.unix_micros(c(a).cast("timestamp")) - F.unix_micros(c(b).cast("timestamp"))) / 60_000_000
    age = minutes("decision_at", "provider_as_of")
    why = codes(
        ((c("provider_as_of") > c("observed_at")) | (c("observed_at") > c("decision_at")), "EXECUTION_TIMESTAMP_ORDER"), (F.abs(c("delay_minutes") - minutes("observed_at", "provider_as_of")) > 1, "DELAY_DECLARATION_MISMATCH"), ((age < 0) | (age > max_age_minutes), "STALE_OR_FUTURE_EXECUTION_SNAPSHOT"),
        (~c("market_phase").isin("OPENING_AUCTION", "CONTINUOUS", "CLOSING_AUCTION", "TRADE_AT_LAST"), "NON_EXECUTABLE_MARKET_PHASE"), (c("trading_status") != "TRADED", "TRADING_STATUS_NOT_TRADED"),
        (c("ask") < c("bid"), "CROSSED_QUOTE"), (c("ask") / c("reference_price") >= 1.10 - 1e-12, "UPPER_LIMIT_QUEUE_OR_CENSORING"), (c("bid") / c("reference_price") <= 0.95 + 1e-12, "LOWER_LIMIT_STATE"), (c("bid").isNull() | c("ask").isNull() | c("reference_price").isNull(), "INVALID_TWO_SIDED_QUOTE"),
    )
    return quotes.select("quote_id", F.when(F.size(why) == 0, "EXECUTABLE").otherwise("DETECTED_NOT_EXECUTABLE").alias("status"), why.alias("reasons"))


def event_features(events: DataFrame, decision: Column) -> DataFrame:
    """Seven features per security in long form, from events available at the decision and inside the windows.

    Windows are cut before events are made canonical. Without any event a
    feature is unknown, not zero.
    """
    seen = events.where((F.col("first_available_at") <= decision) & (F.col("first_available_at") >= decision - F.expr("interval 30 days")))
    month = canonical_events(seen)
    week = canonical_events(seen.where(F.col("first_available_at") >= decision - F.expr("interval 7 days")))
    has = lambda *r: F.arrays_overlap("source_roles", F.array(*map(F.lit, r)))
    net, official = signed(F.col("direction")) * F.col("novelty"), F.col("official_fact_seen")
    context = ~official & has("NEWS_CONTEXT", "FINANCIAL_CONTEXT")
    m = month.groupBy("security_code").agg(F.sum(F.when(official, net).otherwise(0.0)).alias("official_event_net_30d"), F.sum(official.cast("double")).alias("official_event_count_30d"), F.sum(F.when(context, net).otherwise(0.0)).alias("context_event_net_30d"), F.size(F.array_distinct(F.flatten(F.collect_set("source_ids")))).cast("double").alias("source_diversity_30d"))
    w = week.where(has("SOCIAL")).groupBy("security_code").agg(F.sum(net).alias("s"), F.sum("diffusion_count").cast("double").alias("d"))
    names = ["official_event_net_30d", "official_event_count_30d", "context_event_net_30d", "social_event_net_7d", "social_diffusion_7d", "source_diversity_30d", "event_window_observed_30d"]
    wide = m.join(w, "security_code", "left").withColumns({"social_event_net_7d": F.coalesce("s", F.lit(0.0)), "social_diffusion_7d": F.coalesce("d", F.lit(0.0)), "event_window_observed_30d": F.lit(1.0)})
    every = events.select("security_code").distinct().join(wide, "security_code", "left")
    long = every.select("security_code", F.explode(F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(n).alias("feature_value")) for n in names])).alias("f")).select("security_code", "f.*")
    return long.withColumn("source_availability_state", F.when(F.col("feature_value").isNull(), "UNKNOWN_NOT_OBSERVED").otherwise("OBSERVED"))


def window_relation_violations(events: DataFrame, decision: Column, days: Sequence[int] = (30, 7)) -> DataFrame:
    """(event_id, window_days, code): reposts inside a window whose original is not: the window is cut before events are made canonical."""
    out = None
    for n in days:
        seen = events.where((F.col("first_available_at") <= decision) & (F.col("first_available_at") >= decision - F.expr(f"interval {n} days")))
        lost = seen.where("original_event_id is not null").join(seen.select(F.col("event_id").alias("original_event_id")).distinct(), "original_event_id", "left_anti")
        lost = lost.select("event_id", F.lit(n).alias("window_days"), F.lit("MISSING_ORIGINAL_IN_WINDOW").alias("code"))
        out = lost if out is None else out.unionByName(lost)
    return out


def feature_violations(features: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Look-ahead, late fetches, values that do not agree with their state, keys used twice, and names that tell the future.

    Where features carry ``evidence_hashes``, what is observed needs some (all
    of the ``manifest``'s sha256, if one is given) and what is unknown has none;
    ``availability_evidence_grade`` must be A, B or C for what is observed; a
    ``source_published_at`` is not after the availability.
    """
    c, key = F.col, ["decision_id", "security_code", "feature_name"]
    observed = c("source_availability_state") == "OBSERVED"
    more = [(F.lower("feature_name").rlike("|".join(FUTURE_TOKENS)), "FUTURE_NAME")]
    if "evidence_hashes" in features.columns:
        more += [(observed & (F.coalesce(F.size("evidence_hashes"), F.lit(0)) <= 0), "OBSERVED_WITHOUT_EVIDENCE"), (~observed & (F.size("evidence_hashes") > 0), "UNKNOWN_WITH_EVIDENCE")]
    if "availability_evidence_grade" in features.columns:
        more.append((observed & ~F.coalesce(c("availability_evidence_grade").isin("A", "B", "C"), F.lit(False)), "GRADE_MISSING"))
    if "source_published_at" in features.columns:
        more.append((observed & (c("source_published_at") > c("available_at")), "PUBLISHED_AFTER_AVAILABLE"))
    twice = features.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key, F.lit("DUPLICATE_KEY").alias("code"))
    if manifest is not None:
        each = features.select(*key, F.explode("evidence_hashes").alias("sha256"))
        twice = twice.unionByName(each.join(manifest.select("sha256").distinct(), "sha256", "left_anti").select(*key, F.lit("EVIDENCE_UNRESOLVED").alias("code")).distinct())
    return twice.unionByName(_feature_rows(features, key, more))


def _feature_rows(features: DataFrame, key: list[str], more: list[tuple[Column, str]]) -> DataFrame:
    c = F.col
    return with_codes(
        features, key, *more,
        (c("available_at") > c("decision_at"), "LOOK_AHEAD"), ((c("capture_mode") == "PROSPECTIVE") & (c("fetched_at") > c("decision_at")), "LATE_PROSPECTIVE_FETCH"),
        ((c("source_availability_state") == "OBSERVED") & c("feature_value").isNull(), "OBSERVED_WITHOUT_VALUE"), ((c("source_availability_state") == "UNKNOWN_NOT_OBSERVED") & c("feature_value").isNotNull(), "UNKNOWN_WITH_VALUE"),
    )


def price_findings(bars: DataFrame) -> DataFrame:
    """A finding from each security's latest bar."""
    b = bars.withColumn("chg", 100 * (F.col("close") / F.lag("close").over(series()) - 1))
    g = b.groupBy("security_code").agg(F.max("trade_date").alias("trade_date"), F.max_by("chg", "trade_date").alias("chg")).where("chg is not null")
    return g.select("security_code", "trade_date", direction(F.col("chg"), 0.05).alias("direction"), strength(F.col("chg"), 5.0).alias("strength"), strength(F.col("chg"), 3.0).alias("materiality"), F.substring(F.sha2(F.concat_ws("|", "security_code", F.col("trade_date").cast("string"), F.lit("PRICE_ACTIVITY")), 256), 1, 24).alias("finding_id"))


def classify_profiles(f: DataFrame) -> DataFrame:
    """All labels that apply."""
    c = F.col
    labels = codes(
        ((c("volatility_percentile") >= 0.75) | c("liquidity_bucket").isin("THIN", "MICRO") | c("discontinuity_flag"), "SPECULATIVE_PROFILE"),
        ((c("quality_score") >= 0.60) & (c("balance_sheet_risk") <= 0.40) & (c("cash_flow_quality") >= 0.60) & c("liquidity_bucket").isin("HIGH", "MEDIUM"), "INVESTMENT_PROFILE"),
    )
    return f.select("security_code", F.when(F.size(labels) > 0, labels).otherwise(F.array(F.lit("UNCLASSIFIED_PROFILE"))).alias("profiles"))


def decision_status(rows: DataFrame, gates: list[str], margin: float) -> DataFrame:
    """Gates, model, edge over cost, and execution make the status; reasons in order."""
    c = F.col
    why = codes(
        *[(~F.coalesce(c(g), F.lit(False)), f"{g.upper()}_GATE_FAILED") for g in sorted(gates)], (~c("model_validated"), "MODEL_NOT_PROSPECTIVELY_VALIDATED"), (c("probability").isNotNull() & ~c("probability_allowed"), "PROBABILITY_NOT_ALLOWED"),
        (c("edge").isNull() | c("cost").isNull(), "EDGE_OR_COST_MISSING"), (c("edge") <= c("cost") + margin, "EDGE_NOT_ABOVE_COST_AND_MARGIN"), (c("execution_required") & ~c("executable"), "EXECUTION_REQUIRED_AND_NOT_PASSED"),
    )
    gate = F.exists(why, lambda x: x.endswith("_GATE_FAILED") | (x == "MODEL_NOT_PROSPECTIVELY_VALIDATED"))
    status = F.when((F.size(why) == 0) & c("executable"), "HIGH_BUY_OPPORTUNITY").when(F.size(why) == 0, "QUALIFIED_RESEARCH_NOT_YET_EXECUTABLE").when(gate, "WATCH").otherwise("ABSTAIN")
    return rows.select("security_code", status.alias("status"), why.alias("reasons"))
