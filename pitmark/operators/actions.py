"""Corporate actions: schedules, factors, returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitmark.functions.columns import codes
from pitmark.operators.row_quality import with_codes
from pitmark.operators.temporal import resolve_as_of

_CASH = ("CASH_DIVIDEND_NORMAL", "CASH_DIVIDEND_SPECIAL")
_SHARES = ("BONUS_SHARES", "STOCK_SPLIT", "REVERSE_SPLIT")


def schedule_violations(ca: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """Dates out of order, schedules outside the query's window, ids used twice, and schedule rows that claim more than dates.

    ``identity`` (security_code, ticker, isin): rows must carry exactly these.
    Rows that state ``factor_status`` are schedule-only: no type of action, no
    factor, and pending. A schedule that only touches the window is inside it;
    OUTSIDE_WINDOW is about the ex-date, SCHEDULE_OUTSIDE_WINDOW about all dates.
    """
    c = F.col
    dates = [c(x) for x in ("cum_date", "ex_date", "record_date", "payment_date")]
    more = [((F.greatest(*dates) < c("window_from")) | (F.least(*dates) > c("window_to")), "SCHEDULE_OUTSIDE_WINDOW")]
    if "factor_status" in ca.columns:
        more += [(c("action_type") != "UNCLASSIFIED_ENTITLEMENT", "SCHEDULE_CLAIMS_TYPE"), (c("adjustment_factor").isNotNull(), "SCHEDULE_CLAIMS_FACTOR"), (~c("factor_status").eqNullSafe("pending"), "FACTOR_NOT_PENDING")]
    if identity is not None:
        ca = ca.join(identity.select("security_code", c("ticker").alias("i_ticker"), c("isin").alias("i_isin")), "security_code", "left")
        more.append((~(c("ticker").eqNullSafe(c("i_ticker")) & c("isin").eqNullSafe(c("i_isin"))) | c("i_isin").isNull(), "IDENTITY_DIFFERS"))
    twice = ca.groupBy("action_id").agg(F.count("*").alias("n")).where("n > 1").select("action_id", F.lit("DUPLICATE_ACTION_ID").alias("code"))
    return twice.unionByName(_schedule_rows(ca, more))


def _schedule_rows(ca: DataFrame, more: list[tuple[Column, str]]) -> DataFrame:
    c = F.col
    return with_codes(
        ca, ["action_id"], *more,
        (c("cum_date") >= c("ex_date"), "CUM_NOT_BEFORE_EX"), (c("ex_date") > c("record_date"), "EX_AFTER_RECORD"),
        (c("payment_date") < c("record_date"), "PAYMENT_BEFORE_RECORD"),
        ((c("ex_date") < c("window_from")) | (c("ex_date") > c("window_to")), "OUTSIDE_WINDOW"),
    )


def stable_action_id(*columns: str) -> Column:
    """``ca-schedule-`` and the first 24 hexadecimal digits of the digest of the NUL-joined key."""
    return F.concat(F.lit("ca-schedule-"), F.substring(F.sha2(F.concat_ws("\0", *[F.col(c).cast("string") for c in columns]), 256), 1, 24))


def adjustment_factors(ca: DataFrame) -> DataFrame:
    """Theoretical ex-price, factor, multipliers and how a return may use them, by formula mode and action type.

    Quotients are taken of decimals of scale 8 and rounded to 12 places. What a
    mode needs and does not have makes the row ``error``; no row is dropped.
    """
    c, dec = F.col, lambda x: x.cast("decimal(18,8)")
    over = lambda a, b: dec(a) / dec(b)
    kind, mode = c("action_type"), c("formula_mode")
    cash_kind, share_kind, rights = kind.isin(*_CASH), kind.isin(*_SHARES), kind == "RIGHTS_ISSUE"
    official, reference, mechanical = mode == "OFFICIAL_FACTOR", mode == "OFFICIAL_REFERENCE_PRICE", mode == "REPRODUCIBLE_MECHANICAL"
    whole = c("fractional_policy").isin("NOT_APPLICABLE", "EXACT_FRACTIONAL_ENTITLEMENT")
    made = F.when(cash_kind, dec(F.lit(1))).when(kind == "BONUS_SHARES", dec(1 + c("new_shares"))).when(kind.isin("STOCK_SPLIT", "REVERSE_SPLIT"), dec(c("new_shares"))).when(rights, dec(1 + c("rights_ratio")))
    quantity = F.when(official | reference, c("official_quantity")).when(mechanical, made)
    price = (
        F.when(official, c("previous_close") * c("official_factor")).when(reference, c("official_reference"))
        .when(mechanical & cash_kind, c("previous_close") - c("cash")).when(mechanical & share_kind, over(c("previous_close"), made))
        .when(mechanical & rights, over(c("previous_close") + c("rights_ratio") * c("subscription_price"), made))
    ).cast("decimal(38,18)")
    factor = F.when(official, c("official_factor").cast("decimal(38,18)")).otherwise((price.cast("decimal(30,12)") / dec(c("previous_close"))).cast("decimal(38,18)"))
    error = (
        F.when(official & c("official_factor").isNull(), "OFFICIAL_FACTOR_MISSING").when(reference & (c("previous_close").isNull() | c("official_reference").isNull()), "REFERENCE_PRICE_MISSING")
        .when(mechanical & c("previous_close").isNull(), "PREVIOUS_CLOSE_MISSING").when(mechanical & cash_kind & ~F.coalesce((c("cash") > 0) & (c("cash") < c("previous_close")), F.lit(False)), "CASH_OUT_OF_RANGE")
        .when(mechanical & share_kind & c("new_shares").isNull(), "NEW_SHARES_MISSING").when(mechanical & (((kind == "STOCK_SPLIT") & (c("new_shares") <= 1)) | ((kind == "REVERSE_SPLIT") & (c("new_shares") >= 1))), "SPLIT_RATIO_OUT_OF_RANGE")
        .when(mechanical & rights & (c("rights_ratio").isNull() | c("subscription_price").isNull()), "RIGHTS_TERMS_MISSING").when(mechanical & ~(cash_kind | share_kind | rights), "MECHANICAL_NOT_PERMITTED")
    )
    ready = F.when(mode == "NO_AUTOMATIC_FORMULA", False).when((official | reference) & cash_kind, c("cash").isNotNull()).when((official | reference) & share_kind, c("official_quantity").isNotNull()).when(mechanical & cash_kind, True).when(mechanical & share_kind, whole).otherwise(False)
    treatment = (
        F.when(mode == "NO_AUTOMATIC_FORMULA", "BLOCKED_PENDING_OFFICIAL_TERMS").when(cash_kind & (official | ready), "RAW_PRICE_PLUS_CASH_COMPONENT").when(cash_kind, "BLOCKED_MISSING_CASH_COMPONENT")
        .when(share_kind & ready, "RAW_PRICE_TIMES_QUANTITY_MULTIPLIER").when(mechanical & share_kind, "BLOCKED_FRACTIONAL_ENTITLEMENT_POLICY").when(reference & share_kind, "BLOCKED_MISSING_QUANTITY_MULTIPLIER")
        .when(mechanical & rights, "BLOCKED_RIGHTS_EXERCISE_OR_SALE_POLICY").otherwise("BLOCKED_ACTION_SPECIFIC_RETURN_POLICY")
    )
    status = F.when(error.isNotNull(), "error").when(mode == "NO_AUTOMATIC_FORMULA", "pending").when(mechanical, "reproducible").otherwise("official")
    good = lambda x: F.when(error.isNull(), x)
    return ca.select(
        *ca.columns, status.alias("factor_status"), error.alias("error_code"),
        good(F.round(price, 12)).alias("theoretical_ex_price"), good(F.when(mode != "NO_AUTOMATIC_FORMULA", F.round(factor, 12))).alias("adjustment_factor"),
        good(quantity).alias("quantity_multiplier"), good(F.when(cash_kind & (official | ready) & (mode != "NO_AUTOMATIC_FORMULA"), dec(F.lit(1))).when(share_kind & (ready | reference), quantity)).alias("return_multiplier"),
        good(F.when(mechanical & rights, dec(c("rights_ratio") * c("subscription_price")))).alias("rights_contribution"), (ready & error.isNull()).alias("return_ready"), good(treatment).alias("treatment"),
    )


def factor_ledger(factors: DataFrame) -> DataFrame:
    return factors.where("factor_status in ('official', 'reproducible')")


def policy_queue(factors: DataFrame) -> DataFrame:
    """Actions a return cannot use yet, with the reason."""
    return factors.where("not return_ready").select("action_id", "security_code", "action_type", F.coalesce("error_code", "treatment").alias("reason"))


def ledger_status(factors: DataFrame) -> DataFrame:
    """One row: counts and the overall status."""
    n = lambda test: F.sum(F.when(test, 1).otherwise(0))
    out = factors.agg(F.count("*").alias("actions"), n(F.col("factor_status").isin("official", "reproducible")).alias("accepted"), n(F.col("factor_status") == "pending").alias("pending"), n(F.col("factor_status") == "error").alias("errors"), n(~F.col("return_ready")).alias("queued"))
    return out.withColumn("status", F.when(F.col("errors") > 0, "BLOCKED").when(F.col("queued") > 0, "PARTIAL").otherwise("PASS"))


def adjusted_returns(outcomes: DataFrame) -> DataFrame:
    """Gross, benchmark, net excess and executed returns; selected rows that were not filled hold cash."""
    c = F.col
    bench = c("benchmark_exit") / c("benchmark_entry") - 1
    gross = c("exit_price") * c("factor") / c("entry_price") - 1 + c("distribution")
    cost = c("fees") + c("spread") + c("slippage") + c("impact")
    done = c("executed_exit") * c("factor") / c("executed_entry") - 1 + c("distribution")
    filled, idle = c("selected") & (c("fill_status") == "FILLED"), c("selected") & (c("fill_status") == "NOT_FILLED")
    return outcomes.select(
        *outcomes.columns, gross.alias("gross_return"), bench.alias("benchmark_return"), (gross - bench).alias("net_excess"),
        F.when(filled, done).when(idle, 0.0).alias("executed_gross"), F.when(filled, done - bench - cost).when(idle, -bench).alias("executed_net_excess"),
        F.when(c("selected") & ~filled & ~idle, "NO_FILL_DISPOSITION").alias("error_code"),
    )


def audit_integration(ca: DataFrame, master: DataFrame, calendar: DataFrame, statuses: DataFrame, bars: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each action against identity, session, status, price and benchmark of its ex-date, with one status."""
    at = ca.select("action_id", "security_code", "ex_date").distinct()
    who = resolve_as_of(at, ["action_id"], "ex_date", master, "isin").select("action_id", F.col("resolution").alias("identity"))
    state = resolve_as_of(at, ["action_id"], "ex_date", statuses, "status", "effective_from", "effective_to").select("action_id", "status")
    session = F.broadcast(calendar.select(F.col("trade_date").alias("ex_date"), "is_trading_day"))
    index = benchmark.select(F.col("trade_date").alias("ex_date"), F.lit(True).alias("has_benchmark")).distinct()
    price = bars.select("security_code", F.col("trade_date").alias("ex_date"), F.lit(True).alias("has_bar"))
    j = at.join(who, "action_id").join(state, "action_id").join(session, "ex_date", "left").join(price, ["security_code", "ex_date"], "left").join(index, "ex_date", "left")
    why = codes(
        (F.col("identity") != "MATCHED", "IDENTITY_UNRESOLVED"), (~F.coalesce("is_trading_day", F.lit(False)), "NOT_A_SESSION"), (F.col("status").isNull(), "STATUS_UNRESOLVED"),
        (F.col("status") == "DELISTED", "DELISTED_AT_EX_DATE"), (F.col("has_bar").isNull(), "NO_PRICE_ROW"), (F.col("has_benchmark").isNull(), "NO_BENCHMARK_ROW"),
    )
    blocked = F.arrays_overlap(why, F.array(F.lit("IDENTITY_UNRESOLVED"), F.lit("DELISTED_AT_EX_DATE")))
    return j.select("action_id", "security_code", why.alias("codes"), F.when(F.size(why) == 0, "PASS").when(blocked, "BLOCKED").otherwise("PARTIAL").alias("audit_status"))


def integration_metrics(audited: DataFrame, ca: DataFrame, factors: DataFrame) -> DataFrame:
    """One row over ``audit_integration``: actions by status and code, and links of actions to factor rows that are missing, several or unclaimed."""
    n = lambda s: F.count_if(F.col("audit_status") == s)
    has = lambda c: F.count_if(F.array_contains("codes", c))
    whole = audited.agg(F.count("*").alias("actions"), n("PASS").alias("passed"), n("PARTIAL").alias("partial"), n("BLOCKED").alias("blocked"), *[has(c).alias(c.lower()) for c in ("IDENTITY_UNRESOLVED", "NOT_A_SESSION", "STATUS_UNRESOLVED", "DELISTED_AT_EX_DATE", "NO_PRICE_ROW", "NO_BENCHMARK_ROW")])
    f = factors.groupBy("action_id").agg(F.count("*").alias("rows"))
    j = ca.select("action_id").distinct().withColumn("claimed", F.lit(True)).join(f, "action_id", "full_outer")
    links = j.agg(F.count_if(F.col("rows").isNull()).alias("without_factor"), F.count_if(F.col("rows") > 1).alias("several_factors"), F.count_if(F.col("claimed").isNull()).alias("factor_without_action"))
    return whole.crossJoin(links)


def policy_factor_links(policy: DataFrame, factors: DataFrame) -> DataFrame:
    """Queue rows must link to one factor row with equal key fields."""
    f = factors.select("action_id", F.col("security_code").alias("f_code"), F.col("action_type").alias("f_type"))
    n = policy.join(f, "action_id", "left").groupBy("action_id", "security_code", "action_type").agg(F.count("f_code").alias("links"), F.sum(F.when((F.col("f_code") == F.col("security_code")) & (F.col("f_type") == F.col("action_type")), 1).otherwise(0)).alias("equal"))
    code = F.when(F.col("links") == 0, "NO_FACTOR").when(F.col("links") > 1, "SEVERAL_FACTORS").when(F.col("equal") == 0, "KEY_FIELDS_DIFFER").otherwise("OK")
    return n.select("action_id", code.alias("code"))


def price_reference_violations(ca: DataFrame) -> DataFrame:
    """The reference price must be dated before the ex-date and equal the formula's input."""
    return with_codes(ca, ["action_id"], (F.col("reference_date") >= F.col("ex_date"), "REFERENCE_NOT_BEFORE_EX"), (F.col("reference_price") != F.col("previous_close"), "REFERENCE_PRICE_DIFFERS"))
