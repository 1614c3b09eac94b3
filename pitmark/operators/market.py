"""Providers, market totals, benchmarks, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import codes
from pitmark.operators.row_quality import evidence_tuple, with_codes


def merge_providers(rows: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each key whose providers agree in all values; the rest is ``agreed = false``."""
    said = F.struct(*values)
    g = rows.groupBy(*key).agg(F.count_distinct(said).alias("versions"), F.min("provider_id").alias("primary_provider"), F.min_by(said, "provider_id").alias("v"), F.array_sort(F.collect_set(F.struct("provider_id", "evidence_hash"))).alias("all"))
    supporting = F.transform(F.filter("all", lambda x: x.provider_id != F.col("primary_provider")), lambda x: x.evidence_hash)
    return g.select(*key, (F.col("versions") == 1).alias("agreed"), "primary_provider", *[F.when(F.col("versions") == 1, F.col(f"v.{c}")).alias(c) for c in values], F.array_sort(supporting).alias("supporting_hashes"))


#: States of bars that traded.
TRADED = ("TRADED", "TRADED_THEN_SUSPENDED")


def market_totals(bars: DataFrame, *, one_a_day: bool = False) -> DataFrame:
    """Securities, volume, value and trades of each day, over bars that traded.

    Those are the bars whose ``trading_state`` says so, whatever their volume;
    where bars state none, those with a volume. A missing figure adds nothing.
    ``one_a_day``: bars come from a grouping by security and day, so counting
    them counts securities; otherwise bars are grouped once more, which takes
    two more tables of all bars in the memory of the tasks.
    """
    traded = F.col("trading_state").isin(*TRADED) if "trading_state" in bars.columns else F.col("volume") > 0
    return bars.where(traded).groupBy("trade_date").agg((F.count if one_a_day else F.count_distinct)("security_code").alias("traded_securities"), F.sum("volume").alias("total_volume"), F.sum("turnover").alias("total_value"), F.sum("trade_count").alias("total_trades"))


def reconcile_totals(totals: DataFrame, declared: DataFrame, complete: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Counts exactly, value within a tolerance; on an incomplete day a mismatch warns, a blank field can't be reconciled.

    The number of trades is compared where it is declared as ``total_trades``.
    """
    trades = ["total_trades"] if "total_trades" in declared.columns else []
    d = declared.select("trade_date", *[F.col(c).alias(f"d_{c}") for c in ("traded_securities", "total_volume", "total_value", *trades)])
    j = totals.join(d, "trade_date", "full_outer").join(complete, "trade_date", "left")
    off = (F.col("traded_securities") != F.col("d_traded_securities")) | (F.col("total_volume") != F.col("d_total_volume")) | (F.abs(F.col("total_value") - F.col("d_total_value")) > tolerance)
    blank = F.col("d_traded_securities").isNull() | F.col("d_total_volume").isNull() | F.col("d_total_value").isNull()
    for c in trades:
        off, blank = off | (F.col(c) != F.col(f"d_{c}")), blank | F.col(f"d_{c}").isNull()
    code = (
        F.when(F.col("d_traded_securities").isNull() & F.col("d_total_value").isNull(), "NOT_DECLARED").when(F.col("traded_securities").isNull(), "NO_ROWS")
        .when(blank, "NOT_RECONCILABLE")
        .when(off & F.coalesce("complete", F.lit(False)), "MISMATCH").when(off, "MISMATCH_WARNING").otherwise("OK")
    )
    return j.select("trade_date", code.alias("code"))


def benchmark_contract_violations(series: DataFrame, registry: DataFrame, low: float, high: float) -> DataFrame:
    """Metadata as registered, values in range; where captures are stated, their combination with rights and registry must be legal."""
    contract = ["source_access", "rights_requirement", "registry_state"] if "capture_mode" in series.columns else []
    j = series.join(registry.select("benchmark_code", F.col("basis").alias("r_basis"), F.col("unit").alias("r_unit"), *contract), "benchmark_code", "left")
    legal = [(evidence_tuple(*map(F.col, ("capture_mode", "rights_status", *contract)))[1].isNotNull(), "EVIDENCE_TUPLE_ILLEGAL")] if contract else []
    return with_codes(
        j, ["benchmark_code", "trade_date"], *legal,
        (F.col("r_basis").isNull(), "NOT_REGISTERED"), (F.col("basis") != F.col("r_basis"), "BASIS_DIFFERS"), (F.col("unit") != F.col("r_unit"), "UNIT_DIFFERS"),
        ((F.col("benchmark_value") <= low) | (F.col("benchmark_value") > high), "VALUE_OUT_OF_RANGE"),
    )


def comparison_readiness(coverage: DataFrame, rules: DataFrame) -> DataFrame:
    """Per product: READY if every required series is complete, CONTRACT_ONLY if all exist, else BLOCKED. No series stands in for another."""
    each = rules.select("product_id", F.explode("required").alias("benchmark_code"))
    j = each.join(coverage.select("benchmark_code", (F.col("missing_dates") == 0).alias("complete")), "benchmark_code", "left")
    g = j.groupBy("product_id").agg(F.bool_and(F.coalesce("complete", F.lit(False))).alias("all_complete"), F.bool_and(F.col("complete").isNotNull()).alias("all_there"))
    return g.select("product_id", F.when(F.col("all_complete"), "READY").when(F.col("all_there"), "CONTRACT_ONLY").otherwise("BLOCKED").alias("readiness"))


def benchmark_returns(series: DataFrame) -> DataFrame:
    w = Window.partitionBy("benchmark_code").orderBy("trade_date")
    return series.select("benchmark_code", "trade_date", (F.col("benchmark_value") / F.lag("benchmark_value").over(w) - 1).alias("benchmark_return")).where("benchmark_return is not null")


def excess_returns(bars: DataFrame, series: DataFrame, sectors: DataFrame) -> DataFrame:
    """Return of each bar over the one before, less the market's and the sector's of that day."""
    w = Window.partitionBy("security_code").orderBy("trade_date")
    r = bars.select("security_code", "trade_date", (F.col("close") / F.lag("close").over(w) - 1).alias("ret")).where("ret is not null")
    b = benchmark_returns(series)
    broad = b.where("benchmark_code = 'BROAD'").select("trade_date", F.col("benchmark_return").alias("broad"))
    own = b.select(F.col("benchmark_code").alias("sector"), "trade_date", F.col("benchmark_return").alias("own"))
    j = r.join(sectors, "security_code").join(broad, "trade_date").join(own, ["sector", "trade_date"])
    return j.select("security_code", "trade_date", (F.col("ret") - F.col("broad")).alias("excess_market"), (F.col("ret") - F.col("own")).alias("excess_sector"))


def normalise_vendor_bars(raw: DataFrame) -> DataFrame:
    """Parsed vendor rows as the bar contract, with what is wrong about each export."""
    w = Window.partitionBy("security_code").orderBy("line")
    flagged = raw.withColumn("before", F.lag("date_value").over(w))
    return flagged.select(
        "security_code", F.col("date_value").alias("trade_date"), "close", F.col("volume_value").alias("volume"), F.when(F.col("price_basis") == "ADJUSTED", "APPLIED_BY_VENDOR").otherwise("UNADJUSTED").alias("corporate_action_status"),
        codes((F.col("date_value").isNull(), "DATE_UNREADABLE"), (F.col("volume_value").isNull(), "VOLUME_UNREADABLE"), (F.col("date_value") == F.col("before"), "DUPLICATE_DATE"), (F.col("date_value") > F.col("before"), "NOT_NEWEST_FIRST")).alias("codes"),
    )


def reconcile_vendor_exports(bars: DataFrame, manifest: DataFrame) -> DataFrame:
    """(export_id, code): row count and first and last date of each export against its manifest."""
    g = bars.groupBy("export_id").agg(F.count("*").alias("n_rows"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
    j = manifest.select("export_id", "row_count", "date_from", "date_to").join(g, "export_id", "full_outer")
    c = F.col
    return with_codes(
        j, ["export_id"],
        (c("row_count").isNull(), "EXPORT_NOT_IN_MANIFEST"), (c("n_rows").isNull(), "EXPORT_WITHOUT_ROWS"), (c("row_count") != c("n_rows"), "ROW_COUNT_DIFFERS"),
        (c("date_from") != c("first_date"), "FIRST_DATE_DIFFERS"), (c("date_to") != c("last_date"), "LAST_DATE_DIFFERS"),
    )


#: Fixed values, worst first.
RIGHTS_ORDER = ("UNKNOWN", "RESTRICTED", "FIXTURE_ONLY", "RESEARCH_USE_AUTHORIZED")
CLASS_ORDER = ("BLOCKED", "PARTIAL", "SYNTHETIC_ONLY", "RECORDED_AUTHORIZED_FIXTURE", "LICENSED_FEED_DEPENDENT", "LIVE_DEPENDENT", "PROVEN_REAL_EVIDENCE")


def worst_of(column: str, order: Sequence[str]) -> Column:
    """The worst value of a group; one that is not listed is worst of all."""
    return F.min_by(F.coalesce(F.col(column), F.lit("UNKNOWN")), F.struct(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.col(column)))


def gate_matrix(components: DataFrame) -> DataFrame:
    """Per gate the worst status of its components, and how many are worse than PASS.

    Where components have them, also the worst rights and the worst class of
    evidence, and the sum of each column named ``metric_...``.
    """
    more = [worst_of(c, order).alias(c) for c, order in (("rights_status", RIGHTS_ORDER), ("evidence_class", CLASS_ORDER)) if c in components.columns]
    more += [F.sum(c).alias(c) for c in components.columns if c.startswith("metric_")]
    rank = F.when(F.col("status") == "BLOCKED", 2).when(F.col("status") == "PARTIAL", 1).otherwise(0)
    g = components.groupBy("gate").agg(F.max(rank).alias("worst"), F.sum((rank > 0).cast("int")).alias("open_components"), F.count("*").alias("components"), *more)
    return g.select("gate", F.element_at(F.array(F.lit("PASS"), F.lit("PARTIAL"), F.lit("BLOCKED")), F.col("worst") + 1).alias("status"), "open_components", "components", *g.columns[4:])


def packet_status(matrix: DataFrame) -> DataFrame:
    return matrix.agg(F.when(F.bool_or(F.col("status") == "BLOCKED"), "BLOCKED").when(F.bool_or(F.col("status") == "PARTIAL"), "PARTIAL").otherwise("PASS").alias("overall"))


def stop_gate_verdict(gates: DataFrame, required: DataFrame, measured: DataFrame, min_dates: int, min_events: int) -> DataFrame:
    """STOP_BACKTEST for a missing, doubled or failed critical gate, STOP_INFERENCE for too little data, else READY_TO_SCORE."""
    n = gates.groupBy("gate").agg(F.count("*").alias("n"), F.bool_and(F.col("status") == "PASS").alias("passed"))
    bad = required.join(n, "gate", "left").agg(F.sum(F.when((F.coalesce("n", F.lit(0)) != 1) | ~F.coalesce("passed", F.lit(False)), 1).otherwise(0)).alias("bad"))
    short = (F.col("dates") < min_dates) | (F.col("events") < min_events)
    return bad.crossJoin(measured).select(F.when(F.col("bad") > 0, "STOP_BACKTEST").when(short, "STOP_INFERENCE").otherwise("READY_TO_SCORE").alias("verdict"), "bad", "dates", "events")


def eod_readiness(gaps: DataFrame, prices: DataFrame, totals: DataFrame, queries: DataFrame, errors: DataFrame | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """One row: denominator, price, totals and query status, and the worst of them.

    ``errors``: any row blocks the whole. ``evidence`` (evidence_class,
    rights_status of the rows used) adds their worst values; what is not proven
    and authorised throughout is PARTIAL at best.
    """
    one = lambda df, test, name: df.agg(F.when(F.coalesce(F.bool_or(test), F.lit(False)), "PARTIAL").otherwise("PASS").alias(name))
    j = one(gaps, F.lit(True), "denominator").crossJoin(one(prices, F.lit(True), "price")).crossJoin(one(totals, ~F.col("code").isin("OK", "MISMATCH_WARNING"), "totals")).crossJoin(one(queries, F.lit(True), "queries"))
    partial = F.array_contains(F.array("denominator", "price", "totals", "queries"), "PARTIAL")
    if evidence is not None:
        j = j.crossJoin(evidence.agg(worst_of("evidence_class", CLASS_ORDER).alias("evidence_class"), worst_of("rights_status", RIGHTS_ORDER).alias("rights_status")))
        partial = partial | ~F.col("evidence_class").eqNullSafe("PROVEN_REAL_EVIDENCE") | ~F.col("rights_status").eqNullSafe("RESEARCH_USE_AUTHORIZED")
    overall = F.when(partial, "PARTIAL").otherwise("PASS")
    if errors is not None:
        j = j.crossJoin(errors.agg(F.count("*").alias("errors")))
        overall = F.when(F.col("errors") > 0, "BLOCKED").otherwise(overall)
    return j.withColumn("overall", overall)
