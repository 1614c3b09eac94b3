"""Evaluation of forecasts: outcomes, rank correlation, hits, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import codes, wilson
from pitmark.operators.row_quality import with_codes


def join_outcomes(predictions: DataFrame, outcomes: DataFrame, ledger: DataFrame, key: Sequence[str], same: Sequence[str]) -> DataFrame:
    """The full denominator of predictions, outcomes and recorded forecasts, with what does not agree."""
    side = lambda df, x, cols: df.select(*key, *[F.col(c).alias(f"{x}_{c}") for c in cols], F.lit(True).alias(f"in_{x}"))
    j = side(predictions, "p", same).join(side(outcomes, "o", []), list(key), "full_outer").join(side(ledger, "l", same), list(key), "full_outer")
    why = codes((F.col("in_p").isNull(), "NO_PREDICTION"), (F.col("in_o").isNull(), "NO_OUTCOME"), (F.col("in_l").isNull(), "NOT_RECORDED"), *[(F.col("in_p") & F.col("in_l") & ~F.col(f"p_{c}").eqNullSafe(F.col(f"l_{c}")), f"{c.upper()}_DIFFERS") for c in same])
    return j.select(*key, why.alias("codes"))


def average_rank(group: Sequence[str], column: str) -> Column:
    """Rank within a group with ties at their mean."""
    up = Window.partitionBy(*group).orderBy(column)
    ties = Window.partitionBy(*group, column)
    return F.rank().over(up) + (F.count("*").over(ties) - 1) / 2


def rank_ic(rows: DataFrame, group: str = "decision_id", score: str = "score", outcome: str = "outcome") -> DataFrame:
    """Spearman correlation of each decision; null where a side is constant."""
    r = rows.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).select(group, average_rank([group], score).alias("a"), average_rank([group], outcome).alias("b"))
    g = r.groupBy(group).agg(F.count("*").alias("n"), F.covar_pop("a", "b").alias("ab"), (F.stddev_pop("a") * F.stddev_pop("b")).alias("spread"))
    return g.select(group, "n", F.try_divide("ab", "spread").alias("rank_ic"))


def precision_recall_at_k(rows: DataFrame, k: int) -> DataFrame:
    """Per decision with a selection: positives among the selected, and selected among the realised best k."""
    best = F.row_number().over(Window.partitionBy("decision_id").orderBy(F.desc("outcome"), "security_code"))
    r = rows.withColumn("best", best <= k)
    g = r.groupBy("decision_id").agg(F.sum(F.col("selected").cast("int")).alias("n_selected"), F.sum((F.col("selected") & F.col("positive")).cast("int")).alias("hits"), F.sum((F.col("selected") & F.col("best")).cast("int")).alias("found"), F.sum(F.col("best").cast("int")).alias("n_best"))
    return g.where("n_selected > 0").select("decision_id", "n_selected", "hits", (F.col("hits") / F.col("n_selected")).alias("precision"), (F.col("found") / F.col("n_best")).alias("recall"))


def brier(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return rows.where("probability is not null and label is not null").groupBy(*group).agg(F.count("*").alias("n"), F.avg(F.pow(F.col("probability") - F.col("label"), 2)).alias("brier"))


def event_labels(rows: DataFrame) -> DataFrame:
    c = F.col
    label = F.when(c("target_rule") == "NET_EXCESS_GT_0", c("net_excess") > 0).when(c("target_rule") == "GROSS_GE_5", c("gross") >= 0.05).when(c("target_rule") == "GROSS_GE_10", c("gross") >= 0.10).when(c("target_rule") == "TOTAL_AND_EXCESS", (c("gross") > 0) & (c("net_excess") > 0))
    return rows.withColumn("label", label.cast("int"))


def forecast_metrics(rows: DataFrame, min_dates: int) -> DataFrame:
    """One row: coverage, abstention, non-fills, mean net excess of the selected; the verdict stands beside the numbers."""
    share = lambda test: F.avg(test.cast("double"))
    g = rows.agg(F.count("*").alias("n"), F.count_distinct("decision_id").alias("dates"), share(~F.col("abstained")).alias("coverage"), share(F.col("abstained")).alias("abstention"), F.avg(F.when(F.col("selected"), (F.col("fill_status") == "NOT_FILLED").cast("double"))).alias("non_fill_rate"), F.avg(F.when(F.col("selected"), F.col("net_excess"))).alias("mean_net_excess"))
    return g.withColumn("status", F.when(F.col("dates") < min_dates, "STOP_INFERENCE").otherwise("MEASURED"))


def replay_returns(rows: DataFrame) -> DataFrame:
    """Adjusted gross return; what was selected is charged fees, spread and slippage on its executed prices, unadjusted."""
    c = F.col
    gross = c("exit_price") * c("factor") / c("entry_price") - 1 + c("distribution")
    net = F.when(c("selected"), c("executed_exit") / c("executed_entry") - 1 - c("fees") - c("spread") - c("slippage")).otherwise(gross)
    return rows.select(*rows.columns, gross.alias("gross"), net.alias("net"), (gross > 0).alias("gross_up"), (net > 0).alias("net_up"), (gross > c("benchmark_return")).alias("beats_market"), (gross > c("sector_return")).alias("beats_sector"))


def replay_metrics(rows: DataFrame, k: int) -> DataFrame:
    """One row: hits with their Wilson interval, top-1 hits, recall at k and mean rank correlation.

    Where rows have ``market_excess`` and ``sector_excess``: the mean rank
    correlation with each of them too, and the share of selected rows above 0.
    """
    pr = precision_recall_at_k(rows, k).agg(F.sum("hits").alias("hits"), F.sum("n_selected").alias("n"), F.avg("recall").alias("recall_at_k"), F.count("*").alias("decisions"))
    first = F.row_number().over(Window.partitionBy("decision_id").orderBy(F.desc("score"), "security_code"))
    top = rows.withColumn("first", first).where("first = 1").agg(F.sum(F.col("positive").cast("int")).alias("top1_hits"))
    ic = rank_ic(rows).agg(F.avg("rank_ic").alias("mean_rank_ic"), F.count("rank_ic").alias("effective_decisions"))
    for name in ("market", "sector"):
        if f"{name}_excess" in rows.columns:
            other = rank_ic(rows.withColumn("outcome", F.col(f"{name}_excess"))).agg(F.avg("rank_ic").alias(f"mean_{name}_rank_ic"), F.count("rank_ic").alias(f"{name}_rank_ic_decisions"))
            above = rows.where("selected").agg(F.avg((F.col(f"{name}_excess") > 0).cast("double")).alias(f"{name}_excess_rate")) if "selected" in rows.columns else None
            ic = ic.crossJoin(other) if above is None else ic.crossJoin(other).crossJoin(above)
    lo, hi = wilson(F.col("hits"), F.col("n"))
    return pr.crossJoin(top).crossJoin(ic).withColumns({"hit_rate": F.col("hits") / F.col("n"), "wilson_low": lo, "wilson_high": hi})


def purge_embargo(train: DataFrame, test: DataFrame, embargo: str | None = None) -> DataFrame:
    """Training samples with ``kept``: the label ended before the first test cutoff. An embargo removes nothing more."""
    first = test.agg(F.min("feature_cutoff").alias("first_cutoff"))
    return train.crossJoin(F.broadcast(first)).select(*train.columns, F.coalesce(F.col("label_end") < F.col("first_cutoff"), F.lit(False)).alias("kept"))


def causal_leaks(train: DataFrame, test: DataFrame) -> DataFrame:
    return purge_embargo(train, test).where("not kept").drop("kept")


def pit_row_violations(rows: DataFrame) -> DataFrame:
    c = F.col
    return with_codes(
        rows, ["decision_id", "security_code"],
        *[(c(f"{x}_available_at") > c("decision_at"), f"{x.upper()}_AFTER_DECISION") for x in ("identity", "sector", "feature", "score")],
        (c("outcome_observed_at") < c("session_close"), "OUTCOME_BEFORE_SESSION_CLOSE"), (c("decision_at") > c("session_close"), "DECISION_AFTER_SESSION_CLOSE"),
    )


def metric_identity_violations(metrics: DataFrame) -> DataFrame:
    """Recorded metrics that contradict themselves or the recomputed interval."""
    c = F.col
    lo, hi = wilson(c("hits"), c("denominator"))
    return with_codes(
        metrics, ["metric_id"],
        (c("hits") > c("denominator"), "HITS_EXCEED_DENOMINATOR"), (F.abs(c("rate") - c("hits") / c("denominator")) > 1e-12, "RATE_DIFFERS"),
        ((F.abs(c("wilson_low") - lo) > 1e-9) | (F.abs(c("wilson_high") - hi) > 1e-9), "WILSON_DIFFERS"), (F.abs(c("rank_ic")) > 1, "RANK_IC_OUT_OF_RANGE"),
    )
