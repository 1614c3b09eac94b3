"""Row contracts: every rule yields codes as data, no rule drops a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import FUTURE_TOKENS, codes, credential_keys, folded, host


def with_codes(df: DataFrame, key: Sequence[str], *rules: tuple[Column, str]) -> DataFrame:
    """(key..., code) for each rule that holds on a row."""
    return df.select(*key, F.explode(codes(*rules)).alias("code"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def ohlc_violations(bars: DataFrame, key: Sequence[str]) -> DataFrame:
    return with_codes(
        bars, key,
        (F.col("high") < F.greatest("open", "close", "low"), "HIGH_BELOW_PRICES"),
        (F.col("low") > F.least("open", "close", "high"), "LOW_ABOVE_PRICES"),
        (F.least("open", "high", "low", "close") <= 0, "NON_POSITIVE_PRICE"),
    )


def state_activity_violations(bars: DataFrame, key: Sequence[str]) -> DataFrame:
    """A traded row needs positive activity; any other has no prices and no activity."""
    traded = F.col("trading_state") == "TRADED"
    blank = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    none = lambda c: F.coalesce(F.col(c), F.lit(0)) <= 0
    return with_codes(
        bars, key,
        (traded & (none("volume") | none("turnover") | none("trade_count")), "TRADED_WITHOUT_ACTIVITY"),
        (~traded & F.coalesce("open", "high", "low", "close").isNotNull(), "NON_TRADED_WITH_PRICES"),
        (~traded & ~(blank("volume") & blank("turnover") & blank("trade_count")), "NON_TRADED_WITH_ACTIVITY"),
    )


def vocabulary_violations(df: DataFrame, key: Sequence[str], enums: Mapping[str, Sequence[str]], patterns: Mapping[str, str], placeholders: Sequence[str] = ("{{", "${", "<%")) -> DataFrame:
    rules = [(~F.coalesce(F.col(c).isin(*v), F.lit(False)), f"{c.upper()}_NOT_IN_ENUM") for c, v in enums.items()]
    rules += [(~F.coalesce(F.col(c).rlike(p), F.lit(False)), f"{c.upper()}_PATTERN") for c, p in patterns.items()]
    rules += [(reduce(lambda a, x, c=c: a | F.contains(F.col(c), F.lit(x)), placeholders, F.lit(False)), f"{c.upper()}_PLACEHOLDER") for c in patterns]
    return with_codes(df, key, *rules)


def timestamp_order_violations(events: DataFrame, key: Sequence[str]) -> DataFrame:
    c = F.col
    return with_codes(
        events, key,
        (c("published_at") > c("first_available_at"), "PUBLISHED_AFTER_AVAILABLE"),
        (c("first_available_at") > c("captured_at"), "AVAILABLE_AFTER_CAPTURED"),
        ((c("capture_mode") == "PROSPECTIVE") & (c("captured_at") > c("decision_at")), "PROSPECTIVE_CAPTURED_AFTER_DECISION"),
    )


def change_pct_mismatch(bars: DataFrame, declared: str, tolerance: float = 0.06) -> DataFrame:
    """Rows whose declared percentage is off the change from the security's row before."""
    w = Window.partitionBy("security_code").orderBy("trade_date")
    measured = 100 * (F.col("close") / F.lag("close").over(w) - 1)
    return bars.withColumn("measured", measured).where(F.abs(F.col("measured") - F.col(declared)) > tolerance)


def unresolved_hashes(df: DataFrame, key: Sequence[str], hashes: str, manifest: DataFrame) -> DataFrame:
    """Hashes of a pipe-separated list that the manifest does not hold."""
    each = df.select(*key, F.explode(F.split(hashes, r"\|")).alias("sha256")).where("sha256 <> ''")
    return each.join(manifest.select("sha256").distinct(), "sha256", "left_anti")


def source_bound_evidence(attest: DataFrame, manifest: DataFrame) -> DataFrame:
    """Hashes that none of the declared sources captured, and declared sources without any hash."""
    owned = manifest.select("source_id", "sha256").distinct()
    hashes = attest.select("attest_id", F.explode("sha256s").alias("sha256"))
    sources = attest.select("attest_id", F.explode("source_ids").alias("source_id"))
    bound = hashes.join(owned, "sha256").join(sources, ["attest_id", "source_id"]).select("attest_id", "sha256", "source_id")
    loose = hashes.join(bound, ["attest_id", "sha256"], "left_anti").select("attest_id", F.col("sha256").alias("what"), F.lit("HASH_NOT_OF_DECLARED_SOURCE").alias("code"))
    bare = sources.join(bound, ["attest_id", "source_id"], "left_anti").select("attest_id", F.col("source_id").alias("what"), F.lit("SOURCE_WITHOUT_HASH").alias("code"))
    return loose.unionByName(bare).distinct()


def look_ahead_rows(df: DataFrame, cutoff: Column, columns: Sequence[str]) -> DataFrame:
    """Rows in which something became available after the cutoff."""
    latest = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])
    return df.where(latest > cutoff)


def denominator_gap(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected pairs that are missing and actual ones that are extra."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    missing = e.join(a, list(keys), "left_anti").withColumn("gap", F.lit("MISSING"))
    return missing.unionByName(a.join(e, list(keys), "left_anti").withColumn("gap", F.lit("EXTRA")))


def quarantine_split(rows: DataFrame, violations: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and quarantined rows with their codes in order."""
    why = violations.groupBy(*keys).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return rows.join(why, list(keys), "left_anti"), rows.join(why, list(keys))


def series_coverage(series: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Rows, first and last date, and missing and extra sessions of each series; nothing is filled forward."""
    span = series.groupBy(key).agg(F.count("*").alias("n_rows"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
    sessions = calendar.where("is_trading_day").select("trade_date", F.lit(True).alias("session"))
    seen = series.select(key, "trade_date").distinct().join(F.broadcast(sessions), "trade_date", "left")
    counted = seen.groupBy(key).agg(F.count("session").alias("covered"), F.sum(F.when(F.col("session").isNull(), 1).otherwise(0)).alias("extra_dates"))
    total = sessions.agg(F.count("*").alias("sessions"))
    return span.join(counted, key).crossJoin(F.broadcast(total)).select(key, "n_rows", "first_date", "last_date", (F.col("sessions") - F.col("covered")).alias("missing_dates"), "extra_dates")


def series_gaps(series: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """(key, trade_date, gap): each session a series lacks, and each date it has that is no session."""
    return grid_gaps(series, calendar.where("is_trading_day").select("trade_date"), key, "trade_date")


def grid_gaps(actual: DataFrame, days: DataFrame, key: str, day: str) -> DataFrame:
    """(key, day, gap): what each key lacks of ``days``, and what it has besides, in any number of keys.

    Days are few, so a key's days are one row, and what it lacks or has besides
    is found in place: the grid of keys and days is never shuffled.
    """
    whole = F.broadcast(days.select(day).distinct().agg(F.collect_list(day).alias("days")))
    # as in SQL's EXCEPT, nulls are one key, and a null day is one that the grid lacks
    bare = F.when(F.bool_or(F.col(day).isNull()), F.array(F.lit(None))).otherwise(F.array()).cast(f"array<{actual.schema[day].dataType.simpleString()}>")
    seen = actual.groupBy(key).agg(F.concat(F.collect_set(day), bare).alias("seen"))
    gap = lambda d, name: F.transform(d, lambda x: F.struct(x.alias(day), F.lit(name).alias("gap")))
    found = F.concat(gap(F.array_except("days", "seen"), "MISSING"), gap(F.array_except("seen", "days"), "EXTRA"))
    return seen.crossJoin(whole).select(key, F.explode(found).alias("x")).select(key, "x.*")


def query_ledger_violations(q: DataFrame) -> DataFrame:
    c = F.col
    return with_codes(
        q, ["query_id"],
        (c("pages_declared") != c("pages_received"), "PAGES_DECLARED_NOT_RECEIVED"),
        (c("zero_result") & ((c("result_count_declared") != 0) | (c("rows_normalized") != 0)), "ZERO_RESULT_WITH_ROWS"),
        (~c("zero_result") & (c("result_count_declared") == 0), "ZERO_ROWS_WITHOUT_ZERO_RESULT"),
        ((c("window_from") < c("collection_from")) | (c("window_to") > c("collection_to")) | (c("window_from") > c("window_to")), "WINDOW_OUTSIDE_COLLECTION"),
    )


def declared_vs_actual_counts(q: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    declared = q.groupBy(*keys).agg(F.sum("rows_normalized").alias("declared"), F.bool_or("zero_result").alias("zero_result"))
    actual = rows.groupBy(*keys).agg(F.count("*").alias("actual"))
    both = declared.join(actual, list(keys), "full_outer")
    d, a = F.coalesce("declared", F.lit(0)), F.coalesce("actual", F.lit(0))
    code = F.when(d != a, "COUNT_MISMATCH").when((a == 0) & ~F.coalesce("zero_result", F.lit(False)), "EMPTY_WITHOUT_ZERO_RESULT").otherwise("OK")
    return both.select(*keys, d.alias("declared"), a.alias("actual"), code.alias("code"))


def price_coverage(bars: DataFrame) -> DataFrame:
    """Per security: rows, dates, zero-volume rows, and the sets of units and bases with flags for mixtures.

    Where the bars have them, also the set of sources (``source_id``) and a flag for more than one ``ticker``.
    """
    more = [F.array_sort(F.collect_set("source_id")).alias("sources")] if "source_id" in bars.columns else []
    more += [(F.count_distinct("ticker") > 1).alias("mixed_tickers")] if "ticker" in bars.columns else []
    out = bars.groupBy("security_code").agg(
        F.count("*").alias("n_rows"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"),
        F.sum(F.when(F.col("volume") == 0, 1).otherwise(0)).alias("zero_volume_rows"),
        F.array_sort(F.collect_set("unit")).alias("units"), F.array_sort(F.collect_set("price_basis")).alias("bases"), *more,
    )
    return out.withColumn("mixed_units", F.size("units") > 1).withColumn("mixed_bases", F.size("bases") > 1)


def rollup_status(violations: DataFrame, datasets: DataFrame, blocking: Sequence[str]) -> DataFrame:
    """Per dataset: sorted codes and PASS, PARTIAL or BLOCKED."""
    found = violations.groupBy("dataset").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    codes_ = F.coalesce("codes", F.array().cast("array<string>"))
    status = F.when(F.size(codes_) == 0, "PASS").when(F.arrays_overlap(codes_, F.array(*map(F.lit, blocking))), "BLOCKED").otherwise("PARTIAL")
    return datasets.select("dataset").distinct().join(found, "dataset", "left").select("dataset", codes_.alias("codes"), status.alias("status"))


def fold_evidence_class(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str = "evidence_class") -> DataFrame:
    """The worst class of each group under a precedence that is named, worst first; unknown classes are worst."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    return df.groupBy(*keys).agg(F.min_by(F.coalesce(F.col(column), F.lit("UNKNOWN")), F.struct(place, column)).alias(column))


def parse_vendor_numbers(df: DataFrame, volume: str, percent: str, date: str) -> DataFrame:
    """``1.25M`` volumes, signed percentages with commas, and two date formats."""
    v = F.upper(F.trim(F.regexp_replace(F.col(volume), ",", "")))
    number = F.regexp_extract(v, r"^([0-9]*\.?[0-9]+)([KMB]?)$", 1)
    unit = F.regexp_extract(v, r"^([0-9]*\.?[0-9]+)([KMB]?)$", 2)
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    p = F.regexp_replace(F.trim(F.col(percent)), "[%+,]", "")
    return df.select(
        "*",
        F.when(number != "", F.round(number.cast("double") * scale, 4)).alias("volume_value"),
        F.when(p.rlike(r"^-?[0-9]*\.?[0-9]+$"), p.cast("double")).alias("percent_value"),
        F.coalesce(F.try_to_date(date, "MM/dd/yyyy"), F.try_to_date(date, "yyyy-MM-dd")).alias("date_value"),
    )


def forbidden_feature_names(df: DataFrame, column: str) -> DataFrame:
    """Names that tell the future or the label."""
    return df.where(F.lower(column).rlike("|".join(FUTURE_TOKENS)))


def unsafe_urls(df: DataFrame, url: str, key: Sequence[str]) -> DataFrame:
    u = F.col(url)
    return with_codes(
        df, key,
        (~u.rlike("^https://"), "NOT_HTTPS"),
        (u.rlike("^[a-z]+://[^/?#]*@"), "USERINFO"),
        (u.contains("#"), "FRAGMENT"),
        (u.rlike("^[a-z]+://[^/?#]*:[0-9]+"), "PORT"),
        (credential_keys(u), "CREDENTIAL_QUERY_KEY"),
    )


def host_allowed(df: DataFrame, url: str, sources: DataFrame) -> DataFrame:
    """Rows with ``allowed``: the host is a registered domain or below one. Domains are joined by equality on each suffix of the host."""
    named = df.withColumn("__host", host(F.col(url)))
    labels = F.split("__host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = named.select("__host", F.explode(suffixes).alias("domain")).distinct()
    good = each.join(sources.select("domain").distinct(), "domain").select("__host").distinct().withColumn("allowed", F.lit(True))
    return named.join(good, "__host", "left").withColumn("allowed", F.coalesce("allowed", F.lit(False))).drop("__host")


def phrase_evidence(texts: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """Phrases with ``found``: they occur in the evidence text after folding; an empty one never does."""
    joined = phrases.join(texts, key, "left")
    p = folded(F.col("phrase"))
    return joined.select(*phrases.columns, F.coalesce((p != "") & F.contains(folded(F.col("text")), p), F.lit(False)).alias("found"))


def derive_evidence_class(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Class of evidence from capture mode, rights and registry state; what claims to be proven by itself is lowered."""
    j = rows.join(registry, "source_id", "left")
    live, right = F.col("state") == "ACTIVE", F.col("rights_status") == "GRANTED"
    cls = (
        F.when(F.col("state").isNull(), "UNREGISTERED")
        .when(live & right & (F.col("capture_mode") == "PROSPECTIVE"), "PROVEN")
        .when(live & right, "RECONSTRUCTED")
        .when(live, "RIGHTS_PENDING")
        .otherwise("RETIRED_SOURCE")
    )
    code = F.when((F.col("declared_class") == "PROVEN") & (cls != "PROVEN"), "SELF_DECLARED_PROVEN_LOWERED").when(F.col("state").isNull(), "SOURCE_NOT_REGISTERED")
    return j.select(*rows.columns, cls.alias("evidence_class"), code.alias("code"))


#: Capture mode, rights it must have, class of evidence it gives.
CAPTURE_CLASSES = (
    ("RECORDED_AUTHORIZED_FIXTURE", "FIXTURE_ONLY", "RECORDED_AUTHORIZED_FIXTURE"),
    ("SYNTHETIC_GENERATED", "FIXTURE_ONLY", "SYNTHETIC_ONLY"),
    ("LICENSED_VENDOR_EXPORT", "RESEARCH_USE_AUTHORIZED", "LICENSED_FEED_DEPENDENT"),
    ("PUBLIC_OFFICIAL_EXPORT", "RESEARCH_USE_AUTHORIZED", "LIVE_DEPENDENT"),
    ("USER_PROVIDED_OFFICIAL_EXPORT", "RESEARCH_USE_AUTHORIZED", "LIVE_DEPENDENT"),
)
#: Access of a source, rights that a mere access receipt must state, class it gives.
RECEIPT_CLASSES = (
    ("PUBLIC_OFFICIAL_EXPORT", "UNKNOWN", "LIVE_DEPENDENT"),
    ("LICENSED_EXPORT", "RESTRICTED", "LICENSED_FEED_DEPENDENT"),
    ("RECORDED_AUTHORIZED_FIXTURE", "FIXTURE_ONLY", "RECORDED_AUTHORIZED_FIXTURE"),
)


def evidence_tuple(capture_mode: Column, rights: Column, access: Column, requirement: Column, state: Column) -> tuple[Column, Column]:
    """Class of evidence of a legal combination, and the code of an illegal one; one of the two is null.

    A packet can't prove by itself that its bytes came from the named source,
    so official captures stay dependent whatever they declare.
    """

    def pick(by: Column, rows, place: int) -> Column:
        out = F.lit(None).cast("string")
        for r in rows:
            out = F.when(by == r[0], r[place]).otherwise(out)
        return out

    receipt = capture_mode == "SOURCE_ACCESS_RECEIPT"
    rights_due = F.when(receipt, pick(access, RECEIPT_CLASSES, 1)).otherwise(pick(capture_mode, CAPTURE_CLASSES, 1))
    given = F.when(receipt, pick(access, RECEIPT_CLASSES, 2)).otherwise(pick(capture_mode, CAPTURE_CLASSES, 2))
    official = capture_mode.isin("PUBLIC_OFFICIAL_EXPORT", "USER_PROVIDED_OFFICIAL_EXPORT")
    licensed = capture_mode == "LICENSED_VENDOR_EXPORT"
    code = (
        F.when(given.isNull(), "CAPTURE_MODE_UNSUPPORTED").when(~rights.eqNullSafe(rights_due), F.when(receipt, "RECEIPT_RIGHTS_DIFFER").otherwise("CAPTURE_MODE_AND_RIGHTS_CONFLICT"))
        .when(licensed & ~(access.eqNullSafe("LICENSED_EXPORT") & requirement.eqNullSafe("EXTERNAL_LICENSE_REQUIRED")), "LICENSED_CAPTURE_OUTSIDE_CONTRACT")
        .when(official & ~access.eqNullSafe("PUBLIC_OFFICIAL_EXPORT"), "OFFICIAL_CAPTURE_OUTSIDE_CONTRACT").when(official & ~state.eqNullSafe("VERIFIED_DEFINITION"), "DEFINITION_NOT_VERIFIED")
    )
    return F.when(code.isNull(), given), code


def derive_registered_class(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """``rows`` with evidence_class and code from their source's contract; what declares itself proven is lowered with a code of its own."""
    j = rows.join(registry.select("source_id", "source_access", "rights_requirement", "registry_state"), "source_id", "left")
    cls, code = evidence_tuple(*map(F.col, ("capture_mode", "rights_status", "source_access", "rights_requirement", "registry_state")))
    lowered = F.col("declared_class") == "PROVEN_REAL_EVIDENCE" if "declared_class" in rows.columns else F.lit(False)
    unknown = F.col("source_access").isNull()
    return j.select(*rows.columns, F.when(~unknown, cls).alias("evidence_class"), F.when(unknown, "SOURCE_NOT_REGISTERED").otherwise(F.coalesce(code, F.when(lowered, "SELF_DECLARED_PROVEN_LOWERED"))).alias("code"))


def attestation_coverage(attest: DataFrame, allowed: DataFrame) -> DataFrame:
    """PASS only for a full, coherent and permitted attestation."""
    j = attest.join(allowed.select("role", "capability", F.lit(True).alias("permitted")).distinct(), ["role", "capability"], "left")
    why = codes(
        ((F.col("denominator") <= 0) | (F.col("numerator") != F.col("denominator")), "INCOMPLETE_COVERAGE"),
        (F.col("version") != F.col("registry_version"), "VERSION_MISMATCH"),
        (F.col("observed_at") > F.col("attested_at"), "OBSERVED_AFTER_ATTESTED"),
        (F.col("permitted").isNull(), "CAPABILITY_NOT_ALLOWED_FOR_ROLE"),
    )
    return j.select("attest_id", why.alias("codes"), F.when(F.size(why) == 0, "PASS").otherwise("FAIL").alias("status"))
