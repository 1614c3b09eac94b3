"""Hash chains, seals, manifests, receipts and lineage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from pitmark.functions.columns import codes
from pitmark.operators.row_quality import with_codes


def chain_violations(events: DataFrame, own_hash=None) -> DataFrame:
    """Gaps in the sequence, links that do not match the event before, own hashes that differ when recomputed, and times out of order.

    Times are judged where the events have them: recorded_at does not go back,
    and neither it nor effective_at is before issued_at. So are a payload
    against its ``payload_hash``, the type of event, and the shape of all other
    columns that end in ``_hash``.
    """
    w = Window.partitionBy("ledger_id").orderBy("seq")
    e = events.withColumn("before", F.lag("event_hash").over(w)).withColumn("seq_before", F.lag("seq").over(w))
    rules = [
        (F.col("seq") != F.coalesce(F.col("seq_before"), F.lit(0)) + 1, "SEQUENCE_GAP"), ((F.col("seq") == 1) & F.col("previous_hash").isNotNull(), "FIRST_HAS_PREVIOUS"),
        ((F.col("seq") > 1) & ~F.col("previous_hash").eqNullSafe(F.col("before")), "PREVIOUS_HASH_BREAK"),
    ]
    if "recorded_at" in events.columns:
        e = e.withColumn("at_before", F.lag("recorded_at").over(w))
        wrong = [F.col("recorded_at") < F.col("at_before")]
        if "issued_at" in events.columns:
            wrong += [F.col(c) < F.col("issued_at") for c in ("recorded_at", "effective_at") if c in events.columns]
        rules.append((F.greatest(*[F.coalesce(x, F.lit(False)) for x in wrong]) if len(wrong) > 1 else wrong[0], "TIME_ORDER"))
    if "payload" in events.columns and "payload_hash" in events.columns:
        rules.append((~F.sha2("payload", 256).eqNullSafe(F.col("payload_hash")), "PAYLOAD_HASH_MISMATCH"))
    if "event_type" in events.columns:
        rules.append((~F.coalesce(F.col("event_type").isin("CREATE", "AMEND", "WITHDRAW", "EXPIRE", "IMPORTED"), F.lit(False)), "EVENT_TYPE_UNKNOWN"))
    shaped = [c for c in events.columns if c.endswith("_hash") and c not in ("event_hash", "previous_hash", "payload_hash", "supersedes_hash")]
    rules += [(~F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False)), f"{c.upper()}_SHAPE") for c in shaped]
    return with_codes(e, ["ledger_id", "seq"], *rules, *([(F.col("event_hash") != own_hash, "OWN_HASH_MISMATCH")] if own_hash is not None else []))


def revision_violations(events: DataFrame) -> DataFrame:
    """Per claim: the n-th event has revision n, supersedes the one before, keeps origin and mode, and is not dated back."""
    w = Window.partitionBy("claim_id").orderBy("seq")
    e = events.withColumns({"nth": F.row_number().over(w), "before": F.lag("event_hash").over(w), "first_origin": F.first("origin_id").over(w), "first_mode": F.first("mode").over(w), "at_before": F.lag("recorded_at").over(w)})
    return with_codes(
        e, ["claim_id", "seq"],
        (F.col("revision") != F.col("nth"), "REVISION_NUMBER"), (~F.col("supersedes_hash").eqNullSafe(F.col("before")), "SUPERSEDES_BREAK"), (F.col("origin_id") != F.col("first_origin"), "ORIGIN_CHANGED"),
        (F.col("mode") != F.col("first_mode"), "MODE_CHANGED"), (F.col("recorded_at") < F.col("at_before"), "BACKDATED"),
    )


def outcome_link_violations(outcomes: DataFrame, decisions: DataFrame) -> DataFrame:
    """An outcome belongs to one decision, names one of its candidates, once, and is observed after it.

    Where decisions have them, it is not observed before their issued_at or recorded_at either.
    """
    later = [c for c in ("issued_at", "recorded_at") if c in decisions.columns]
    d = decisions.select("decision_id", "decided_at", F.col("candidates").alias("cands"), *later)
    times = F.filter("cands", lambda x: x == F.col("security_code"))
    j = outcomes.join(d, "decision_id", "left").groupBy("outcome_id", "security_code", "observed_at").agg(F.count("decided_at").alias("n"), F.max("decided_at").alias("decided_at"), F.bool_or(F.array_contains("cands", F.col("security_code"))).alias("among"), F.max(F.size(times)).alias("named"), *[F.max(c).alias(c) for c in later])
    return with_codes(j, ["outcome_id"], (F.col("n") == 0, "DECISION_MISSING"), (F.col("n") > 1, "DECISION_AMBIGUOUS"), ((F.col("n") == 1) & ~F.col("among"), "NOT_A_CANDIDATE"), (F.col("observed_at") < F.col("decided_at"), "OBSERVED_BEFORE_DECISION"), ((F.col("n") == 1) & (F.col("named") > 1), "CANDIDATE_AMBIGUOUS"), *[(F.col("observed_at") < F.col(c), f"OBSERVED_BEFORE_{c[:-3].upper()}") for c in later])


def stream_seal(events: DataFrame, run: int = 4096) -> DataFrame:
    """Count, first and last hash, and a digest over all hashes in order, of each ledger.

    Sequence numbers are cut into runs of ``run``. The digest of a run is that
    of its hashes joined by line feeds; with several runs, the ledger's is that
    of theirs, joined likewise. So no row holds a whole ledger.
    """
    joined = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x.value), "\n"), 256)
    part = F.floor((F.col("seq") - 1) / run)
    p = events.groupBy("ledger_id", part.alias("part")).agg(F.count("*").alias("n"), F.min_by("event_hash", "seq").alias("first_hash"), F.max_by("event_hash", "seq").alias("last_hash"), joined(F.struct("seq", F.col("event_hash").alias("value"))).alias("value"))
    g = p.groupBy("ledger_id").agg(F.sum("n").alias("n"), F.min_by("first_hash", "part").alias("first_hash"), F.max_by("last_hash", "part").alias("last_hash"), F.count("*").alias("parts"), F.first("value").alias("one"), joined(F.struct("part", "value")).alias("many"))
    return g.select("ledger_id", "n", "first_hash", "last_hash", F.when(F.col("parts") == 1, F.col("one")).otherwise(F.col("many")).alias("digest"))


def ordered_digest(rows: DataFrame, key: Sequence[str], order: Sequence[str], piece: Column, ends: Sequence[str] = (), *, head: str = "", between: str = "", tail: str = "") -> DataFrame:
    """For each key: n, digest, and ``first_`` and ``last_`` values of the columns ``ends``, over its rows in order.

    The digest is the SHA-256 of the UTF-8 bytes of ``head``, the pieces with
    ``between`` between them, and ``tail``. One hash runs over a key's rows as
    they pass by in batches, so a key of any size takes the same memory; SHA-256
    has no parallel form, so a key's rows pass through one task. Null pieces
    are empty; null keys are one key; rows equal in order stand by their piece.
    """
    made = rows.select(*key, *order, *[F.col(c).alias(f"end_{c}") for c in ends], F.coalesce(piece, F.lit("")).alias("piece"))
    # pieces are only compared where the order ties
    ordered = made.repartition(*key).sortWithinPartitions(*key, *order, "piece").select(*key, *[f"end_{c}" for c in ends], "piece")
    width = len(key)
    kept = [*ordered.schema.fields[:width], T.StructField("n", T.LongType()), T.StructField("digest", T.StringType())]
    kept += [T.StructField(f"{k}_{f.name[4:]}", f.dataType) for f in ordered.schema.fields[width:-1] for k in ("first", "last")]
    schema = to_arrow_schema(T.StructType(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, last, n, hashed, out = None, None, None, 0, None, []

        def closed():
            hashed.update(tail.encode())
            return dict(zip(schema.names, (*now, n, hashed.hexdigest(), *[x for pair in zip(first, last, strict=True) for x in pair]), strict=True))

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                here, held = row[:width], row[width:-1]
                if hashed is None or here != now:
                    if hashed is not None:
                        out.append(closed())
                    now, first, n, hashed = here, held, 0, hashlib.sha256(head.encode())
                hashed.update(((between if n else "") + row[-1]).encode("utf-8", "surrogatepass"))
                last, n = held, n + 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if hashed is not None:
            yield pa.RecordBatch.from_pylist([*out, closed()], schema)

    return ordered.mapInArrow(run, T.StructType(kept))


def ledger_seal(events: DataFrame) -> DataFrame:
    """ledger_id, event_count, first and last event hash, last_recorded_at (where events have recorded_at) and content_sha256 of each ledger.

    ``events``: ledger_id, seq, event_hash and line, the canonical text of an
    event. The digest is that of the ledger's file: every line with a line feed
    after it, in order of seq.
    """
    times = ["recorded_at"] if "recorded_at" in events.columns else []
    d = ordered_digest(events, ["ledger_id"], ["seq"], F.concat(F.coalesce("line", F.lit("")), F.lit("\n")), ["event_hash", *times])
    return d.select("ledger_id", F.col("n").alias("event_count"), F.col("first_event_hash"), F.col("last_event_hash"), *[f"last_{c}" for c in times], F.col("digest").alias("content_sha256"))


def packet_hash(files: DataFrame) -> DataFrame:
    """packet_id, n_files and packet_sha256: the digest of each packet's canonical list of (path, sha256), keys in order, no spaces, a line feed at the end."""
    item = F.concat(F.lit('{"path":"'), "path", F.lit('","sha256":"'), "sha256", F.lit('"}'))
    d = ordered_digest(files, ["packet_id"], ["path"], item, head="[", between=",", tail="]\n")
    return d.select("packet_id", F.col("n").alias("n_files"), F.col("digest").alias("packet_sha256"))


def manifest_inventory(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, code): files that are missing, not listed or listed twice, and sizes that differ.

    Where the manifest has them: a ``sha256`` listed for several paths, and an
    ``observed_at`` outside ``window_from`` to ``window_to``.
    """
    times = {"observed_at", "window_from", "window_to"} <= set(manifest.columns)
    late = (F.col("observed_at") < F.col("window_from")) | (F.col("observed_at") > F.col("window_to"))
    more = [F.bool_or(late).alias("late")] if times else []
    more += [F.min("sha256").alias("sha256")] if "sha256" in manifest.columns else []
    m = manifest.groupBy("path").agg(F.count("*").alias("n"), F.max("size_bytes").alias("size_bytes"), *more)
    rules = [(F.col("late"), "OUTSIDE_TIME_WINDOW")] if times else []
    if "sha256" in manifest.columns:
        shared = m.groupBy("sha256").agg(F.count("*").alias("paths")).where("paths > 1")
        m = m.join(shared, "sha256", "left")
        rules.append((F.col("paths").isNotNull(), "DUPLICATE_HASH"))
    j = m.join(files.select("path", F.col("size_bytes").alias("actual")), "path", "full_outer")
    return with_codes(j, ["path"], (F.col("actual").isNull(), "MISSING_FILE"), (F.col("n").isNull(), "UNREFERENCED_FILE"), (F.col("n") > 1, "DUPLICATE_PATH"), (F.col("size_bytes") != F.col("actual"), "SIZE_MISMATCH"), *rules)


def inventory_total(manifest: DataFrame, files: DataFrame, most: int) -> DataFrame:
    """One row: bytes that are declared and bytes that there are, and whether the declared total stays within ``most``."""
    have = files.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("actual_bytes"))
    return manifest.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("declared_bytes")).crossJoin(have).withColumn("within", F.col("declared_bytes") <= most)


def outcome_payload_violations(outcomes: DataFrame) -> DataFrame:
    c = F.col
    return with_codes(
        outcomes, ["outcome_id"],
        ((c("unit") == "RETURN") & ~c("value").between(-1, 10), "RETURN_OUT_OF_RANGE"), ((c("unit") == "FILS") & (c("value") <= 0), "PRICE_NOT_POSITIVE"), (~c("unit").isin("RETURN", "FILS"), "UNKNOWN_UNIT"),
        (~((c("decided_at") <= c("start_at")) & (c("start_at") <= c("end_at")) & (c("end_at") <= c("observed_at"))), "TIMES_OUT_OF_ORDER"),
    )


def receipt_mismatches(receipts: DataFrame, components: DataFrame) -> DataFrame:
    """Hashes of upstream components as receipts recorded them against what the components have now."""
    j = receipts.join(components.select(F.col("component").alias("upstream"), "sha256"), "upstream", "left")
    return j.where(~F.col("recorded_sha256").eqNullSafe(F.col("sha256"))).select("component", "upstream", F.when(F.col("sha256").isNull(), "UPSTREAM_MISSING").otherwise("UPSTREAM_CHANGED").alias("code"))


def lineage_violations(stages: DataFrame, expected: DataFrame) -> DataFrame:
    """Stages whose predecessors are not those of the plan, or belong to another batch.

    For the hashes that stages cite of their predecessors see ``admission_violations``.
    """
    have = stages.select("run_id", F.col("stage").alias("pred"), F.col("batch_id").alias("pred_batch"))
    each = stages.join(F.broadcast(expected), "stage", "left").select("run_id", "stage", "batch_id", F.array_except("predecessors", "expected").alias("extra"), F.array_except("expected", "predecessors").alias("lost"), F.explode_outer("predecessors").alias("pred"))
    j = each.join(have, ["run_id", "pred"], "left").groupBy("run_id", "stage").agg(F.max(F.size("extra") + F.size("lost")).alias("off"), F.bool_or(F.col("pred").isNotNull() & F.col("pred_batch").isNull()).alias("absent"), F.bool_or(F.col("pred_batch") != F.col("batch_id")).alias("mixed"))
    return with_codes(j, ["run_id", "stage"], (F.col("off") > 0, "PREDECESSORS_DIFFER"), (F.col("absent"), "PREDECESSOR_ABSENT"), (F.col("mixed"), "BATCH_DIFFERS"))


def admission_violations(stages: DataFrame, bindings: DataFrame) -> DataFrame:
    """(run_id, stage, code): hashes by which stages name the admissions of their predecessors.

    ``stages``: run_id, stage, admission_sha256; ``bindings``: run_id, stage,
    pred, admission_sha256. Each must be that of the predecessor in the same
    run, and no stage may name one twice.
    """
    have = stages.select("run_id", F.col("stage").alias("pred"), F.col("admission_sha256").alias("actual"))
    j = bindings.join(have, ["run_id", "pred"], "left")
    g = j.groupBy("run_id", "stage").agg(F.bool_or(F.col("actual").isNull()).alias("absent"), F.bool_or(F.col("actual") != F.col("admission_sha256")).alias("other"), (F.count("*") > F.count_distinct("admission_sha256")).alias("again"), F.bool_or(~F.coalesce(F.col("admission_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("shape"))
    return with_codes(g, ["run_id", "stage"], (F.col("absent"), "PREDECESSOR_NOT_ADMITTED"), (F.col("other"), "ADMISSION_HASH_DIFFERS"), (F.col("again"), "ADMISSION_REPLAYED"), (F.col("shape"), "HASH_SHAPE"))


#: Fields of a forecast that tell its outcome, whatever else is allowed.
OUTCOME_FIELDS = (
    "outcome", "realized_positive", "gross_return", "benchmark_return", "net_return", "net_excess_return", "target_hit", "exit_price", "exit_price_fils", "future_return", "max_favorable_excursion", "max_adverse_excursion",
)
#: Fields that a forecast must have, and those it may have beside them.
FORECAST_REQUIRED = (
    "decision_id", "security_code", "product_id", "target_rule", "decision_at", "outcome_due_at", "horizon_sessions", "model_version", "entry_rule", "eligible", "selected", "abstained", "thesis_episode_id",
)
FORECAST_OPTIONAL = (
    "score", "probability", "rank", "expected_net_return", "lower_return", "upper_return", "decision_status", "reason_codes", "catalyst_news_ids", "direction", "invalidation_rule",
)


def forecast_payload_violations(events: DataFrame, allowed: Sequence[str] = (*FORECAST_REQUIRED, *FORECAST_OPTIONAL), required: Sequence[str] = ()) -> DataFrame:
    """(event_id, code): what is wrong with a forecast's JSON payload.

    Fields that tell outcomes, at any depth; fields that are not allowed or
    missing (null and empty count as missing); an outcome that is due no later
    than the decision; times without a zone; a horizon or rank below 1; flags
    that are no booleans or contradict each other (selected, but abstained or
    not eligible); neither score nor probability; numbers that are none, and a
    probability outside 0 to 1; reason codes and news that are no lists. Times
    and horizon are judged where they are present.
    """
    keys = F.json_object_keys("payload")
    get = lambda k: F.get_json_object("payload", f"$.{k}")
    said = lambda k: F.coalesce(get(k), F.lit("")) != ""
    # every string of the text, in one pass; those that a colon follows are keys, at any depth, and the others leave the group empty
    strings = F.lit(r'"((?:[^"\\]|\\.)*+)"\s*:|"(?:[^"\\]|\\.)*+"')
    deep = F.transform(F.regexp_extract_all("payload", strings, F.lit(1)), F.lower)
    number = lambda k: get(k).try_cast("double")
    bad_number = lambda k: said(k) & (number(k).isNull() | F.isnan(number(k)) | (F.abs(number(k)) == float("inf")))
    at = lambda k: F.try_to_timestamp(get(k))
    no_time = lambda k: said(k) & (at(k).isNull() | ~get(k).rlike(r"(Z|[+-]\d\d:?\d\d)$"))
    below_one = lambda k: said(k) & ~F.coalesce(get(k).try_cast("bigint") > 0, F.lit(False))
    flags = ("eligible", "selected", "abstained")
    no_flag = F.exists(F.array(*[said(k) & ~get(k).isin("true", "false") for k in flags]), lambda x: x)
    why = codes(
        (F.exists(deep, lambda k: k.isin(*OUTCOME_FIELDS) | k.rlike("^(outcome_(?!due_at$)|realized_|future_|exit_price)|_target_hit$")), "OUTCOME_FIELD"), (F.size(F.array_except(keys, F.array(*map(F.lit, allowed)))) > 0, "FIELD_NOT_ALLOWED"),
        (F.exists(F.array(*[~said(k) for k in required]).cast("array<boolean>"), lambda x: x) & keys.isNotNull(), "FIELD_MISSING"), (no_time("decision_at") | no_time("outcome_due_at"), "TIME_UNREADABLE"), (at("outcome_due_at") <= at("decision_at"), "OUTCOME_DUE_NOT_AFTER_DECISION"),
        (below_one("horizon_sessions"), "HORIZON_NOT_POSITIVE"), (no_flag, "FLAG_NOT_BOOLEAN"), ((get("selected") == "true") & ((get("abstained") == "true") | F.coalesce(get("eligible") == "false", F.lit(False))), "SELECTED_AND_ABSTAINED"),
        (keys.isNotNull() & ~said("score") & ~said("probability"), "SCORE_MISSING"), (bad_number("score") | bad_number("probability"), "NUMBER_UNREADABLE"), (~number("probability").between(0, 1), "PROBABILITY_OUT_OF_RANGE"), (below_one("rank"), "RANK_NOT_POSITIVE"),
        (F.exists(F.array(*[get(k).isNotNull() & ~get(k).startswith("[") for k in ("reason_codes", "catalyst_news_ids")]), lambda x: x), "LIST_EXPECTED"), (keys.isNull(), "PAYLOAD_UNREADABLE"),
    )
    # codes stand in a projection of their own, where a field is read once; an inner explode would judge each payload once more in a filter, field by field
    return events.select("event_id", why.alias("codes")).select("event_id", F.explode_outer("codes").alias("code")).where("code is not null")
