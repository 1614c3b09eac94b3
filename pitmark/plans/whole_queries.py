"""Queries that stand on others: roll-ups of roll-ups, findings blocked by language, chains with their own hashes.

Six queries are also registered under a second name, with ``_whole``, from the
time when the first name stood for a part of its table.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.operators import coverage as K
from pitmark.operators import events as E
from pitmark.operators import ledger as L
from pitmark.operators import market as A
from pitmark.operators import ranking as R
from pitmark.operators import row_quality as Q
from pitmark.plans import stream_queries  # noqa: F401  (registers s6)
from pitmark.plans.rank_queries import attempts
from pitmark.plans.registry import BODIES, BUILDS, query
from pitmark.plans.views import SQL, Views

for _name in ("k8_attempt_rollup", "k9_advance_watermarks", "k14_capture_state_rollup", "q18_fold_evidence_class", "e5_fold_fact_status", "r9_candidate_contract"):
    query(f"{_name}_whole", BODIES[_name])(BUILDS[_name])


class LanguageViews(Views):
    """Findings blocked by language alone, as FIXTURES.md has them: copies meet whatever their ids."""

    def findings(self) -> DataFrame:
        directions = F.array(F.lit("POSITIVE"), F.lit("NEGATIVE"), F.lit("NEUTRAL"))
        return super().findings().withColumn("security_code", F.col("lang")).withColumn("direction", F.element_at(directions, (F.col("finding_id") % 3 + 1).cast("int")))


SQL["findings_lang"] = "SELECT * REPLACE (lang AS security_code, ['POSITIVE', 'NEGATIVE', 'NEUTRAL'][finding_id % 3 + 1] AS direction) FROM findings"
_BLOCKED = ("toks", "stretches", "runs", "near", "clusters", "reps", "roled")


def _by_language(sql: str) -> str:
    return re.sub(rf"\b(findings|{'|'.join(_BLOCKED)})\b", r"\1_lang", sql)


SQL |= {f"{name}_lang": _by_language(SQL[name]) for name in _BLOCKED}

for _name in ("e7_near_duplicate_pairs", "e8_claim_clusters", "e9_cluster_representative", "k5_role_coverage_by_security", "r2_mosaic_rank", "s6_export_projection"):
    query(f"{_name}_by_language", _by_language(BODIES[_name]))(lambda v, build=BUILDS[_name]: build(LanguageViews(v.spark, v.sf_dir)))


@query("k8_wave_rollup", """SELECT s % 3 wave_id, count(*) sources, count(*) FILTER (status = 'COMPLETE') complete, CASE WHEN count(*) FILTER (status = 'COMPLETE') = count(*) THEN 'COMPLETE' ELSE 'DEGRADED' END status FROM (SELECT unnest(range(10)) s) LEFT JOIN src ON source_id = s WHERE s < 9 GROUP BY 1""")
def _(v: Views):
    waves = v.spark.range(9).select((F.col("id") % 3).alias("wave_id"), F.col("id").alias("source_id"))
    return K.wave_rollup(waves, K.attempt_rollup(K.attempt_routes(attempts(v))))


@query("k8_run_rollup", """SELECT count(*) sources, count(*) FILTER (status = 'COMPLETE') complete, CASE WHEN count(*) = 0 THEN 'FAILED' WHEN count(*) FILTER (status = 'COMPLETE') = count(*) THEN 'COMPLETE' ELSE 'DEGRADED' END status FROM src""")
def _(v: Views):
    return K.run_rollup(K.attempt_rollup(K.attempt_routes(attempts(v))))


@query("k14_batch_state", f"""SELECT CASE WHEN bool_and(state = 'AVAILABLE') THEN 'COMPLETE' WHEN bool_or(state IN ('AVAILABLE', 'PARTIAL')) THEN 'DEGRADED' ELSE 'FAILED' END batch_state FROM ({BODIES["k14_capture_state_rollup_whole"]})""")
def _(v: Views):
    return K.batch_state(BUILDS["k14_capture_state_rollup_whole"](v))


@query("a9_packet_status", f"""SELECT CASE WHEN bool_or(status = 'BLOCKED') THEN 'BLOCKED' WHEN bool_or(status = 'PARTIAL') THEN 'PARTIAL' ELSE 'PASS' END overall FROM ({BODIES["a9_gate_matrix"]})""")
def _(v: Views):
    return A.packet_status(BUILDS["a9_gate_matrix"](v))


SQL["sealed"] = """SELECT conv_id ledger_id, coalesce(text, '') t, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, coalesce(text, '')) seq FROM conversations"""


@query("l1_chain_own_hash_and_time", """WITH e AS (SELECT l.*, s.t || CASE WHEN l.ledger_id % 7 = 0 AND l.seq = 2 THEN 'changed' ELSE '' END t, CASE WHEN l.ledger_id % 13 = 0 AND l.seq = 3 THEN 0 ELSE l.seq END rec FROM ledger l JOIN sealed s USING (ledger_id, seq)), w AS (SELECT *, lag(event_hash) OVER o before, lag(seq) OVER o s0, lag(rec) OVER o r0 FROM e WINDOW o AS (PARTITION BY ledger_id ORDER BY seq))
    SELECT ledger_id, seq, unnest(list_filter([CASE WHEN seq <> coalesce(s0, 0) + 1 THEN 'SEQUENCE_GAP' END, CASE WHEN seq = 1 AND previous_hash IS NOT NULL THEN 'FIRST_HAS_PREVIOUS' END, CASE WHEN seq > 1 AND previous_hash IS DISTINCT FROM before THEN 'PREVIOUS_HASH_BREAK' END, CASE WHEN rec < r0 THEN 'TIME_ORDER' END, CASE WHEN event_hash <> sha256(ledger_id || '|' || t) THEN 'OWN_HASH_MISMATCH' END], lambda x: x IS NOT NULL)) code FROM w""")
def _(v: Views):
    """The chain with own hashes made anew from the text, which every seventh ledger's second event has had changed, and times, one of them dated back."""
    k, n = F.col("ledger_id"), F.col("seq")
    w = Window.partitionBy("conv_id").orderBy("turn", "role", F.coalesce("text", F.lit("")))
    texts = v.table("conversations").select(F.col("conv_id").alias("ledger_id"), F.row_number().over(w).alias("seq"), F.coalesce("text", F.lit("")).alias("text"))
    now = F.concat("text", F.when((k % 7 == 0) & (n == 2), "changed").otherwise(""))
    e = v.ledger().join(texts.withColumn("text", now), ["ledger_id", "seq"]).withColumn("recorded_at", F.when((k % 13 == 0) & (n == 3), 0).otherwise(n))
    return L.chain_violations(e, F.sha2(F.concat_ws("|", k.cast("string"), "text"), 256))
