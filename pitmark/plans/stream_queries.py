"""Source, sink and streaming queries."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from pitmark.operators.ranking import mosaic_rank
from pitmark.operators.scratch import shared_folder
from pitmark.plans.event_queries import reliability, rounded
from pitmark.plans.rank_queries import POLICY, roles
from pitmark.plans.registry import BODIES, query
from pitmark.plans.temporal_queries import FIRST, LAST
from pitmark.plans.views import Views
from pitmark.sources import contracts as S
from pitmark.streaming import streams as T


def spot(v: Views, name: str) -> str:
    return f"{shared_folder(v.spark)}/{name}-{uuid.uuid4().hex}"


@query("s2_read_contract_jsonl", "SELECT count(*) FILTER (doc_id % 9 <> 0 AND doc_id % 10 <> 0) good, count(*) FILTER (doc_id % 9 = 0) malformed, count(*) FILTER (doc_id % 9 <> 0 AND doc_id % 10 = 0) unknown_field FROM documents")
def _(v: Views):
    k = F.col("doc_id")
    line = F.when(k % 9 == 0, F.lit('{"doc_id": 1, ')).when(k % 10 == 0, F.concat(F.lit('{"doc_id":'), k.cast("string"), F.lit(',"other":1}'))).otherwise(F.to_json(F.struct("doc_id", "source")))
    at = spot(v, "jsonl")
    v.table("documents").select(line.alias("value")).write.text(at)
    from pyspark.sql import types as t

    good, bad = S.read_contract_jsonl(v.spark, at, t.StructType([t.StructField("doc_id", t.LongType()), t.StructField("source", t.StringType())]))
    n = lambda c: F.sum(F.when(F.col("code") == c, 1).otherwise(0))
    return good.agg(F.count("*").alias("good")).crossJoin(bad.agg(n("MALFORMED_LINE").alias("malformed"), n("UNKNOWN_FIELD").alias("unknown_field")))


@query("s1_read_contract_csv", "SELECT count(*) FILTER (o_orderkey % 50 <> 0) good, count(*) FILTER (o_orderkey % 50 = 0) bad FROM orders")
def _(v: Views):
    from pyspark.sql import types as t

    k = F.col("o_orderkey")
    at = spot(v, "csv")
    row = F.concat_ws(",", k.cast("string"), "o_orderstatus", F.when(k % 50 == 0, "extra"))
    lines = v.table("orders").select(row.alias("value"))  # rows that are too wide carry one more cell

    def under_header(batches):
        import pyarrow as pa

        first = True
        for b in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array(["o_orderkey,o_orderstatus"])], schema=b.schema)
            first = False
            yield b

    lines.mapInArrow(under_header, "value string").write.text(at)
    good, bad = S.read_contract_csv(v.spark, at, t.StructType([t.StructField("o_orderkey", t.LongType()), t.StructField("o_orderstatus", t.StringType())]))
    return good.select(F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(bad.select(F.lit(0).alias("g"), F.lit(1).alias("b"))).agg(F.sum("g").alias("good"), F.sum("b").alias("bad"))


@query("s3_read_manifest", "SELECT 'd' || doc_id path, sha256(text) sha256, n_chars size_bytes, source source_id FROM documents")
def _(v: Views):
    """Manifests of 500 artifacts each, written as one object a file and read back."""
    k, at = F.col("doc_id"), spot(v, "manifests")
    d = v.table("documents").select(F.floor(k / 500).alias("part"), F.struct(F.concat(F.lit("d"), k.cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.col("n_chars").cast("long").alias("size_bytes"), F.col("source").alias("source_id")).alias("a"))
    one = d.groupBy("part").agg(F.collect_list("a").alias("artifacts")).select("part", F.to_json(F.struct("artifacts")).alias("value"))
    one.repartition("part").write.partitionBy("part").text(at)
    return S.read_manifest(v.spark, at).select("path", "sha256", "size_bytes", "source_id")


@query("s4_verify_artifacts", """WITH f AS (SELECT s_nationkey k, sha256(string_agg(s_name, chr(10) ORDER BY s_suppkey) || chr(10)) h, sum(length(s_name) + 1) n FROM supplier GROUP BY 1) SELECT 'nation' || k nation, CASE WHEN k % 6 = 0 THEN 'UNREFERENCED' WHEN k % 5 = 0 THEN 'HASH_MISMATCH' WHEN k % 7 = 0 THEN 'SIZE_MISMATCH' ELSE 'OK' END code FROM f UNION ALL SELECT 'nation99', 'MISSING'""")
def _(v: Views):
    """Suppliers' names as one file for each nation; the manifest knows them from the table, with some entries altered."""
    at, k = spot(v, "artifacts"), F.col("s_nationkey")
    s = v.table("supplier")
    s.repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey").select(k, "s_name").write.partitionBy("s_nationkey").text(at)
    text = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: x.s_name), "\n"), F.lit("\n"))
    folder = F.concat(F.lit("s_nationkey="), k.cast("string"))
    names = v.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(at).select(F.regexp_extract("path", "(s_nationkey=[0-9]+)/", 1).alias("folder"), F.regexp_extract("path", "s_nationkey=[0-9]+/.*$", 0).alias("path"))
    m = s.groupBy(k).agg(text.alias("text")).withColumn("folder", folder).join(names, "folder").where(k % 6 != 0)
    m = m.select("path", F.sha2(F.when(k % 5 == 0, "other").otherwise(F.col("text")), 256).alias("sha256"), (F.length("text") + F.when(k % 7 == 0, 1).otherwise(0)).cast("long").alias("size_bytes"))
    lost = v.spark.range(1).select(F.lit("s_nationkey=99/x").alias("path"), F.lit("").alias("sha256"), F.lit(0).cast("long").alias("size_bytes"))
    return S.verify_artifacts(m.unionByName(lost), at).select(F.regexp_replace(F.regexp_extract("name", "^([^/]*)/", 1), "s_nationkey=", "nation").alias("nation"), "code")


@query("s5_write_dataset", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(v: Views):
    at = spot(v, "dataset")
    S.write_dataset(v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), at, ["o_orderkey"])
    return v.spark.read.parquet(at)


@query("s6_export_projection", BODIES["r2_mosaic_rank"].replace("SELECT security_code, round(score, 3) score, evidence_coverage, groups, status, reasons, 'CANDIDATE", "SELECT security_code, round(score, 3) score, status, 'CANDIDATE"))
def _(v: Views):
    r = mosaic_rank(v.findings().withColumn("roles", roles()), POLICY, reliability(), 5)
    return rounded(S.export_projection(r, "SUMMARY"), "score", places=3)


@query("s7_page_contract_report", """SELECT regexp_extract(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '([^.]+\\.[^.]+)$', 1) "domain", count(*) pages, count(*) FILTER (contains(lower(html), '<table')) with_table, count(*) FILTER (contains(lower(html), '<h1>')) with_headers, count(*) FILTER (regexp_matches(lower(html), 'captcha|access denied|verify you are human')) blocked,
    CASE WHEN count(*) FILTER (regexp_matches(lower(html), 'captcha|access denied|verify you are human')) > 0 THEN 'BLOCKED' WHEN count(*) FILTER (contains(lower(html), '<table')) < count(*) THEN 'TABLE_DRIFT' ELSE 'OK' END code FROM pages GROUP BY 1""")
def _(v: Views):
    return S.page_contract_report(v.table("pages"), ["<h1>"])


def _stream(v: Views, name: str):
    return T.read_stream(v.spark, f"{v.sf_dir}/{name}.parquet")


def _events(v: Views):
    """The event stream with the batch view's columns that need no other row."""
    e = _stream(v, "events")
    role = F.when(F.col("event_type") == "purchase", "PRIMARY_OFFICIAL").when(F.col("event_type") == "click", "SOCIAL").otherwise("CONTEXT")
    return e.select("event_id", (F.col("user_id") % 20).cast("string").alias("security_code"), F.regexp_extract("props", r"(\d+)", 1).alias("content_hash"), role.alias("source_role"), F.col("ts").cast("timestamp").alias("first_available_at"), (F.col("ts") + F.expr("interval 10 minutes")).alias("captured_at"), F.col("user_id").alias("route_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 10).alias("source_id"))


def _run(v: Views, df, name: str):
    return T.run_available(df, spot(v, name), spot(v, f"{name}-state"))


@query("t1_stream_dedupe_events", "SELECT CAST(user_id % 20 AS VARCHAR) security_code, regexp_extract(props, '(\\d+)', 1) content_hash, 1 kept, true of_its_key FROM events GROUP BY 1, 2")
def _(v: Views):
    # which row of a key comes first is up to the stream, but it must be one of that key in the table
    kept = _run(v, T.dedupe_events(_events(v)), "dedupe").select("event_id", F.struct("security_code", "content_hash").alias("key"))
    table = v.table("events").select("event_id", F.struct((F.col("user_id") % 20).cast("string").alias("security_code"), F.regexp_extract("props", r"(\d+)", 1).alias("content_hash")).alias("own"))
    g = kept.join(table, "event_id", "left").groupBy("key").agg(F.count("*").alias("kept"), F.bool_and(F.col("own").eqNullSafe(F.col("key"))).alias("of_its_key"))
    return g.select("key.security_code", "key.content_hash", "kept", "of_its_key")


def _civil(df):
    """Window bounds without a zone, as the tables have their times."""
    return df.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz"))


# a window is out once the watermark, the latest time less a day, has passed its end
@query("t2_stream_event_counts", """SELECT security_code, s "start", s + INTERVAL 7 DAY "end", count(*) events, count(*) FILTER (event_type = 'click') social, count(*) FILTER (event_type = 'purchase') official FROM (SELECT CAST(user_id % 20 AS VARCHAR) security_code, event_type, CAST(date_trunc('day', ts) - to_days(CAST(k AS INT)) AS TIMESTAMP) s FROM events, range(0, 7) t(k)) GROUP BY 1, 2 HAVING s + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def _(v: Views):
    return _civil(_run(v, T.event_counts(_events(v)), "counts"))


@contextmanager
def _rocks(v: Views):
    """The state store that arbitrary state needs, for the runs inside; the session's own comes back after them."""
    key, conf = "spark.sql.streaming.stateStore.providerClass", v.spark.conf
    before = conf.get(key)
    conf.set(key, T.STATE_STORE)
    try:
        yield
    finally:
        conf.set(key, before)


@query("t3_stream_status_intervals", f"""SELECT security_code, 'INTERVAL' kind, status, CAST(NULL AS VARCHAR) event_type, effective_from, effective_to FROM st WHERE effective_to < DATE '{LAST}' UNION ALL SELECT security_code, 'ERROR', prev, ev, since, since FROM st_steps WHERE k > 0 AND NOT ok""")
def _(v: Views):
    at = spot(v, "notices")
    v.notices().write.parquet(at)
    with _rocks(v):
        out = _run(v, T.status_intervals(T.read_stream(v.spark, at), first=FIRST), "status")
    return out.withColumn("event_type", F.when(F.col("kind") == "ERROR", F.col("event_type")))


@query("t4_stream_chain_check", "SELECT ledger_id, seq, 'PREVIOUS_HASH_BREAK' code FROM ledger WHERE ledger_id % 11 = 0 AND seq = 2")
def _(v: Views):
    at = spot(v, "ledger")
    v.ledger().write.parquet(at)
    with _rocks(v):
        return _run(v, T.chain_check(T.read_stream(v.spark, at)), "chain")


@query("t5_stream_attempt_sessions", """WITH g AS (SELECT user_id route_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(n) OVER (PARTITION BY route_id ORDER BY ts ROWS UNBOUNDED PRECEDING) k FROM g)
    SELECT route_id, min(ts) "start", max(ts) + INTERVAL 6 HOUR "end", count(*) attempts FROM s GROUP BY route_id, k HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def _(v: Views):
    return _civil(_run(v, T.attempt_sessions(_events(v)), "sessions"))


@query("t6_incremental_run", "SELECT user_id % 10 source_id, count(*) n FROM events WHERE user_id % 10 > 4 OR ts > TIMESTAMP '2024-01-15' GROUP BY 1")
def _(v: Views):
    marks = v.spark.range(5).select(F.col("id").alias("source_id"), F.lit("2024-01-15").cast("timestamp").alias("watermark"))
    return _incremental(v, marks)[0].groupBy("source_id").agg(F.count("*").alias("n"))


def _incremental(v: Views, marks):
    out = spot(v, "incremental")
    T.incremental_run(_events(v), marks, out, spot(v, "incremental-state"))
    return T.incremental_rows(v.spark, out), T.current_watermarks(v.spark, out, marks)


@query("t6_incremental_watermarks", "SELECT user_id % 10 source_id, greatest(max(ts), CASE WHEN user_id % 10 <= 4 THEN TIMESTAMP '2024-01-15' END) watermark FROM events GROUP BY 1")
def _(v: Views):
    marks = v.spark.range(5).select(F.col("id").alias("source_id"), F.lit("2024-01-15").cast("timestamp").alias("watermark"))
    return _incremental(v, marks)[1].withColumn("watermark", F.col("watermark").cast("timestamp_ntz"))


@query("t7_late_rows", "SELECT event_id, ts + INTERVAL 10 MINUTE > TIMESTAMP '2024-01-20' late FROM events")
def _(v: Views):
    at, e = spot(v, "late"), _events(v)
    T.late_rows(e, F.lit("2024-01-20").cast("timestamp_ntz"), at, spot(v, "late-state"))
    side = lambda late: T.split(v.spark, at, e.schema, late).select("event_id", F.lit(late).alias("late"))
    return side(False).unionByName(side(True))
