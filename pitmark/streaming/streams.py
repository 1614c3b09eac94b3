"""Streaming twins of batch operators: lazy streaming DataFrames, state in the store, late rows to their own side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pitmark.operators.scratch import hadoop_file
from pitmark.operators.temporal import TRANSITIONS

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedupe_events(events: DataFrame, at: str = "first_available_at", delay: str = "120 days") -> DataFrame:
    """The first row of each security and content; what comes later than the delay is dropped."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(["security_code", "content_hash"])


def event_counts(events: DataFrame, at: str = "first_available_at", delay: str = "1 day", length: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Social and official events per security in sliding windows."""
    w = events.withWatermark(at, delay).groupBy("security_code", F.window(at, length, slide).alias("w"))
    n = lambda r: F.sum(F.when(F.col("source_role") == r, 1).otherwise(0))
    return w.agg(F.count("*").alias("events"), n("SOCIAL").alias("social"), n("PRIMARY_OFFICIAL").alias("official")).select("security_code", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "social", "official")


def attempt_sessions(attempts: DataFrame, at: str = "ts", gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """Runs of attempts on a route without a longer gap."""
    g = attempts.withWatermark(at, delay).groupBy("route_id", F.session_window(at, gap).alias("w"))
    return g.agg(F.count("*").alias("attempts")).select("route_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "attempts")


def _batches(path: str, number: int, name: str) -> str:
    return f"{path}/{name}/batch={number}"


def _committed(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the batches whose table ``name`` is whole."""
    files, place = hadoop_file(spark, f"{path}/{name}")
    if not files.exists(place):
        return []
    return sorted(int(d.getPath().getName().partition("=")[2]) for d in files.listStatus(place) if d.isDirectory() and files.exists(hadoop_file(spark, f"{d.getPath()}/_SUCCESS")[1]))


def late_rows(events: DataFrame, decision: Column, path: str, checkpoint: str, days: int = 120) -> list[dict]:
    """Split a stream into rows in time and rows captured after the decision or outside the context, reading it once.

    Each micro-batch is written in one pass, with one folder for either side,
    and counted on the way; a batch that is replayed overwrites itself. Put it
    before any watermark. Returns the counts of each batch that ran; ``split``
    reads a side.
    """
    late = (F.col("captured_at") > decision) | (F.col("first_available_at") < decision - F.make_interval(days=F.lit(days)))
    counts: list[dict] = []

    def batch(df: DataFrame, number: int) -> None:
        seen = Observation()
        marked = df.withColumn("late", F.coalesce(late, F.lit(False))).observe(seen, F.count("*").alias("rows"), F.count_if("late").alias("late"))
        marked.write.partitionBy("late").mode("overwrite").parquet(_batches(path, number, "rows"))
        counts.append({"batch": number, **seen.get})

    events.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start().awaitTermination()
    return counts


def split(spark: SparkSession, path: str, schema, late: bool) -> DataFrame:
    """One side of ``late_rows``: rows of all whole batches."""
    kept = spark.read.schema(schema.add("late", "boolean").add("batch", "long")).option("basePath", f"{path}/rows").parquet(*[_batches(path, n, "rows") for n in _committed(spark, path, "rows")])
    return kept.where(F.col("late") == late).drop("late", "batch")


class _Status(StatefulProcessor):
    """State of a bucket: status of each of its securities and the day since when. A transition emits the interval it ends; an illegal one emits an error."""

    def __init__(self, opening: str, first: str):
        self.opening, self.first = opening, pd.Timestamp(first).date()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("statuses", "security_code string, status string, since date")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        known = {code: (status, since) for code, status, since in self.state.get()} if self.state.exists() else {}
        out, opened, before = [], (self.opening, self.first), dt.timedelta(days=1)
        frame = pd.concat(list(rows)).sort_values(["effective_date", "notice_id"])
        codes = [x if isinstance(x, str) else None for x in frame["security_code"].tolist()]
        for code, day, event in zip(codes, frame["effective_date"].tolist(), frame["event_type"].tolist(), strict=True):
            status, since = known.get(code, opened)
            to = TRANSITIONS.get((status, event))
            if to is None:
                known.setdefault(code, opened)
                out.append((code, "ERROR", status, event, day, day))
                continue
            if day - before >= since:
                out.append((code, "INTERVAL", status, event, since, day - before))
            known[code] = to, day
        self.state.put([(code, *x) for code, x in known.items()])
        yield pd.DataFrame(out, columns=["security_code", "kind", "status", "event_type", "effective_from", "effective_to"])

    def close(self) -> None:
        pass


def status_intervals(notices: DataFrame, opening: str = "TRADING", first: str = "1995-01-01", buckets: int = 1024) -> DataFrame:
    """Intervals as transitions arrive, and error rows for illegal ones; a notice without a day is left out. Needs the RocksDB state store.

    Securities are many and have few notices each, so what a key costs in frames
    and in questions to the store is paid once for each of ``buckets``, whose
    states are read and written as one list. A checkpoint keeps to its number of buckets.
    """
    kept = notices.where("effective_date is not null").select("security_code", F.col("effective_date").cast("date").alias("effective_date"), "notice_id", "event_type", F.pmod(F.xxhash64("security_code"), F.lit(buckets)).alias("bucket"))
    return kept.groupBy("bucket").transformWithStateInPandas(
        _Status(opening, first), outputStructType="security_code string, kind string, status string, event_type string, effective_from date, effective_to date", outputMode="append", timeMode="none"
    )


class _Chain(StatefulProcessor):
    """State: number and hash of the last event in turn, and the events ahead of their turn with the time they wait until.

    An event is judged in its turn, whatever the order of arrival. When an event
    ahead has waited long enough, what is missing before it is a gap, and the
    chain goes on from it; what comes for an earlier turn after that is late.
    """

    def __init__(self, at: str | None, patience_ms: int):
        self.at, self.patience = at, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seq long, event_hash string")
        self.ahead = handle.getMapState("ahead", "seq long", "previous_hash string, event_hash string, until long")

    def _judge(self, out, ledger, last, seq, previous, own):
        if seq != last[0] + 1:
            out.append((ledger, seq, "SEQUENCE_GAP"))
        if seq == 1 and previous is not None:
            out.append((ledger, seq, "FIRST_HAS_PREVIOUS"))
        if last[0] and previous != last[1]:
            out.append((ledger, seq, "PREVIOUS_HASH_BREAK"))
        return seq, own

    def _drain(self, out, ledger, last, held):
        while last[0] + 1 in held:
            seq = last[0] + 1
            previous, own, _ = self.ahead.getValue((seq,))
            self.ahead.removeKey((seq,))
            held.discard(seq)
            last = self._judge(out, ledger, last, seq, previous, own)
        return last

    def _frame(self, out):
        return pd.DataFrame(out, columns=["ledger_id", "seq", "code"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        last, out, waits = self.last.get() if self.last.exists() else (0, None), [], set()
        held = {k[0] for k in self.ahead.keys()} if self.ahead.exists() else set()
        for frame in rows:
            frame = frame.sort_values("seq")
            times = [0] * len(frame) if self.at is None else (pd.to_datetime(frame[self.at]).astype("int64") // {"ns": 10**6, "us": 10**3, "ms": 1, "s": 1}[pd.to_datetime(frame[self.at]).dt.unit]).tolist()
            for seq, previous, own, at in zip(frame["seq"].tolist(), frame["previous_hash"].tolist(), frame["event_hash"].tolist(), times, strict=True):
                previous = previous if isinstance(previous, str) else None
                if seq <= last[0] or seq in held:
                    out.append((key[0], seq, "LATE_OR_REPEATED"))
                elif seq == last[0] + 1:
                    last = self._drain(out, key[0], self._judge(out, key[0], last, seq, previous, own), held)
                else:
                    until = int(at) + self.patience
                    self.ahead.updateValue((seq,), (previous, own, until))
                    held.add(seq)
                    waits.add(until)
        self.last.update(last)
        if self.at is not None:
            for until in sorted(waits):
                self.handle.registerTimer(until)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, out, until = self.last.get() if self.last.exists() else (0, None), [], expiredTimerInfo.getExpiryTimeInMs()
        waiting = sorted((k[0], v) for k, v in self.ahead.iterator()) if self.ahead.exists() else []
        ripe = [seq for seq, v in waiting if v[2] <= until]
        # what stands before the last ripe event has waited long enough too, or stands before one that has
        for seq, (previous, own, _) in waiting:
            if ripe and seq <= ripe[-1]:
                self.ahead.removeKey((seq,))
                last = self._judge(out, key[0], last, seq, previous, own)
        held = {seq for seq, _ in waiting if not ripe or seq > ripe[-1]}
        self.last.update(self._drain(out, key[0], last, held))
        yield self._frame(out)

    def close(self) -> None:
        pass


def chain_check(events: DataFrame, at: str | None = None, patience: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """(ledger_id, seq, code): breaks of each ledger's chain, whatever the order in which events arrive.

    ``events``: ledger_id, seq, previous_hash, event_hash. An event ahead of its
    turn waits for those before it. With ``at``, a timestamp column, it waits
    until the watermark, the latest time less ``delay``, is ``patience`` past its
    time; then the missing ones are a SEQUENCE_GAP. Without, it waits until they
    come. Events for a turn that has passed are LATE_OR_REPEATED. Needs the RocksDB state store.
    """
    ms = int(pd.Timedelta(patience).total_seconds() * 1000)
    kept = events.select("ledger_id", "seq", "previous_hash", "event_hash", *([at] if at else []))
    if at:
        kept = kept.withWatermark(at, delay)
    return kept.groupBy("ledger_id").transformWithStateInPandas(_Chain(at, ms), outputStructType="ledger_id long, seq long, code string", outputMode="append", timeMode="eventTime" if at else "none")


def incremental_run(stream: DataFrame, watermarks: DataFrame, path: str, checkpoint: str, at: str = "ts", transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Process what has arrived above each source's watermark into tables under ``path``, once, and stop.

    A micro-batch writes its rows, and then the watermarks as they stand after
    it: each source's greatest time so far. The second table is the commit: a
    batch without it doesn't count. A batch that is replayed starts from the
    watermarks of the batches before it and overwrites itself, so it changes
    nothing. ``watermarks`` (source_id, watermark) holds where no batch has
    run. ``incremental_rows`` and ``current_watermarks`` read the tables.
    """
    spark = stream.sparkSession

    def batch(df: DataFrame, number: int) -> None:
        marks = current_watermarks(spark, path, watermarks, before=number)
        # one row for each source
        fresh = df.join(F.broadcast(marks), "source_id", "left").where(F.col("watermark").isNull() | (F.col(at) > F.col("watermark"))).drop("watermark")
        fresh = fresh.persist()
        transform(fresh).write.mode("overwrite").parquet(_batches(path, number, "rows"))
        seen = fresh.groupBy("source_id").agg(F.max(at).alias("seen"))
        moved = marks.join(seen, "source_id", "full_outer").select("source_id", F.greatest("watermark", F.col("seen").cast("timestamp")).alias("watermark"))
        moved.write.mode("overwrite").parquet(_batches(path, number, "watermarks"))
        fresh.unpersist()

    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start().awaitTermination()


def current_watermarks(spark: SparkSession, path: str, initial: DataFrame, before: int | None = None) -> DataFrame:
    """source_id and watermark after the last committed batch, or after the last one before ``before``."""
    done = [n for n in _committed(spark, path, "watermarks") if before is None or n < before]
    start = initial.select("source_id", F.col("watermark").cast("timestamp").alias("watermark"))
    return spark.read.schema(start.schema).parquet(_batches(path, done[-1], "watermarks")) if done else start


def incremental_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches."""
    return spark.read.parquet(*[_batches(path, n, "rows") for n in _committed(spark, path, "watermarks")])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that is there into Parquet files and read them."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files, or one such file, as a stream; a pattern, unlike a path, may name a file."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")
