"""Work that the size of the input alone would leave in a few tasks, or in large ones."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from pitmark.operators import market, temporal
from pitmark.plans.catalogue import QUERIES
from pitmark.plans.registry import BODIES
from pitmark.streaming import streams


def test_pairs_of_one_isin_lie_in_several_tasks(spark):
    d = lambda k: dt.date(2024, 1, 1 + k % 28)
    rows = [("I", f"s{k // 2}", "XY"[k % 2], d(k), d(k + 9) if k % 3 else None) for k in range(120)] + [("I", "s1", None, d(1), None), ("I", None, "X", d(1), None)]
    master = spark.createDataFrame(rows, "isin string, security_code string, board string, valid_from date, valid_to date")
    got = temporal.identifier_collisions(master)
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    end = lambda r: r[4] or dt.date.max
    # as in SQL: what is null is not less than anything
    less = lambda a, b: None not in (a[1], b[1]) and (a[1] < b[1] or (a[1] == b[1] and None not in (a[2], b[2]) and a[2] < b[2]))
    want = [("I", a[1], b[1], a[3], b[3]) for a in rows for b in rows if less(a, b) and a[3] <= end(b) and b[3] <= end(a)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pairs_of_small_cells_are_those_of_sql(spark):
    d = lambda k: dt.date(2024, 1, 1 + k % 28)
    rows = [("IJ"[k % 2], f"s{k // 3}", "XY"[k % 2], d(k * 5), d(k * 7) if k % 3 else None) for k in range(90)]
    rows += [("I", "s1", None, d(1), None), ("I", None, "X", d(1), None), ("I", "s1", "X", None, d(3)), (None, "s1", "X", d(1), None), ("I", "s3", "X", d(2), None), ("K", "s1", "X", d(1), None)] + rows[:4]
    master = spark.createDataFrame(rows, "isin string, security_code string, board string, valid_from date, valid_to date")
    duck = duckdb.connect()
    duck.execute("create table identity (isin varchar, security_code varchar, board varchar, valid_from date, valid_to date)")
    duck.executemany("insert into identity values (?, ?, ?, ?, ?)", rows)
    want = sorted(duck.execute(BODIES["j2_identifier_collisions"]).fetchall())
    for cut in ({"most": 7}, {"tiles": 1}, {}):
        assert sorted(map(tuple, temporal.identifier_collisions(master, **cut).collect())) == want


def test_listings_are_sent_to_few_cells(spark):
    master = spark.range(400).select(F.lit("I").alias("isin"), F.col("id").cast("string").alias("security_code"), F.lit("MAIN").alias("board"), F.lit("2024-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    assert len(temporal.identifier_collisions(master).collect()) == 400 * 399 // 2
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    run = store.executionsList().last()
    values, metrics = store.executionMetrics(run.executionId()), run.metrics()
    # a plan that is changed on the way names its metrics again
    ids = {m.accumulatorId() for m in (metrics.apply(k) for k in range(metrics.size())) if m.name() == "shuffle records written"}
    sent = [int(x.get().replace(",", "")) for x in map(values.get, ids) if x.isDefined()]
    # 17 times where each listing meets all tiles
    assert 0 < sum(sent) <= 400 * 8


def test_securities_of_a_bucket_keep_their_own_states_over_batches(spark, tmp_path):
    d = lambda k: dt.date(2024, 1, k)
    first = [("a", d(3), 1, "SUSPEND"), ("b", d(2), 2, "RESUME"), (None, d(4), 3, "DELIST"), ("a", None, 4, "RESUME")]
    second = [("b", d(9), 5, "DELIST"), ("a", d(7), 6, "RESUME"), (None, d(8), 7, "RELIST"), ("a", d(7), 8, "SUSPEND")]
    for k, rows in enumerate((first, second)):
        spark.createDataFrame(rows, "security_code string, effective_date date, notice_id long, event_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, streams.STATE_STORE)
    try:
        notices = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        got = streams.run_available(streams.status_intervals(notices, first="2024-01-01", buckets=1), f"{tmp_path}/out", f"{tmp_path}/state")
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        ("a", "INTERVAL", "TRADING", "SUSPEND", d(1), d(2)), ("a", "INTERVAL", "SUSPENDED", "RESUME", d(3), d(6)), ("b", "ERROR", "TRADING", "RESUME", d(2), d(2)), ("b", "INTERVAL", "TRADING", "DELIST", d(1), d(8)),
        (None, "INTERVAL", "TRADING", "DELIST", d(1), d(3)), (None, "INTERVAL", "DELISTED", "RELIST", d(4), d(7)),
    ], key=repr)


def test_facts_meet_few_values_without_a_shuffle(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 50 * 10)
    intervals = spark.range(20_000).select((F.col("id") / 50).cast("int").cast("string").alias("security_code"), F.when(F.col("id") % 3 != 2, F.element_at(F.array(F.lit("on"), F.lit("off")), (F.col("id") % 3 % 2 + 1).cast("int"))).alias("v"), day.alias("valid_from"), F.date_add(day, 8).alias("valid_to"))
    facts = spark.range(3_000).select(F.col("id").alias("fact"), (F.col("id") % 401).cast("string").alias("security_code"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 500).alias("at"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "20k")
    try:
        found = temporal.resolve_as_of(facts, ["fact"], "at", intervals, "v")
        got = {tuple(r) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    want = set()
    for k in range(3_000):
        code, at = k % 401, k % 500
        hit = at % 10 < 9 and code < 400
        n = (code * 50 + at // 10) % 3
        want.add((k, str(code), dt.date(2024, 1, 1) + dt.timedelta(at), ("on", "off", None)[n] if hit else None, "MATCHED" if hit else "MISSING"))
    assert got == want


def test_pieces_of_a_universe_are_spread_into_days_in_several_tasks(spark):
    d = lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    calendar = spark.createDataFrame([(d(k), True) for k in range(100)], "trade_date date, is_trading_day boolean")
    master = spark.createDataFrame([(str(k), d(0), None) for k in range(40)], "security_code string, valid_from date, valid_to date")
    statuses = spark.createDataFrame([(str(k), "TRADING", d(0), d(99)) for k in range(40)], "security_code string, status string, effective_from date, effective_to date")
    got = temporal.eligible_universe(calendar, master, statuses)
    assert got.count() == 4_000 and got.select(F.spark_partition_id()).distinct().count() > 1


def test_bars_of_one_row_a_day_are_grouped_once(spark):
    rows = [("a", "d", 3, 1.5, 2), ("a", "d", 4, None, 1), ("b", "d", None, 2.0, 1), (None, "d", 5, 1.0, 1), ("b", "e", 0, 9.0, 9), ("c", "e", 7, 1.0, 1)]
    bars = spark.createDataFrame(rows, "security_code string, trade_date string, volume long, turnover double, trade_count long")
    grouped = bars.groupBy("security_code", "trade_date").agg(*[F.sum(c).alias(c) for c in ("volume", "turnover", "trade_count")])
    once, again = market.market_totals(grouped, one_a_day=True), market.market_totals(grouped)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("d", 1, 12, 2.5, 4), ("e", 1, 7, 1.0, 1)]
    for name in ("a2_market_totals", "a2_market_totals_by_state"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        # partial and final, by security and day and then by day
        assert plan.count("HashAggregate") == 4
