"""J2 and R9: intervals that end before they start, rows that only a further column orders, and values between two roundings."""

from collections import Counter
from datetime import date

import duckdb

from pitmark.operators import ranking, temporal
from pitmark.plans.catalogue import ORACLES, QUERIES


def test_an_interval_that_ends_before_it_starts_meets_what_is_in_force(spark):
    d = lambda k: date(2024, 1, k)
    df = spark.createDataFrame([("I", "1", "MAIN", d(1), d(20)), ("I", "2", "MAIN", d(10), d(5)), ("I", "3", "MAIN", d(21), None)], "isin string, security_code string, board string, valid_from date, valid_to date")
    got = [(r.security_code, r.with_from, r.with_to) for r in temporal.collision_links(df).collect()]
    assert got == [("2", d(1), d(20))]


def test_rows_of_one_score_and_code_stand_by_the_further_column(spark):
    rows = [("r", "A1", 3 - k, 5.0, k + 1) for k in range(3)]
    df = spark.createDataFrame(rows, "run_id string, security_code string, k int, score double, rank long")
    wrong = lambda x: [r.code for r in ranking.candidate_field_violations(x, ["security_code", "score", "rank"], ["k"]).collect() if r.code != "CODE_INVALID"]
    assert wrong(df) == ["RANK_NOT_BY_SCORE"] * 2
    assert wrong(df.selectExpr("run_id", "security_code", "k", "score", "cast(k as long) rank")) == []


def test_rows_that_nothing_tells_apart_stand_by_their_rank(spark):
    df = spark.createDataFrame([("r", "1", 5.0, k) for k in (2, 1, 3)], "run_id string, security_code string, score double, rank long")
    assert ranking.candidate_field_violations(df, ["security_code", "score", "rank"]).count() == 0


def differences(spark, folder, orders):
    """Rows of R9 that only Spark or only SQL has, over the given orders."""
    spark.createDataFrame([(k, c, status, price, priority) for k, c, status, price, priority in orders], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view orders as select * from '{folder}/orders.parquet/*.parquet'")
    result = duck.execute(ORACLES["r9_candidate_field_violations"])
    names = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    got = Counter(map(tuple, QUERIES["r9_candidate_field_violations"](spark, str(folder)).select(*names).collect()))
    assert want
    return got - want, want - got


def test_scores_between_two_roundings_are_those_of_sql(spark, tmp_path):
    # 200.00005 is 200.0001 by its decimals and 200.0 by its bits; 100.00005 is 100.0001 by both
    assert differences(spark, tmp_path, [(k, 3, "O", price, "5-LOW") for k, price in enumerate((200000.05, 100000.05, 200000.04, 200000.06, 99999.95))]) == (Counter(), Counter())


def test_keys_that_are_null_negative_or_doubled_are_judged_as_in_sql(spark, tmp_path):
    orders = [(None, 7, "O", 5000.0, "5-LOW"), (None, 50, "O", 5000.0, "5-LOW"), (12, 3, "O", 5000.0, "5-LOW"), (-4, -1, "F", -900.0, "2-HIGH"), (-5, -3, "F", 0.0, None), (6, None, "P", None, "1-URGENT"), (7, 9, None, float("nan"), "1-URGENT")]
    orders += [(20, c, "P", 7000.0, "5-LOW") for c in (77, 1, 50, 154, 2, 100, 1)]
    assert differences(spark, tmp_path, orders) == (Counter(), Counter())
