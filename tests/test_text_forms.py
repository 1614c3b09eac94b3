"""NFKC on all code points and on pairs; CSV records across lines and splits; totals by state."""

import csv
import io
import random
import unicodedata

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitmark.functions.columns import compatible
from pitmark.operators.market import market_totals
from pitmark.sources import contracts as S


def test_compatible_is_nfkc_on_all_code_points(spark):
    points = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    texts = ["".join(f"{chr(p)}\x01" for p in points[k : k + 64]) for k in range(0, len(points), 64)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.c for r in df.select(compatible(F.col("t")).alias("c")).collect()] == [unicodedata.normalize("NFKC", t) for t in texts]


def test_compatible_is_nfkc_on_pairs_and_longer(spark):
    rng = random.Random(1)
    odd = [c for c in map(chr, (*range(0xA0, 0xD800), *range(0xE000, 0x20000))) if unicodedata.combining(c) or unicodedata.decomposition(c)]
    some = [*"aeoucnEIO かは한ᄒ", *map(chr, range(0x1100, 0x1113)), *map(chr, range(0x1161, 0x1176)), *map(chr, range(0x11A8, 0x11C3))]
    texts = ["".join(rng.choice(odd if rng.random() < 0.6 else some) for _ in range(rng.choice([2, 2, 3, 6]))) for _ in range(20_000)] + ["", "plain", "ﻻ ｆｕｌｌ ﬁ"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = [r.c for r in df.select(compatible(F.col("t")).alias("c")).collect()]
    assert got == [unicodedata.normalize("NFKC", t) for t in texts] + [None]


def test_quoted_line_feeds_are_records_across_splits(spark, tmp_path):
    rng = random.Random(2)
    want = []
    for k in range(3):
        rows = [(str(i), "".join(rng.choices(['a', '"', ",", "\n", "é", "b c"], k=rng.randint(1, 12)))) for i in range(2_000)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if k == 1 else csv.QUOTE_MINIMAL).writerows(rows)
        (tmp_path / f"{k}.csv").write_text("id,said\n" + out.getvalue(), encoding="utf-8")
        want += [(int(i), s) for i, s in rows]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("said", T.StringType())])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")  # many splits in a file
    try:
        good, bad = S.read_contract_csv(spark, str(tmp_path), schema)
        got = sorted((r.id, r.said) for r in good.collect())
        left = [tuple(r) for r in bad.collect()]
    finally:
        spark.conf.set(key, before)
    # the parser strips cells of blank space alone in no case here, and gives an empty cell as null
    assert left == [] and got == sorted(want)


def test_a_quote_that_never_closes_and_rows_of_wrong_width(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,said\n1,"x\ny"\n2,z,extra\nid,said\n3,"never\n' + "4,w\n" * 50)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("said", T.StringType())])
    good, bad = S.read_contract_csv(spark, str(tmp_path), schema, longest=10)
    assert [(r.id, r.said) for r in good.collect()] == [(1, "x\ny")]
    assert sorted((r.raw, r.code) for r in bad.collect()) == [("2,z,extra", "ROW_NOT_IN_CONTRACT"), ('3,"never', "RECORD_NOT_CLOSED"), ("id,said", "HEADER_REPEATED")]


def test_totals_follow_the_stated_state(spark):
    rows = [("d", "a", "TRADED", None, 1.0, 2), ("d", "b", "NO_TRADE", 9, 9.0, 9), ("d", "c", "TRADED_THEN_SUSPENDED", 5, 2.0, 3), ("d", "e", None, 7, 7.0, 7)]
    bars = spark.createDataFrame(rows, "trade_date string, security_code string, trading_state string, volume long, turnover double, trade_count long")
    assert [tuple(r) for r in market_totals(bars).collect()] == [("d", 2, 5, 3.0, 5)]
    assert [tuple(r) for r in market_totals(bars.drop("trading_state")).collect()] == [("d", 3, 21, 18.0, 19)]
