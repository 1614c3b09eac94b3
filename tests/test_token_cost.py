"""E6: what a token costs, and that the cheaper way gives the same tokens."""

import re

from pyspark.sql import functions as F

from pitmark.functions.columns import _may_change, claim_tokens


def test_plain_characters_meet_no_long_class(spark):
    # hundreds of ranges stand behind a test that ASCII fails at once
    assert re.match(re.escape(r"(?=[^\x00-\x9f])["), _may_change())


def test_letter_forms_cost_one_pass_each_and_are_all_folded(spark):
    df = spark.createDataFrame([("أحمد إلى آمن Abc_1 https://x.y/z الـكِتاب ab Ñandú ﬁnal",)], "t string")
    got = df.select(claim_tokens(F.col("t")).alias("t"))
    assert "translate(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.first().t == ["احمد", "الي", "امن", "abc_1", "الكتاب", "ñandú", "final"]
