"""op12: rules, suppression, base phrases against a plain loop, odd rows."""

import re

import pytest

from pitmark.llm.license_rules import KEYWORDS, REACH, RULES
from pitmark.llm.licenses import digest, license_spans
from pitmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def spans(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[(s.start, s.end, s.label) for s in r.spans] for r in sorted(license_spans(docs).collect(), key=lambda r: r.doc_id)]


def test_rules_are_many_and_bounded():
    assert len(RULES) > 300 and len({(r.keyword, r.before, r.after, r.label) for r in RULES}) > 300
    for r in RULES:
        assert r.keyword in KEYWORDS and (not r.before or r.before.endswith(" "))
        assert not re.search(r"\)[*+]| [*+]", r.before + r.after), r
        assert (r.before + r.after).count(" ") <= 2 * REACH and r.before.count(" ") <= REACH


@pytest.mark.parametrize("rule", [r for r in RULES if not re.search(r"[\[(?]", r.before + r.after)][::9], ids=lambda r: f"{r.label}-{r.rank}")
def test_plain_signatures_are_found(spark, rule):
    (got,) = spans(spark, f"some words {rule.before.upper()}{rule.keyword}{rule.after}. and more")
    assert any(start <= 2 and end >= 2 + len(f"{rule.before}{rule.keyword}{rule.after}".split()) for start, end, _ in got) or rule.label in {x for _, _, x in got}


def test_priority_and_containment(spark):
    got = spans(
        spark,
        "Licensed under the Apache License, Version 2.0 (the License)",  # the version beats the name and the hint around it
        "GNU General Public License v2 or (at your option) any later version",
        "SPDX-License-Identifier: MIT",
        "CC BY-NC-SA 4.0",
        "the MIT license and the Apache License",  # apart: both stay
        "mit der lizenz, eine Lizenz mit license plates",
    )
    assert got[0] == [(3, 8, "apache-2.0")]
    assert got[1] == [(0, 12, "gpl-2.0-or-later")]
    assert got[2] == [(0, 4, "mit")]
    assert got[3] == [(0, 6, "cc-by-nc-sa")]
    assert [x[2] for x in got[4]] == ["mit", "apache"]
    assert [x[2] for x in got[5]] == ["mit"]  # a base phrase, whatever it means


def test_base_phrases_equal_a_plain_loop(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got, hits = QUERIES["op12_licenses"](spark, SF).collect(), 0
    assert len(got) == len(texts)
    for r in got:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(upper))
        found = sorted((i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        hits += len(found)
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert hits > 10


def test_odd_rows(spark):
    rows = [(1, None, 7), (None, "", 7), (2, "...", 7), (3, "mit license", 7), (3, "mit license", 7), (4, "éMIT licenseé mit_license", 7), (5, "x " * 200_000 + "cc by", 7), (6, "mit license\x00MIT\nLicense " * 3_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) for r in digest(license_spans(docs)).collect()), key=str)
    want = [
        (1, 0, 0, None, None, "", 0.0), (None, 0, 0, None, None, "", 0.0), (2, 0, 0, None, None, "", 0.0), (3, 2, 1, 0, 0, "mit", 0.5), (3, 2, 1, 0, 0, "mit", 0.5),
        (4, 4, 1, 2, 2, "mit", 0.5), (5, 200_002, 1, 200_000, 200_000, "cc-by", 0.5), (6, 12_000, 6_000, 0, 11_998, "mit", 0.5),
    ]
    assert got == sorted(want, key=str)
    assert license_spans(docs.where("false")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op12_licenses"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|BroadcastNestedLoop|Cartesian", plan)
