"""License scans with ordered signature rules, in DataFrame functions alone."""

from __future__ import annotations

import json
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.llm.license_rules import KEYWORDS, REACH, RULES

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What parts words: every ASCII character but digits and letters.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPAN = "struct<start:int,end:int,label:string,strength:int,rank:int,base:boolean>"


def _gate() -> str:
    """A pattern that finds any keyword as a whole word, in either case of A-Z; branches by first letter."""
    branches = (f"{first}(?:{'|'.join(w[1:] for w in some)})" for first, some in groupby(KEYWORDS, key=lambda w: w[0]))
    return f"(?i)(?<![0-9a-z])(?:{'|'.join(branches)})(?![0-9a-z])"


def _rules() -> Column:
    """All rules, by keyword, as one constant."""
    of = lambda r: r._asdict() | {"before": f"(?:^| ){r.before}$" if r.before else "", "after": f"^{r.keyword}{r.after} "}
    said = json.dumps({k: [of(r) for r in RULES if r.keyword == k] for k in KEYWORDS})
    return F.from_json(F.lit(said), "map<string,array<struct<rank:int,strength:int,label:string,before:string,after:string,base:boolean>>>")


def _words(found: str) -> Column:
    """How many words a match holds: each brings one space."""
    return F.length(found) - F.length(F.replace(found, F.lit(" "), F.lit("")))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses that whole texts name: doc_id, n_words, base and spans of each row.

    A-Z are lower-cased; words are runs of ASCII digits and letters and of all
    characters beyond ASCII. Texts that hold no keyword of any rule are done
    with; in the others, each place of a keyword is tried against the rules of
    this keyword alone, on the words around it. ``base`` holds (start, end,
    label, strength, rank, base), in words from 0, end exclusive, of every place
    of a base phrase. ``spans`` holds the detections that stay: of two, one
    inside the other, the stronger stays; of equal ones the longer, then the
    earlier rule. A detection goes if any other beats it so, whether or not that one stays.

    Null text is empty, with no words and empty arrays; a null id stays null;
    repeated rows get a row each; an empty table gives no rows; other columns
    are ignored. What is shuffled is a row for each text and for each detection.
    A detection meets those of its neighbourhood only, so time grows with the text.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), text.alias("text"))
    n_words = F.regexp_count("text", F.lit("[^" + _GAP[1:])).cast("long")
    words = F.split(F.trim(F.regexp_replace(F.translate("text", _UPPER, _UPPER.lower()), _GAP, " ")), " ")
    rows = rows.select("row", "doc_id", n_words.alias("n_words"), F.when(F.col("text").rlike(_gate()), words).alias("words"))
    # the places of keywords, with the words before them, and from them on; a text without any stays as one row
    keywords = F.array(*[F.lit(k) for k in KEYWORDS])
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(keywords, F.get("words", i)))
    said = lambda some: F.concat(F.array_join(some, " "), F.lit(" "))
    around = F.transform(
        places,
        lambda i: F.struct(
            i.alias("at"), F.get("words", i).alias("keyword"),
            F.when(i > 0, said(F.slice("words", F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH))))).otherwise("").alias("before"),
            said(F.slice("words", i + 1, F.lit(REACH + 1))).alias("after"),
        ),
    )
    places = rows.select("row", "doc_id", "n_words", F.explode_outer(F.when(F.size("words") > 0, around)).alias("x")).select("row", "doc_id", "n_words", "x.*")
    rules = F.filter(F.element_at(_rules(), F.col("keyword")), lambda r: ((r["before"] == "") | F.rlike("before", r["before"])) & F.rlike("after", r["after"]))
    tried = places.select("row", "doc_id", "n_words", "at", "before", "after", F.explode_outer(rules).alias("r"))
    ahead = F.when(F.col("r.before") == "", "").otherwise(F.ltrim(F.regexp_substr("before", F.col("r.before"))))
    tried = tried.select("row", "doc_id", "n_words", "at", ahead.alias("ahead"), F.regexp_substr("after", F.col("r.after")).alias("behind"), "r.*")
    found = tried.select("row", "doc_id", "n_words", (F.col("at") - _words("ahead")).alias("start"), (F.col("at") + _words("behind")).alias("end"), "label", "strength", "rank", "base")
    # a nested detection starts at most so many words away
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-2 * REACH, 2 * REACH)
    span = F.struct("start", "end", "label", "strength", "rank", "base").cast(_SPAN)
    met = found.select("row", "doc_id", "n_words", F.when(F.col("rank").isNotNull(), span).alias("span"), F.when(F.col("rank").isNotNull(), F.collect_list(span).over(near)).alias("near"))
    nested = "(x.start <= span.start and span.end <= x.end or span.start <= x.start and x.end <= span.end)"
    order = "struct(x.strength, x.end - x.start, -x.rank) > struct(span.strength, span.end - span.start, -span.rank)"
    met = met.select("row", "doc_id", "n_words", "span", F.expr(f"exists(near, x -> x.rank is not null and {nested} and {order})").alias("beaten"))
    each = lambda test: F.array_sort(F.collect_list(F.when(test, F.col("span"))))
    return met.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), each(F.col("span.base")).alias("base"), each(~F.col("beaten")).alias("spans")).drop("row")


def digest(found: DataFrame) -> DataFrame:
    """Counts and places of the base phrases, labels, and a score: the strength of the strongest detection, 4 as 1."""
    labels = lambda *spans: F.array_sort(F.array_distinct(F.concat(*[F.transform(s, lambda x: x["label"]) for s in spans])))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).cast("long").alias("last_word"),
        F.concat_ws(",", labels("base")).alias("base_labels"), F.concat_ws(",", labels("base", "spans")).alias("labels"),
        (F.coalesce(F.array_max(F.transform("spans", lambda x: x["strength"])), F.lit(0)) / 4).alias("score"),
    )
