"""Event deduplication, near-duplicate claims, conflicts, exposures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.functions.columns import claim_tokens, codes
from pitmark.operators.components import components
from pitmark.operators.row_quality import with_codes
from pitmark.operators.scratch import materialise

#: Tokens that are told apart by how common they are; the table is sent to every task.
_COMMON = 20_000
#: What it costs to write and deal a row, in comparisons of two rows that lie together.
_ROW = 16
#: Sets that lie together when pairs are compared in full.
_TILE = 1024
_OFFICIAL = ("PRIMARY_OFFICIAL", "COMPANY_OFFICIAL")


def canonical_events(events: DataFrame) -> DataFrame:
    """One row for each original: its key is the parent's id, else its own if it is a parent, else its content.

    One level only: a repost of a repost stays with its direct parent. The
    attributes are those of the row that was available first.
    """
    parents = events.where("original_event_id is not null").select(F.col("original_event_id").alias("event_id")).distinct().withColumn("parent", F.lit(True))
    e = events.join(parents, "event_id", "left")
    key = F.coalesce(F.col("original_event_id").cast("string"), F.when(F.col("parent"), F.col("event_id").cast("string")), F.col("content_hash"))
    first = F.struct("first_available_at", "event_id")
    return e.withColumn("canonical_event_id", key).groupBy("security_code", "canonical_event_id").agg(
        F.min_by("direction", first).alias("direction"), F.min_by("novelty", first).alias("novelty"), F.min("event_at").alias("event_at"), F.min("published_at").alias("first_published_at"), F.min("first_available_at").alias("first_available_at"), F.max("captured_at").alias("last_captured_at"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"), F.array_sort(F.collect_set("source_role")).alias("source_roles"), F.count("*").alias("diffusion_count"), F.count_distinct("source_id").alias("source_diversity"), F.bool_or(F.col("source_role").isin(*_OFFICIAL)).alias("official_fact_seen"),
    )


def relation_violations(events: DataFrame) -> DataFrame:
    """Ids used twice, parents that are missing or belong to another security."""
    twice = events.groupBy("event_id").agg(F.count("*").alias("n")).where("n > 1").select("event_id", F.lit("DUPLICATE_EVENT_ID").alias("code"))
    parent = events.select(F.col("event_id").alias("original_event_id"), F.col("security_code").alias("p_code"))
    j = events.where("original_event_id is not null").join(parent, "original_event_id", "left")
    return twice.unionByName(with_codes(j, ["event_id"], (F.col("p_code").isNull(), "MISSING_ORIGINAL"), (F.col("p_code") != F.col("security_code"), "RELATION_CROSSES_SECURITIES")))


def context_components(events: DataFrame, scope: Sequence[str] = ("security_code",)) -> DataFrame:
    """(event_id, component): transitive over republishing, equal origin and equal content within a scope.

    Where events state a ``relation_type``, corrections, supplements and the
    like stay events of their own: only standalone, original and republished
    rows are tied by key, and only a republished row to its original. Rows of a
    key are tied to its smallest id, so a very frequent key makes a star and
    not a clique.
    """
    kinds = "relation_type" in events.columns
    same = events.where(F.col("relation_type").isin("STANDALONE", "ORIGINAL", "REPUBLISHED")) if kinds else events
    repeats = events.where("relation_type = 'REPUBLISHED'") if kinds else events
    star = lambda key: same.join(same.groupBy(*scope, key).agg(F.min("event_id").alias("least")), [*scope, key]).select(F.col("event_id").alias("src"), F.col("least").alias("dst"))
    ties = star("origin_id").unionByName(star("content_hash")).unionByName(repeats.where("original_event_id is not null").select(F.col("event_id").alias("src"), F.col("original_event_id").alias("dst")))
    found = components(ties).withColumnRenamed("node", "event_id")
    return events.join(found, "event_id", "left").withColumn("component", F.coalesce("component", "event_id"))


def window_tags(age_days: Column) -> Column:
    """Tags of the windows an event of this age in days lies in, ends included."""
    return codes((age_days <= 120, "120d"), (age_days <= 30, "30d"), (age_days <= 7, "7d"), (age_days <= 3, "72h"))


def context_canonical(in_components: DataFrame, decision: Column) -> DataFrame:
    """One row for each component: the first available member, sources, window tags and conflicts of direction."""
    first = F.struct("first_available_at", "event_id")
    g = in_components.groupBy("component").agg(
        F.min("event_id").alias("least_id"), F.min("first_available_at").alias("first_available_at"), F.min_by("event_id", first).alias("canonical_id"), F.count("*").alias("members"), F.array_sort(F.collect_set("source_id")).alias("source_ids"),
        F.array_sort(F.collect_set(F.when(F.col("direction") != "NEUTRAL", F.col("direction")))).alias("directions"), F.count_distinct("security_code").alias("scopes"),
    )
    age = (F.unix_micros(decision.cast("timestamp")) - F.unix_micros(F.col("first_available_at").cast("timestamp"))) / 86_400_000_000
    return g.select(
        F.concat(F.lit("ctx-"), F.substring(F.sha2(F.col("component").cast("string"), 256), 1, 16)).alias("context_id"), "canonical_id", "members", "source_ids", "first_available_at", window_tags(age).alias("windows"),
        codes((F.size("directions") > 1, "DIRECTION_CONFLICT"), (F.col("scopes") > 1, "SCOPE_CONFLICT")).alias("codes"),
    )


def fold_fact_status(rows: DataFrame, key: str) -> DataFrame:
    """Factual, contradiction and correction status of a group, worst first."""
    any_ = lambda c, x: F.bool_or(F.col(c) == x)
    fact = F.when(any_("factual_status", "DISPUTED"), "DISPUTED").when(any_("factual_status", "CONFIRMED"), "CONFIRMED").otherwise("UNCONFIRMED")
    against = F.when(any_("direction", "POSITIVE") & any_("direction", "NEGATIVE"), "CONTRADICTED").otherwise("CONSISTENT")
    return rows.groupBy(key).agg(fact.alias("factual_status"), against.alias("contradiction_status"), F.when(F.bool_or("corrected"), "CORRECTED").otherwise("ORIGINAL").alias("correction_status"))


def _ordered_prefixes(df: DataFrame, jaccard: float, depth: int, common: list) -> DataFrame:
    """Rows (b, set, row, n, hashes of tokens) with their first tokens in one order, rare ones first, and 256 parity bits as w0 to w3; nothing is shuffled."""
    known = np.array([r[0] for r in common], np.int64)
    place = np.argsort(known)
    known, often = known[place], np.array([r[1] for r in common], np.int64)[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            lists = rows.column("hashes")
            n, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            df_ = np.zeros(len(flat), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                df_ = np.where(known[at] == flat, often[at], 0)
            first = np.floor((1 - jaccard) * n).astype(np.int32)
            # two tokens with one hash stand side by side: they only make more candidates
            flat = flat[np.lexsort((flat, df_, row))]
            kept = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(first + depth, n)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(n)))]).astype(np.int32)
            odd = np.zeros((len(n), 256), np.uint8)
            step = max(1, (1 << 22) // 256)
            for k in range(0, len(n), step):
                here = (row >= k) & (row < k + step)
                some = min(step, len(n) - k)
                odd[k : k + some] = (np.bincount((row[here] - k) * 256 + (flat[here] & 255), minlength=some * 256) & 1).reshape(some, 256)
            words = np.packbits(odd, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("b", "set", "row", "n")], pa.array(first), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[kept])), *[pa.array(np.ascontiguousarray(words[:, w])) for w in range(4)]], names=out)

    kind = df.schema["set"].dataType.simpleString()
    out = ["b", "set", "row", "n", "first", "prefix", "w0", "w1", "w2", "w3"]
    return df.mapInArrow(run, f"b long, set {kind}, row long, n int, first int, prefix array<long>, w0 long, w1 long, w2 long, w3 long")


def prefix_candidates(sets: DataFrame, block: Sequence[str], jaccard: float, group: int = 64, depth: int = 4) -> DataFrame:
    """(set, other), set < other: pairs of token sets of a block that may have this Jaccard similarity; none that has it is missing.

    ``sets``: the block's columns, set, n and tokens, and ``row``, a number of the
    row, if it has one; a set may be there more than once. In one order of all tokens,
    the commonest last, two such sets share k tokens of their first
    floor((1 - j) n) + k. So they meet by their first common token. Where more than
    ``group`` sets have it there, they meet by their first two, three and up to
    ``depth`` instead, if that takes fewer comparisons: a token that very many
    sets share never ties all of them, and sets that share all their tokens are
    not met once for each combination. A pair
    that meets by its first k common tokens, the last at places p and q, has
    k + min(n - p, m - q) in common at most. Each set also has 256 bits, each the
    parity of how many of its tokens fall on it: two sets differ in as many
    tokens as bits at least. Pairs that have too few in common, or differ in too
    many, for their sizes are no candidates. Tokens are compared by 64-bit hashes
    and sets by numbers, so a place in a prefix is a row of a few numbers.
    """
    pairs, rows = _candidates(sets, block, jaccard, group, depth)
    name = lambda x: rows.select(F.col("row").alias(f"{x}_row"), F.col("set").alias(f"{x}_set"))
    named = pairs.join(name("a"), F.col("row") == F.col("a_row")).join(name("b"), F.col("other") == F.col("b_row"))
    return named.select(F.least("a_set", "b_set").alias("set"), F.greatest("a_set", "b_set").alias("other"))


def _candidates(sets: DataFrame, block: Sequence[str], jaccard: float, group: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """``prefix_candidates`` as (row, other) by the number of one row of each set, and the table of sets with these."""
    numbers = sets if "row" in sets.columns else materialise(sets.withColumn("row", F.monotonically_increasing_id()), "numbered")
    for c in block:
        numbers = numbers.where(F.col(c).isNotNull())
    hashed = numbers.select(F.xxhash64(*block).alias("b"), "set", "row", "n", F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))
    # any one order of tokens will do; the commonest come last, all others are as rare as each other
    common = hashed.select(F.explode("hashes").alias("token")).groupBy("token").agg(F.count("*").alias("df")).orderBy(F.desc("df"), "token").limit(_COMMON).collect()
    bits = ["w0", "w1", "w2", "w3"]
    rows = materialise(_ordered_prefixes(hashed, jaccard, depth, common).dropDuplicates(["set"]), "rare")
    keys = rows.select("row", "n", "first", F.size("prefix").alias("held"), *bits, "b", F.posexplode(F.slice("prefix", 1, F.col("first") + 1)).alias("at", "token")).withColumn("key", F.xxhash64("b", "token"))
    found = None
    for k in range(1, depth + 1):
        # how many places a row would go on to, if its key were told apart further
        more = F.greatest(F.least(F.col("first") + k, F.col("held") - 1) - F.col("at"), F.lit(0))
        sized = materialise(keys.groupBy("key").agg(F.count("*").alias("c"), F.sum(more).alias("more")).where("c > 1"), "prefix-sizes")
        pairs_of = F.col("c") * (F.col("c") - 1) / 2
        hot = sized.where((F.col("c") > group) & (pairs_of > _ROW * F.col("more")))
        told, longer = None, None
        if k < depth and not hot.isEmpty():
            later = keys.join(hot.select("key"), "key").select("key", "row", "at").join(rows, "row")
            later = later.where(F.col("at") + 1 <= F.least(F.col("first") + k, F.size("prefix") - 1)).withColumn("next", F.explode(F.sequence(F.col("at") + 1, F.least(F.col("first") + k, F.size("prefix") - 1))))
            longer = materialise(later.select(F.col("key").alias("parent"), "row", "n", "first", F.size("prefix").alias("held"), *bits, F.col("next").alias("at"), F.xxhash64("key", F.get("prefix", F.col("next"))).alias("key")), "prefixes")
            left = longer.groupBy("parent", "key").agg(F.count("*").alias("m")).groupBy("parent").agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("left"))
            told = materialise(hot.join(left, hot["key"] == left["parent"], "left").where(F.coalesce("left", F.lit(0.0)) + _ROW * F.col("more") < pairs_of).select("key"), "told-apart")
        chosen = (sized if told is None else sized.join(told, "key", "left_anti")).select("key")
        # both sides are one plan, so that places are dealt once
        places = keys.join(chosen, "key").select("key", "row", "n", "at", *bits)
        here, theirs = places.alias("here"), places.alias("theirs")
        n, m, at, there = F.col("here.n"), F.col("theirs.n"), F.col("here.at"), F.col("theirs.at")
        least = F.ceil(jaccard / (1 + jaccard) * (n + m) - 1e-9)
        differ = sum((F.bit_count(F.col(f"here.{w}").bitwiseXOR(F.col(f"theirs.{w}"))) for w in bits), F.lit(0))
        enough = (k + F.least(n - 1 - at, m - 1 - there) >= least) & (differ <= n + m - 2 * least)
        met = here.join(theirs, F.col("here.key") == F.col("theirs.key")).where((F.col("here.row") < F.col("theirs.row")) & (F.least(n, m) >= jaccard * F.greatest(n, m)) & enough)
        close = met.select(F.col("here.row").alias("row"), F.col("theirs.row").alias("other"))
        found = close if found is None else found.unionByName(close)
        if told is None:
            break
        keys = longer.join(told.select(F.col("key").alias("parent")), "parent", "left_semi").drop("parent")
    return materialise(found.distinct(), "candidates"), rows


def _alike(close: DataFrame, numbers: DataFrame, words: DataFrame, containment: float, jaccard: float) -> DataFrame:
    """The pairs (row, other) of ``close`` whose words are nearly alike.

    Sets of one block and about one size are dealt to tiles of some ``_TILE``
    sets, and a pair belongs to the cell of both its tiles. The words of a set go
    to each cell once, however many pairs it has there, and a cell holds two
    tiles at most.
    """
    grade = F.floor(F.log("n") / -np.log(jaccard))
    sizes = numbers.select("row", "b", grade.alias("grade"))
    parts = sizes.groupBy("b", "grade").agg(F.ceil(F.count("*") / _TILE).alias("parts"))
    tiles = sizes.join(parts, ["b", "grade"]).select("row", F.xxhash64("b", "grade", F.pmod(F.xxhash64("row"), "parts")).alias("tile"))
    theirs = tiles.select(F.col("row").alias("other"), F.col("tile").alias("their_tile"))
    cell = F.xxhash64(F.least("tile", "their_tile"), F.greatest("tile", "their_tile"))
    placed = materialise(close.join(tiles, "row").join(theirs, "other").select("row", "other", cell.alias("cell")), "cells")
    needed = placed.select(F.col("cell").alias("place"), F.explode(F.array("row", "other")).alias("row")).distinct()

    def verify(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        rows = texts.column("row").to_numpy()
        lists = pc.split_pattern(texts.column("words").combine_chunks(), " ")
        n, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().dictionary_encode().indices.to_numpy()
        owner = np.repeat(np.arange(len(n)), n)
        # a word of one text alone is in no intersection
        shared = np.bincount(flat) > 1
        kept = shared[flat]
        owner, flat = owner[kept], (np.cumsum(shared) - 1)[flat[kept]]
        bits = np.zeros((len(n), int(shared.sum()) // 64 + 1), np.uint64)
        np.bitwise_or.at(bits, (owner, flat >> 6), np.uint64(1) << (flat & 63).astype(np.uint64))
        order = np.argsort(rows)
        i, j = (order[np.searchsorted(rows[order], pairs.column(c).to_numpy())] for c in ("row", "other"))
        step = max(1, (1 << 22) // bits.shape[1])
        both = np.concatenate([np.zeros(0, np.int64), *[np.bitwise_count(bits[i[k : k + step]] & bits[j[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, len(i), step)]])
        good = (both >= containment * np.minimum(n[i], n[j])) & (both >= jaccard * (n[i] + n[j] - both))
        return pairs.select(["row", "other"]).filter(pa.array(good))

    return words.join(needed, "row").select("place", "row", "words").groupBy("place").cogroup(placed.groupBy("cell")).applyInArrow(verify, "row long, other long")


def near_duplicate_pairs(findings: DataFrame, hours: int = 72, least_tokens: int = 6, containment: float = 0.90, jaccard: float = 0.82) -> DataFrame:
    """(a, b, why): same security, kind and direction, and one event or origin, or texts nearly alike and close in time.

    The pairs tie the same rows together as all pairs that qualify would, but no
    group of copies is expanded. Equal keys are tied to the smallest id of the
    key. Texts: rows with an equal set of tokens in one stretch of ``hours`` are
    tied to its smallest id, and stretches that follow within ``hours`` to each
    other; such a run then stands for its rows. Different sets that
    ``prefix_candidates`` names are compared in full, and then the runs of both
    that come within ``hours`` of each other are tied. Null texts have no tokens. Token sets and stretches are written to
    tables on the way.
    """
    f = findings.where("direction <> 'NEUTRAL'")
    block, span = ["security_code", "signal_kind", "direction"], hours * 3600

    def star(key: str) -> DataFrame:
        least = f.groupBy(*block, key).agg(F.min("finding_id").alias("a"))
        return f.join(least, [*block, key]).where("finding_id <> a").select("a", F.col("finding_id").alias("b"), F.lit(key).alias("why"))

    t = f.select(*block, "finding_id", F.unix_seconds(F.col("available_at").cast("timestamp")).alias("at"), F.array_join(F.array_sort(claim_tokens(F.col("claim_text"))), " ").alias("words"))
    key = F.unhex(F.sha2(F.concat_ws("\x1f", *block, "words"), 256))
    # written first and filtered after, or texts would be cut into tokens for the filter and once more for the table; a word holds no blank
    t = materialise(t.withColumn("stretch", F.floor(F.col("at") / span)).withColumn("row", F.monotonically_increasing_id()), "tokens")
    t = t.withColumn("tokens", F.filter(F.split("words", " "), lambda w: w != "")).withColumn("n", F.size("tokens")).where(F.col("n") >= least_tokens).withColumn("set", key)
    stretches = t.groupBy("set", "stretch").agg(F.min("finding_id").alias("rep"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    order = Window.partitionBy("set").orderBy("stretch")  # one row for each stretch of time, not for each text
    before = stretches.withColumn("last", F.lag("rep").over(order)).withColumn("breaks", F.coalesce(F.col("lo") - F.lag("hi").over(order) > span, F.lit(True)))
    stretches = materialise(before.withColumn("run", F.sum(F.col("breaks").cast("int")).over(order)), "stretches")
    copies = t.join(stretches.select("set", "stretch", "rep"), ["set", "stretch"]).where("finding_id <> rep").select(F.col("rep").alias("a"), F.col("finding_id").alias("b"))
    chain = stretches.where("not breaks").select(F.least("last", "rep").alias("a"), F.greatest("last", "rep").alias("b"))
    runs = stretches.groupBy("set", "run").agg(F.min("rep").alias("rep"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    close, numbers = _candidates(t.select(*block, "set", "row", "n", "tokens"), block, jaccard, 64, 4)
    words = t.select("row", "words")
    alike = _alike(close, numbers, words, containment, jaccard)
    number = lambda x, s: numbers.select(F.col("row").alias(x), F.col("set").alias(s))
    alike = alike.join(number("row", "set"), "row").withColumnRenamed("other", "other_row").join(number("other_row", "other"), "other_row").select("set", "other")
    theirs = runs.select(F.col("set").alias("other"), F.col("rep").alias("rep_"), F.col("lo").alias("lo_"), F.col("hi").alias("hi_"))
    met = alike.join(runs, "set").join(theirs, "other").where((F.col("lo") - F.col("hi_") <= span) & (F.col("lo_") - F.col("hi") <= span))
    texts = copies.unionByName(chain).unionByName(met.select(F.least("rep", "rep_").alias("a"), F.greatest("rep", "rep_").alias("b")))
    return star("event_key").unionByName(star("origin_id")).unionByName(texts.withColumn("why", F.lit("claim_text")))


def claim_clusters(findings: DataFrame, pairs: DataFrame) -> DataFrame:
    """(finding_id, cluster): connected components of the pairs, so that the order of rows plays no part."""
    found = components(pairs, "a", "b").select(F.col("node").alias("finding_id"), F.col("component").alias("cluster"))
    return findings.join(found, "finding_id", "left").withColumn("cluster", F.coalesce("cluster", "finding_id"))


def cluster_representatives(clustered: DataFrame, reliability: Column) -> DataFrame:
    """The strongest finding of each cluster; ties go to the larger id."""
    weight = F.round(reliability * F.col("strength") * F.col("materiality"), 12)
    g = clustered.groupBy("cluster").agg(F.max_by("finding_id", F.struct(weight, "finding_id")).alias("finding_id"), F.count("*").alias("members"), F.max(weight).alias("weight"))
    return g


def source_conflicts(findings: DataFrame, least: float = 0.35) -> DataFrame:
    """Events of which different publisher groups say opposite things, strongly enough.

    Per event the two sides' groups are counted and compared, so no pairs of
    findings are made: there is a conflict unless both sides are one same group.
    """
    strong = findings.where((F.round(F.col("strength") * F.col("materiality"), 9) >= least) & (F.col("direction") != "NEUTRAL"))
    side = lambda d: F.array_sort(F.collect_set(F.when(F.col("direction") == d, F.col("publisher_group"))))
    g = strong.groupBy("security_code", "signal_kind", "event_key").agg(side("POSITIVE").alias("positive"), side("NEGATIVE").alias("negative"))
    return g.where((F.size("positive") > 0) & (F.size("negative") > 0) & ~((F.size("positive") == 1) & (F.col("positive") == F.col("negative"))))


def exposure_violations(exposures: DataFrame, canonical: DataFrame, universe: DataFrame) -> DataFrame:
    """Exposures must name a known event and security, carry some of its evidence, and only sound ones are factors.

    Where events state them, further: evidence hashes, scope (security or
    sector), time of availability, factual and correction status and classes of
    source; where exposures state their type, its confirmation must fit.
    """
    has = lambda df, *names: all(c in df.columns for c in names)
    c = F.col
    told = [x for x in ("scope", "scope_key", "first_available_at", "factual_status", "correction_status", "source_classes", "evidence_hashes") if x in canonical.columns]
    j = exposures.join(canonical.select("canonical_event_id", F.col("source_ids").alias("e_sources"), *[c(x).alias(f"e_{x}") for x in told]), "canonical_event_id", "left").join(universe.select("security_code", F.lit(True).alias("listed")).distinct(), "security_code", "left")
    more = []
    if has(exposures, "exposure_type"):
        kind, said = c("exposure_type"), c("confirmation_class")
        more += [
            ((kind == "INFERRED_EXPOSURE") & (said != "ANALYTICAL_INFERENCE"), "INFERENCE_RELABELLED"), (kind.isin("DIRECT_NAMED", "CONTRACT_COUNTERPARTY") & (said == "ANALYTICAL_INFERENCE"), "DIRECT_EXPOSURE_AS_INFERENCE"),
            ((kind == "UNRESOLVED") != (said == "UNRESOLVED"), "UNRESOLVED_INCOHERENT"), ((kind == "UNRESOLVED") & c("factor_eligible"), "UNRESOLVED_FACTOR"),
        ]
        if has(canonical, "scope", "scope_key"):
            more.append(((kind == "DIRECT_NAMED") & (c("e_scope") == "SECURITY") & (c("e_scope_key") != c("security_code")), "SECURITY_SCOPE_CONFLICT"))
            more += [((kind == "SECTOR_EXPOSURE") & (c("e_scope") == "SECTOR") & (c("e_scope_key") != c("sector_code")), "SECTOR_SCOPE_CONFLICT")] if has(exposures, "sector_code") else []
        j = j.withColumn("__twice", F.count("*").over(Window.partitionBy("canonical_event_id", "security_code", "exposure_type")) > 1)
        more.append((c("__twice"), "DUPLICATE_EXPOSURE"))
    if has(canonical, "evidence_hashes") and has(exposures, "evidence_hashes"):
        more.append((~F.arrays_overlap("evidence_hashes", "e_evidence_hashes"), "EVIDENCE_HASHES_DO_NOT_BIND"))
    if has(canonical, "first_available_at") and has(exposures, "available_at"):
        more.append((c("available_at") < c("e_first_available_at"), "EXPOSURE_BEFORE_EVENT"))
    if has(canonical, "factual_status"):
        more.append((c("factor_eligible") & c("e_factual_status").isin("ROUTING_ONLY", "CONTESTED"), "FACTOR_FROM_CONTESTED_EVENT"))
    if has(canonical, "correction_status"):
        more.append((c("factor_eligible") & ~c("e_correction_status").isin("CURRENT", "CORRECTED"), "FACTOR_FROM_SUPERSEDED_EVENT"))
    if has(canonical, "source_classes"):
        weak = F.array(*map(F.lit, ("COMMUNITY", "SEARCH_ROUTING", "ARCHIVE")))
        more.append((c("factor_eligible") & (F.size("e_source_classes") > 0) & (F.size(F.array_except("e_source_classes", weak)) == 0), "FACTOR_FROM_WEAK_SOURCES"))
    return with_codes(
        j, ["exposure_id"], *more,
        (F.col("e_sources").isNull(), "EVENT_UNRESOLVED"), (F.col("listed").isNull(), "SECURITY_OUTSIDE_UNIVERSE"), (~F.arrays_overlap("sources", "e_sources"), "EVIDENCE_DOES_NOT_OVERLAP"),
        (F.col("factor_eligible") & ((F.col("confidence") < 0.5) | (F.col("contradiction_status") != "CONSISTENT")), "FACTOR_NOT_ELIGIBLE"),
    )


def repost_count(findings: DataFrame) -> DataFrame:
    return findings.agg((F.count("*") - F.count_distinct(F.struct("security_code", "origin_id", "event_key", "signal_kind"))).alias("reposts"))


def claim_support_violations(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """Each fact type needs its role among the cited sources; a community cannot establish facts alone.

    For fact types of tiers and legal standing see ``fact_type_violations``.
    """
    roles = claims.select("claim_id", F.explode("source_ids").alias("source_id")).join(sources, "source_id", "left").groupBy("claim_id").agg(F.collect_set("role").alias("roles"))
    j = claims.join(roles, "claim_id", "left").withColumn("roles", F.coalesce("roles", F.array().cast("array<string>")))
    only_social = (F.size("roles") > 0) & (F.size(F.array_except("roles", F.array(F.lit("SOCIAL")))) == 0)
    return with_codes(
        j, ["claim_id"],
        (~F.array_contains("roles", F.col("required_role")), "REQUIRED_ROLE_MISSING"), (only_social & (F.col("fact_type") == "FACT"), "COMMUNITY_CANNOT_ESTABLISH_FACT"),
        ((F.col("status") == "CONFIRMED") & ~F.array_contains("roles", F.lit("PRIMARY_OFFICIAL")), "CONFIRMED_WITHOUT_PRIMARY"),
    )


#: Fact types, the roles one of which must be cited, and the tiers one of which must be.
_REGISTERED = (("COMPANY_REGISTRATION", "FOUNDER_IDENTITY", "COMPANY_STATUS"), ("COMMERCIAL_REGISTRY", "OFFICIAL_GAZETTE", "COMPANY_DISCLOSURE"), ("PRIMARY_OFFICIAL", "PRIMARY_ARCHIVE"))
_LEGAL = (("LEGAL_ALLEGATION", "COURT_OUTCOME", "REGULATORY_ACTION"), ("COURT_RECORD", "REGULATORY_ACTION", "OFFICIAL_GAZETTE"))
_LEGAL_STATUS = ("ALLEGED", "REFERRED", "CHARGED", "DECIDED", "APPEALED", "FINAL")


def fact_type_violations(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """(claim_id, code): what a claim's fact type asks of the roles and tiers of its sources and of its legal status.

    ``claims``: claim_id, fact_type, source_ids, legal_status and factual_status;
    ``sources``: source_id, roles, tier.
    """
    each = claims.select("claim_id", F.explode_outer("source_ids").alias("source_id")).join(sources.select("source_id", "roles", "tier"), "source_id", "left")
    told = each.groupBy("claim_id").agg(F.array_distinct(F.flatten(F.collect_list("roles"))).alias("roles"), F.collect_set("tier").alias("tiers"), F.count_if(F.col("source_id").isNotNull() & F.col("tier").isNull()).alias("unknown"), F.count("source_id").alias("cited"))
    j, kind = claims.join(told, "claim_id"), F.upper(F.trim("fact_type"))
    among = lambda c, names: F.arrays_overlap(c, F.array(*map(F.lit, names)))
    legal = kind.isin(*_LEGAL[0])
    only_weak = (F.size("tiers") > 0) & (F.size(F.array_except("tiers", F.array(F.lit("COMMUNITY"), F.lit("ROUTING_ONLY")))) == 0)
    return with_codes(
        j, ["claim_id"],
        (F.col("cited") == 0, "NO_SOURCE"), (F.col("unknown") > 0, "UNKNOWN_SOURCE"), (kind.isin(*_REGISTERED[0]) & ~among("roles", _REGISTERED[1]), "REGISTRY_ROLE_MISSING"), (kind.isin(*_REGISTERED[0]) & ~among("tiers", _REGISTERED[2]), "PRIMARY_TIER_MISSING"),
        (legal & ~among("roles", _LEGAL[1]), "LEGAL_ROLE_MISSING"), (legal & ~F.coalesce(F.col("legal_status").isin(*_LEGAL_STATUS), F.lit(False)), "LEGAL_STATUS_MISSING"), ((kind != "SOCIAL_SENTIMENT") & only_weak, "COMMUNITY_CANNOT_ESTABLISH_FACT"),
        ((F.col("factual_status") == "OFFICIAL_CONFIRMED") & ~F.array_contains("tiers", "PRIMARY_OFFICIAL"), "CONFIRMED_WITHOUT_PRIMARY"),
    )


def empty_year_support(records: DataFrame) -> DataFrame:
    """``No event found`` counts if the declared sources are those of the receipts and every receipt is complete."""
    got = F.transform("receipts", lambda r: r.source_id)
    why = codes((F.size(F.array_except("declared", got)) > 0, "SOURCE_WITHOUT_RECEIPT"), (F.size(F.array_except(got, F.col("declared"))) > 0, "RECEIPT_OF_UNDECLARED_SOURCE"), (~F.forall("receipts", lambda r: r.complete), "RECEIPT_INCOMPLETE"))
    return records.select("record_id", why.alias("codes"))


def annual_coverage_plan(layers: DataFrame, sources: DataFrame, first: int, last: int) -> DataFrame:
    """layer x year with the sources that reach back so far."""
    grid = layers.select("layer", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    s = sources.select("layer", "source_id", "from_year")
    g = grid.join(s, "layer", "left").groupBy("layer", "year").agg(F.array_sort(F.collect_set(F.when(F.col("from_year") <= F.col("year"), F.col("source_id")))).alias("source_ids"))
    return g.withColumn("status", F.when(F.size("source_ids") == 0, "UNCOVERED").when(F.size("source_ids") == 1, "SINGLE_SOURCE").otherwise("COVERED"))
