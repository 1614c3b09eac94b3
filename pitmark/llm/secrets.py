"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitmark.llm.common import unused
from pitmark.operators.scratch import materialise


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORD = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
#: Kinds in order: name, pattern, group of the value, least characters of the value.
KINDS = (
    ("assign", f"({_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("owned", "[A-Za-z0-9+/_-]{20,}", 0, 20),
)
_PART = "array<struct<k:int,i:int,gap:int,size:int,gap_bytes:int,size_bytes:int,value:string>>"


def _parts(k: int) -> Column:
    """What lies before each match of a kind, and the match: lengths in code points, in order; one pass over the text."""
    _, pattern, group, _ = KINDS[k]
    literal = "r'" + pattern.replace("'", "\\x27") + "'"
    return F.expr(
        f"transform(arrays_zip(regexp_extract_all(text, {literal}, 0), regexp_extract_all(text, {literal}, {group}), split(text, {literal}, -1)), "
        f"(x, i) -> named_struct('k', {k}, 'i', i, 'gap', length(x['2']), 'size', length(x['0']), 'gap_bytes', octet_length(x['2']), 'size_bytes', octet_length(x['0']), 'value', x['1']))"
    )


def _spans(rows: DataFrame) -> DataFrame:
    """(row, owner, part, start, k, end, value, and start and end in bytes) of all candidates.

    Offsets are running sums over a text's parts, one window for each text and
    kind. A bare token counts if no base span overlaps it: of the base spans
    that start before its end, the one that reaches farthest must end before it.
    """
    running = Window.partitionBy("row", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    part = rows.where("size(parts) > 0").select("row", "owner", "part", F.explode("parts").alias("x")).select("row", "owner", "part", "x.*")
    end = lambda gap, size: F.sum(F.col(gap) + F.coalesce(size, F.lit(0))).over(running).cast("int")
    each = part.withColumns({"end": end("gap", "size"), "end_byte": end("gap_bytes", "size_bytes")}).where("size is not null")
    each = each.withColumns({"start": (F.col("end") - F.col("size")).cast("int"), "start_byte": (F.col("end_byte") - F.col("size_bytes")).cast("int")})
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("k") + 1)
    n = lambda kept: F.length(F.regexp_replace("value", kept, ""))
    each = each.where((F.length("value") >= least) & ((F.col("k") < 3) | ((n("[^0-9]") >= 4) & (n("[^A-Za-z]") >= 4))))
    base = F.col("k") < 3
    before = Window.partitionBy("row").orderBy(F.when(base, F.col("start")).otherwise(F.col("end")), base).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(base, F.col("end"))).over(before)
    return each.withColumn("reach", reach).where(base | F.col("reach").isNull() | (F.col("reach") <= F.col("start"))).select("row", "owner", "part", "start", "k", "end", "value", "start_byte", "end_byte")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", part_col: str = "lang", *, example_owners: int = 3) -> DataFrame:
    """Spans of secrets in whole texts, told apart by who else has them.

    Per row of ``docs``: doc_id, base and spans: arrays of (start, k, end, kind,
    value_sha256, owners, repositories, standing, start_byte, end_byte), by
    start, then kind; offsets in code points, end exclusive; and text_md5 where there are candidates. The base kinds are pattern matches: assign,
    access and hex. A repository is an owner's part of the corpus (``owner_col``
    with ``part_col``). The hashes of all candidate values are counted over the
    whole corpus: ``example`` if ``example_owners`` owners or more have the
    value, ``live`` if one has, else ``shared``. Tokens of 20 or more
    characters with four digits and four letters that stand outside the base
    spans are candidates too, and are added, as kind ``owned``, where a single
    owner has them: a value copied widely is no owner's credential.

    Null text is empty; null owners and parts count as one owner and part; a
    null id stays null; repeated rows get a row each; an empty table gives no
    rows; other columns are ignored. A text's matches are held as one array, and
    time grows with the text, however many there are. A hash that very many rows share is counted per task and owner before the
    shuffle, and the join back to its rows has an exchange on either side.
    """
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[owner_col].cast("string"), F.lit("")).alias("owner"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    empty = F.expr(f"cast(array() as {_PART})")
    parts = F.concat(*[F.when(F.col("text").rlike(KINDS[k][1]), _parts(k)).otherwise(empty) for k in range(4)])
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "part", parts.alias("parts"), F.col("text"))
    rows = materialise(rows.select("row", "doc_id", "owner", "part", "parts", F.when(F.size("parts") > 0, F.md5(F.encode("text", "utf-8"))).alias("text_md5")), "hits")
    each = materialise(_spans(rows).withColumn("value_sha256", F.sha2("value", 256)).drop("value"), "spans")
    owners = (
        each.select("value_sha256", "owner", "part").distinct()
        .groupBy("value_sha256", "owner").agg(F.count("*").alias("n"))
        .groupBy("value_sha256").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )
    standing = F.when(F.col("owners") >= example_owners, "example").when(F.col("owners") == 1, "live").otherwise("shared")
    owners = materialise(owners.withColumn("standing", standing), "owners")
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("k") + 1)
    joined = each.join(owners, "value_sha256").where("k < 3 or standing = 'live'")
    span = F.struct("start", "k", "end", kind.alias("kind"), "value_sha256", "owners", "repositories", "standing", "start_byte", "end_byte")
    spans = joined.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    out = rows.select("row", "doc_id", "text_md5").join(spans, "row", "left")
    found = F.coalesce("spans", F.expr("filter(array(named_struct('start', 0, 'k', 0, 'end', 0, 'kind', '', 'value_sha256', '', 'owners', 0L, 'repositories', 0L, 'standing', '', 'start_byte', 0, 'end_byte', 0)), x -> false)"))
    return out.select("doc_id", "text_md5", found.alias("spans")).select("doc_id", F.expr("filter(spans, x -> x.k < 3)").alias("base"), "spans", "text_md5")


def digest(spans: DataFrame) -> DataFrame:
    """Counts by kind and standing, the digest of the base spans, and all spans as text."""
    said = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))
    count = lambda test: F.expr(f"cast(size(filter(spans, x -> {test})) as bigint)")
    return spans.select(
        "doc_id",
        *[count(f"x.kind = '{k[0]}'").alias(f"n_{k[0]}") for k in KINDS],
        F.sha2(said("base"), 256).alias("base_sha256"),
        said("spans").alias("spans"),
        *[count(f"x.standing = '{s}'").alias(f"n_{s}") for s in ("live", "shared", "example")],
    )


def redact(docs: DataFrame, spans: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with live and shared spans overwritten by ``mark``; widely copied examples stay.

    ``spans`` is of ``secret_spans`` over the same rows. What stands in a text
    depends on the text and the corpus alone, so rows find their spans by the
    text's digest: repeated and null ids do no harm. Only texts that match a
    pattern are shuffled for that; all others pass by. Spans that overlap or
    touch nothing between them are cut once: where a span starts before the
    farthest end of those before it, it belongs to their cut. A text is then
    split at the bytes where cuts begin and end, in time that grows with text
    and cuts. All rows and all other columns are kept, whatever their names.
    """
    md5, cuts, raw = unused(docs, "md5", "cuts", "raw")
    chosen = spans.where("text_md5 is not null").select("text_md5", F.expr("filter(spans, x -> x.standing <> 'example')").alias("spans")).where(F.size("spans") > 0).dropDuplicates(["text_md5"])
    each = chosen.select("text_md5", F.explode("spans").alias("x")).select("text_md5", "x.start", "x.k", "x.start_byte", "x.end_byte")
    order = Window.partitionBy("text_md5").orderBy("start", "k")
    reach = F.max("end_byte").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start_byte") >= reach, F.lit(True)).cast("int")
    numbered = each.withColumn("new", new).withColumn("cut", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("text_md5", "cut").agg(F.min("start_byte").alias("start"), F.max("end_byte").alias("end"))
    merged = merged.groupBy(F.col("text_md5").alias(md5)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts))
    matches = F.lit(False)
    for _, pattern, _, _ in KINDS:
        matches = matches | F.col(text_col).rlike(pattern)
    matches = F.coalesce(matches, F.lit(False))
    # the bytes are made before the join, once for each text: a place in bytes is reached at once
    some = docs.where(matches).withColumn(raw, F.encode(F.col(text_col), "utf-8")).withColumn(md5, F.md5(raw)).drop(text_col).join(merged, md5, "left")
    end, start = lambda i: F.coalesce(F.get(F.col(cuts), i - 1)["end"], F.lit(0)), lambda i: F.coalesce(F.get(F.col(cuts), i)["start"], F.octet_length(raw))
    # a lambda's variable is read once; a column of bytes would be copied for each cut
    pieces = lambda all_: F.transform(F.sequence(F.lit(0), F.coalesce(F.size(cuts), F.lit(0))), lambda i: F.decode(F.substring(all_, end(i) + 1, start(i) - end(i)), "utf-8"))
    kept = F.element_at(F.transform(F.array(F.col(raw)), pieces), 1)
    some = some.withColumn(text_col, F.when(F.col(cuts).isNull(), F.decode(F.col(raw), "utf-8")).otherwise(F.array_join(kept, mark))).select(*docs.columns)
    return docs.where(~matches).unionByName(some)
