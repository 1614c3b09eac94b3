"""Sources and sinks: exact contracts on the way in, ordered files on the way out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitmark.functions.columns import host, registrable_domain
from pitmark.operators.ordered import Sums, running

_BAD = "_corrupt_record"


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])


def header_errors(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, code) for each file whose first line is not exactly the contract's header; a byte-order mark is ignored."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value"), F.monotonically_increasing_id().alias("n"))
    first = lines.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    names = F.transform(F.split(F.regexp_replace("header", "^﻿|\r$", ""), ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    want = F.array(*[F.lit(f.name) for f in schema.fields])
    code = F.when(F.size(F.array_distinct(names)) < F.size(names), "DUPLICATE_HEADER").when(names != want, "HEADER_MISMATCH")
    return first.select("file", code.alias("code")).where("code is not null")


def _records(lines: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Records of (file, block, n, head, value) lines, and error rows of those that don't end within ``longest`` lines.

    A line feed belongs to a record if the quotes before it in its file are odd
    in number. They are counted by a running sum over the ordered lines of a
    file, which goes on from task to task, so a record may lie across the splits
    of a file and a file across many tasks. Without any line of odd quotes, lines are records.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = lines.withColumn("odd", (quotes % 2).cast("long"))
    none = lines.select(F.col("value").alias("raw"), F.lit("").alias("code")).where("false")
    if lines.where("odd = 1").isEmpty():
        return lines.drop("odd", "block"), none
    key, order = ["file"], ["block", "n"]
    at = running(lines, key, order, Sums(open="odd")).withColumn("begins", ((F.col("open") - F.col("odd")) % 2 == 0).cast("long"))
    at = running(at.drop("open"), key, order, Sums(record="begins"))
    place = F.struct("block", "n")
    sizes = at.groupBy("file", "record").agg(F.count("*").alias("size"), F.min_by("value", place).alias("first"), F.min_by("n", place).alias("n"), F.min_by("head", place).alias("head"))
    one = sizes.where("size = 1").select("file", "n", "head", F.col("first").alias("value"))
    # a quote that never closes is no reason to hold a file in one row
    long = sizes.where(F.col("size") > longest).select(F.col("first").alias("raw"), F.lit("RECORD_NOT_CLOSED").alias("code"))
    several = sizes.where((F.col("size") > 1) & (F.col("size") <= longest)).select("file", "record", F.col("n").alias("first_n"), F.col("head").alias("first_head"))
    joined = at.join(several, ["file", "record"]).groupBy("file", "record", "first_n", "first_head").agg(F.array_sort(F.collect_list(F.struct("block", "n", "value"))).alias("x"))
    return one.unionByName(joined.select("file", F.col("first_n").alias("n"), F.col("first_head").alias("head"), F.array_join("x.value", "\n").alias("value"))), long


def read_contract_csv(spark: SparkSession, path: str, schema: T.StructType, longest: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Good rows and error rows of CSV files with this header; rows that are too wide or too narrow, or do not parse, are error rows.

    A quoted cell may hold line feeds, and quotes that are doubled; a record of
    more than ``longest`` lines is an error row of its first line. A byte-order
    mark and carriage returns at the ends of lines are ignored. The first line
    of every file must be exactly the header, or the whole read is refused with
    an error that names the files; a later record that repeats it is an error row.
    """
    wrong = [f"{r.file}: {r.code}" for r in header_errors(spark, path, schema).limit(5).collect()]
    if wrong:
        raise ValueError("files out of contract: " + "; ".join(wrong))
    line = F.regexp_replace("value", "^\ufeff|\r$", "")
    block = F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select(line.alias("value"), block.alias("block"), (block == 0).alias("head"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    lines, unclosed = _records(lines, longest)
    header = ",".join(f.name for f in schema.fields)
    first = lines.where(F.col("head") & (F.col("value") == header)).groupBy("file").agg(F.min("n").alias("n"))
    repeated = lines.where(F.col("value") == header).join(first, ["file", "n"], "left_anti").select(F.col("value").alias("raw"), F.lit("HEADER_REPEATED").alias("code"))
    lines = lines.where((F.trim("value") != "") & (F.col("value") != header)).select("value")
    parsed = lines.select("value", F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _with_bad(schema).fields), {"mode": "PERMISSIVE", "escape": '"', "columnNameOfCorruptRecord": _BAD}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{_BAD}").isNotNull()
    return parsed.where(~bad).select("r.*").drop(_BAD), parsed.where(bad).select(F.col("value").alias("raw"), F.lit("ROW_NOT_IN_CONTRACT").alias("code")).unionByName(repeated).unionByName(unclosed)


def read_contract_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows and error rows of JSON lines; a malformed line is an error row."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", _with_bad(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{_BAD}").isNotNull()
    extra = F.size(F.array_except(F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>")), F.array(*[F.lit(f.name) for f in schema.fields]))) > 0
    good = parsed.where(~bad & ~extra).select("r.*").drop(_BAD)
    wrong = parsed.where(bad | extra).select(F.col("value").alias("raw"), F.when(bad, "MALFORMED_LINE").otherwise("UNKNOWN_FIELD").alias("code"))
    return good, wrong


MANIFEST = T.StructType([T.StructField("artifacts", T.ArrayType(T.StructType([T.StructField(n, T.LongType() if n == "size_bytes" else T.StringType()) for n in ("path", "sha256", "size_bytes", "source_id", "source_url", "observed_at", "content_type")])))])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each artifact of the manifests."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(F.inline("artifacts"))


def verify_artifacts(manifest: DataFrame, folder: str) -> DataFrame:
    """(name, code): digest and size of each raw file against the manifest; files on one side only.

    Names are paths below ``folder``; a manifest may put the folder's own name before them.
    """
    raw = manifest.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    parts = [p for p in folder.split("://", 1)[-1].split("/") if p]
    # what follows the folder's path in a file's address, whatever scheme stands before it
    root = "/" + "/".join(parts) + "/"
    files = raw.select(F.expr(f"substring(path, instr(path, '{root}') + {len(root)})").alias("name"), F.sha2("content", 256).alias("actual_sha256"), F.col("length").alias("actual_size"))
    want = manifest.select(F.regexp_replace("path", rf"^(\./)*(\Q{parts[-1]}\E/)?", "").alias("name"), "sha256", "size_bytes")
    j = want.join(files, "name", "full_outer")
    code = F.when(F.col("actual_sha256").isNull(), "MISSING").when(F.col("sha256").isNull(), "UNREFERENCED").when(F.col("sha256") != F.col("actual_sha256"), "HASH_MISMATCH").when(F.col("size_bytes") != F.col("actual_size"), "SIZE_MISMATCH").otherwise("OK")
    return j.select("name", code.alias("code"))


def write_dataset(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Files in key order; an existing dataset is never overwritten."""
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)


#: Columns by level of detail, and those that every export carries.
LEVELS = {"SUMMARY": ("security_code", "rank", "score"), "STANDARD": ("security_code", "rank", "score", "evidence_coverage", "groups", "reasons"), "FULL": ("*",)}
AUDIT = ("status", "scope_label", "selected")


def export_projection(ranked: DataFrame, level: str, fields: Sequence[str] = ()) -> DataFrame:
    """The columns of a level and those asked for, always with the audit columns."""
    base = ranked.columns if LEVELS[level] == ("*",) else LEVELS[level]
    return ranked.select(*dict.fromkeys([*base, *fields, *AUDIT]))


def page_contract_report(pages: DataFrame, headers: Sequence[str] = (), blockers: str = "captcha|access denied|verify you are human") -> DataFrame:
    """Per registrable domain: pages, pages with a table, with all headers, and with an access blocker."""
    text = F.lower("html")
    p = pages.select(registrable_domain(host(F.col("url"))).alias("domain"), text.contains("<table").alias("table"), F.forall(F.array(*map(F.lit, headers)).cast("array<string>"), lambda h: F.contains(text, h)).alias("headers"), text.rlike(blockers).alias("blocked"))
    n = lambda c: F.sum(F.col(c).cast("int"))
    g = p.groupBy("domain").agg(F.count("*").alias("pages"), n("table").alias("with_table"), n("headers").alias("with_headers"), n("blocked").alias("blocked"))
    return g.withColumn("code", F.when(F.col("blocked") > 0, "BLOCKED").when(F.col("with_table") < F.col("pages"), "TABLE_DRIFT").otherwise("OK"))
