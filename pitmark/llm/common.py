"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitmark.operators.components import contract  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: the fold a row belongs to."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def hashed(key: str, salt: int = 0) -> Column:
    """A number below 2**40 that stands for the key."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 40))


def share_for(n: int, total: int) -> int:
    """A bound of ``hashed`` that about 4 n of ``total`` keys lie below: the n smallest are among them."""
    return (1 << 40) if total <= 4 * n else (1 << 40) * 4 * n // total


def smallest(df: DataFrame, key: str, n: int, total: int, salt: int = 0) -> DataFrame:
    """The n rows with the smallest hash of their key; what any task sorts or sends is bounded by a few n in all."""
    return df.where(hashed(key, salt) < share_for(n, total)).orderBy(hashed(key, salt), key).limit(n)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python at most ``rows`` rows at once: whole texts can be long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of the columns of ``df`` in either case."""
    here, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in here:
            name = "_" + name
        here.add(name.lower())
        found.append(name)
    return found


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch with the columns in the schema's order."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a text column; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def annotate(df: DataFrame, text_col: str, factory: Callable, fields: list[T.StructField]) -> DataFrame:
    """``df`` with columns that ``factory()(texts)`` gives for each batch of texts; rows keep their other columns and stay where they are."""
    place, names = df.columns.index(text_col), [*df.columns, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = factory()
        for b in batches:
            new = made(texts_of(b.column(place)))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, new)], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))
