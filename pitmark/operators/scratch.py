"""Tables that cut lineage: Parquet in the folder all executors share. How many tasks small rows that grow are dealt to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; on a local master that has none, a temporary folder.

    Executors of a cluster don't share the driver's disk, so there a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="pitmark-")
    return _OWN[app]


def hadoop_file(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that no later step reads."""
    for path in paths:
        files, place = hadoop_file(spark, path)
        files.delete(place, True)


def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialise`` with the table's path, for ``discard``; what is left goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, place = hadoop_file(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans start from files that outlive executors."""
    return write(df, name)[0]


def many_tasks(spark: SparkSession) -> int:
    """Partitions for rows that grow in their task: a number that is asked for is not lowered by the bytes they have before."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
