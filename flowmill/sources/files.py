"""Small file-system helpers on Hadoop paths (any shared storage Spark can read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowmill.functions.columns import small_table


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def _listed(spark: SparkSession, pattern: str) -> list:
    target, fs = _path(spark, pattern)
    return list(fs.globStatus(target) or [])


def glob(spark: SparkSession, pattern: str) -> list[str]:
    return sorted(str(f.getPath().toString()) for f in _listed(spark, pattern) if f.isFile())


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that fit, in order."""
    return sorted(str(f.getPath().getName()) for f in _listed(spark, pattern) if f.isDirectory())


def delete(spark: SparkSession, pattern: str) -> None:
    """Remove what fits, folders with their content."""
    _, fs = _path(spark, pattern)
    for f in _listed(spark, pattern):
        fs.delete(f.getPath(), True)


def write_json(df: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored report; one that was never written reads as empty."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else small_table(spark, [], schema)
