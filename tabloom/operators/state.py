"""State of incremental runs: which inputs are done, and which have failed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import exists


def load(spark: SparkSession, path: str) -> DataFrame:
    """Keys that are done: (key), empty if nothing is recorded yet."""
    return spark.read.parquet(path).select("key").distinct() if exists(spark, path) else spark.createDataFrame([], "key string")


def unseen(listing: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Inputs that aren't done: exact, whatever their number (no filter with false positives)."""
    return listing.join(done.select(F.col("key").alias("__k")), listing[key] == F.col("__k"), "left_anti")


def record(keys: DataFrame, path: str, key: str = "key") -> None:
    """Append keys; repeating a run appends none twice."""
    spark = keys.sparkSession
    fresh = unseen(keys.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct(), load(spark, path))
    fresh.write.mode("append").parquet(path)


def settle(results: DataFrame, path: str) -> DataFrame:
    """Record results (key, error) that succeeded or can't be parsed; return those to try
    again. An error that starts with 'transient' is left for the next run."""
    again = F.coalesce(F.col("error").startswith("transient"), F.lit(False))
    record(results.filter(~again), path)
    return results.filter(again)


def slices(df: DataFrame, key: str, number: int, size: int = 45) -> DataFrame:
    """One batch of the distinct keys, in order: numbers number*size to (number+1)*size-1."""
    ordered = df.select(key).distinct().orderBy(key)
    return ordered.offset(number * size).limit(size)
