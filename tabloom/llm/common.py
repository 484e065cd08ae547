"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import bounded_batches, materialise, shared_dir

__all__ = ["SPACE", "SPACE_CHARS", "bounded_batches", "let", "lower_ascii", "materialise", "shared_dir", "table", "words"]

#: White space of the word contracts: a word is a run of characters outside it.
SPACE = r"[ \t\n\x0B\f\r]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row however often body names it."""
    return F.transform(F.array(value), body)[0]
