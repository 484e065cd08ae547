"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet and read again as the docs of the next one.

What holds for all stages: each row goes or stays by its own text, so ids may be null or
repeated; rows that are kept keep all their columns, of whatever names; an empty table
gives no rows; texts are taken whole, however long.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import decontaminate, packing, quality, toxicity, widehash
from tabloom.llm.common import shared_dir, table
from tabloom.session import delete


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the threshold table. A null, empty or wordless text
    has too few words and goes; repeated rows are judged alike."""
    return quality.keep(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose probability of a grade above 0 is below one half; the model is fitted on the
    labelled ones among docs. A null or empty text has no features and stays, and so does
    everything where there are no labels of both classes."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: candidates by SimHash of five-word shingles,
    verified at a similarity of 0.8 or more. The smallest id stays, one without an id only
    if no other is there; of equal ids and texts any one row; texts without words are alike."""
    return widehash.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark. A null or wordless text has none; rows of equal
    texts share their fate; an empty benchmark keeps all."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, each with its sequence and place. A null or empty text
    is one piece of the end id alone; repeated rows each have places of their own."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: Tokenised pieces and XXH64 fingerprints can't be expressed in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage wrote is deleted when the next one is written."""
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            delete(spark, f"{base}/{before}")
        before = name
    return docs
