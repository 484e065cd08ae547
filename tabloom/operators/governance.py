"""Checks of tables: freshness, lag, drift, uniqueness."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.dates import day


@dataclass(frozen=True)
class Budget:
    """A table's date column may lag behind today by so many days."""

    table: str
    column: str
    days: int


def latest_days(tables: dict[str, DataFrame], budgets: list[Budget]) -> DataFrame:
    """table_name, metric, latest, row_count: one aggregate over each table that is there."""
    parts = []
    for b in budgets:
        if b.table in tables:
            t = tables[b.table]
            kind = dict(t.dtypes)[b.column]
            when = day(b.column) if kind == "string" else F.col(b.column).cast("date")
            parts.append(t.agg(F.max(when).alias("latest"), F.count("*").alias("row_count")).select(F.lit(b.table).alias("table_name"), F.lit(b.column).alias("metric"), "latest", "row_count"))
    return reduce(DataFrame.union, parts)


def freshness(latest: DataFrame, budgets: list[Budget], today: str) -> DataFrame:
    """Each check with its lag and whether it keeps its budget; a missing date doesn't."""
    days = F.create_map(*(F.lit(x) for b in budgets for x in (f"{b.table}.{b.column}", b.days)))
    out = latest.withColumn("budget_days", days[F.concat_ws(".", "table_name", "metric")])
    out = out.withColumn("lag_days", F.datediff(F.lit(today).cast("date"), F.col("latest")))
    return out.withColumn("ok", F.coalesce(F.col("lag_days") <= F.col("budget_days"), F.lit(False)))


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and row_count of each table."""
    return reduce(DataFrame.union, (t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()))


def count_changes(now: DataFrame, before: DataFrame, key: str = "table_name", least_ratio: float = 0.5) -> DataFrame:
    """Row counts against those of an earlier run; a table new since then is fine."""
    b = before.select(F.col(key).alias("__k"), F.col("row_count").alias("before"))
    out = now.join(b, F.col(key) == F.col("__k"), "left").drop("__k")
    return out.withColumn("ok", F.coalesce(F.col("row_count") >= least_ratio * F.col("before"), F.lit(True)))


def checked_counts(now: DataFrame, path: str, least_ratio: float = 0.5) -> DataFrame:
    """count_changes against the counts that the last good run stored at path; counts of
    tables that pass are stored for the next one, the others keep what they had."""
    from tabloom.operators.layout import exists, swap
    from tabloom.session import materialise

    spark = now.sparkSession
    now = now.select("table_name", "row_count")
    before = materialise(spark.read.parquet(path), "counts") if exists(spark, path) else spark.createDataFrame([], now.schema)
    out = materialise(count_changes(now, before, least_ratio=least_ratio), "counts")
    good = out.filter("ok").select("table_name", "row_count")
    swap(good.unionByName(before.join(good, "table_name", "left_anti")), path)
    return out


def lagging(rows: DataFrame, index: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose newest month in the rows is after that of their index (or has none)."""
    a = rows.groupBy(*by).agg(F.max(F.col("year") * 100 + F.col("month")).alias("rows_month"))
    b = index.groupBy(*by).agg(F.max(F.col("year") * 100 + F.col("month")).alias("index_month"))
    return a.join(b, by, "left").filter("index_month IS NULL OR index_month < rows_month")


def drift(declared: list[str], live: list[str], described: list[str] | None = None) -> dict[str, list[str]]:
    """Columns that one side lacks."""
    out = {"missing_in_table": sorted(set(declared) - set(live)), "undeclared": sorted(set(live) - set(declared))}
    if described is not None:
        out |= {"undescribed": sorted(set(declared) - set(described)), "described_only": sorted(set(described) - set(declared))}
    return out


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys")).withColumn("unique", F.col("rows") == F.col("distinct_keys"))
