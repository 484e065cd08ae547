"""Keyed merging: latest wins, fresh wins, upserts, updates, audits and partition indexes.

Every function returns a DataFrame; what is written, and how, is in layout.py. Ties are
settled by a hash of the whole row, so that a repeated run gives the same table.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabloom.functions.text import strip_quotes


def conform(df: DataFrame, schema: T.StructType | dict[str, str]) -> DataFrame:
    """The declared columns in order: cast, null where absent; others are dropped."""
    fields = [(f.name, f.dataType.simpleString()) for f in schema] if isinstance(schema, T.StructType) else list(schema.items())
    have = set(df.columns)
    return df.select(*((F.col(f"`{n}`").cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields))


def all_text(columns: list[str]) -> dict[str, str]:
    return dict.fromkeys(columns, "string")


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_hash(df: DataFrame, *leave_out: str) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns if c not in leave_out))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in the order; null keys are a key too."""
    w = Window.partitionBy(*keys).orderBy(*order, row_hash(df))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest(df: DataFrame, keys: list[str], version: str, ties: list[Column] = ()) -> DataFrame:
    """The newest version of each key; a null version is the oldest."""
    for c in [*keys, version]:
        if c not in df.columns:
            raise ValueError(f"{c} isn't a column of the table")
    return first_of(df, keys, [F.col(version).desc_nulls_last(), *ties])


def merge_latest(existing: DataFrame | None, staged: DataFrame, keys: list[str], version: str, schema=None) -> DataFrame:
    """Existing and staged rows by name, the newest version of each key; staged wins a tie."""
    parts = [p if schema is None else conform(p, schema) for p in (existing, staged) if p is not None]
    tagged = [p.withColumn("__src", F.lit(i)) for i, p in enumerate(parts)]
    return latest(union_by_name(*tagged), keys, version, [F.col("__src").desc()]).drop("__src")


def merge_prefer_fresh(prior: DataFrame | None, fresh: DataFrame, keys: list[str], order: list[Column] = ()) -> DataFrame:
    """Prior rows, replaced by fresh ones of the same key; rows with a null key go.
    Within one input, ties go by `order`."""
    parts = [prior, fresh] if prior is not None else [fresh]
    both = union_by_name(*(p.withColumn("__src", F.lit(i)) for i, p in enumerate(parts)))
    both = both.filter(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    return first_of(both, keys, [F.col("__src").desc(), *order]).drop("__src")


def winners(table: DataFrame, staged: DataFrame, key: str, version: str) -> DataFrame:
    """Staged rows, newest of each key, that are new or newer than the table's row."""
    have = table.groupBy(F.col(key).alias("__key")).agg(F.max(version).alias("__version"), F.lit(True).alias("__have"))
    newest = latest(staged, [key], version)
    joined = newest.join(have, newest[key].eqNullSafe(F.col("__key")), "left")
    return joined.filter(F.col("__have").isNull() | F.col("__version").isNull() | (F.col(version) > F.col("__version"))).drop("__key", "__version", "__have")


def upsert(table: DataFrame, staged: DataFrame, key: str, version: str) -> DataFrame:
    """The table with the winners in place of their keys' rows."""
    won = winners(table, staged, key, version)
    keys = won.select(F.col(key).alias("__key")).distinct()
    kept = table.join(keys, table[key].eqNullSafe(F.col("__key")), "left_anti")
    return kept.unionByName(won, allowMissingColumns=True)


def update_where_present(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of matching rows replaced by updates that aren't null; the first update of a key counts."""
    one = first_of(updates, [key], []).select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = table.join(one, table[key] == F.col("__key"), "left")
    return joined.select(*((F.coalesce(f"__{c}", table[c]).alias(c) if c in columns else table[c]) for c in table.columns))


def duplicate_audit(df: DataFrame, group: str, key: str) -> DataFrame:
    """Groups that have more rows than distinct keys, the greatest excess first."""
    counted = df.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"))
    return counted.filter("rows > distinct_keys").withColumn("excess", F.col("rows") - F.col("distinct_keys")).orderBy(F.desc("excess"), F.asc_nulls_last(group))


def first_wins(df: DataFrame, keys: list[str], arrival: Column) -> DataFrame:
    return first_of(df, keys, [arrival.asc_nulls_last()])


# --- partition indexes


def with_partition(df: DataFrame, group: str, record: str, posted: str) -> DataFrame:
    """Rows with all three, the record id without quotes, and the posting's year and month."""
    stamped = df.filter(F.col(group).isNotNull() & F.col(record).isNotNull() & F.col(posted).isNotNull())
    when = F.col(posted).try_cast("timestamp_ntz")
    return stamped.withColumn(record, strip_quotes(F.col(record).cast("string"))).withColumn("year", F.year(when).cast("bigint")).withColumn("month", F.month(when).cast("bigint"))


def partition_index(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


def replace_partitions(index: DataFrame, changed: DataFrame, by: list[str]) -> DataFrame:
    """The index with its rows of changed partitions replaced."""
    return index.join(changed.select(*by).distinct(), by, "left_anti").unionByName(changed)


# --- watermarks and windows of incremental reads


def watermark(prior: DataFrame | None, column: str, overlap_days: int) -> date | None:
    """Where the next read begins: the newest day so far less an overlap; None for all."""
    if prior is None or column not in prior.columns:
        return None
    newest = prior.agg(F.max(F.try_to_date(F.substring(F.col(column), 1, 10), "yyyy-MM-dd"))).first()[0]
    return newest - timedelta(days=overlap_days) if newest else None


def catch_up(since: date, today: date, until: date | None = None, most_days: int = 30) -> tuple[date, date]:
    """A bounded window from `since`; an error if it would end before it begins."""
    end = min(until or today, since + timedelta(days=most_days))
    if end < since:
        raise ValueError(f"the window would end on {end}, before it begins on {since}")
    return since, end


def rotating_year(today: date, first: int, last: int) -> int:
    """One year of a span for each day, in turn."""
    return first + today.toordinal() % (last - first + 1)


def bucketed_latest(df: DataFrame, key: str, version: str, rows_per_bucket: int, total: int | None = None) -> DataFrame:
    """latest() over hash buckets of about so many rows each, for one range of shuffles."""
    n = max(1, -(-(total if total is not None else df.count()) // rows_per_bucket))
    return latest(df.repartition(n, key), [key], version)
