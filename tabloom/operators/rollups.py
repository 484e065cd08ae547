"""Aggregations and rollups, with tables and columns as parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabloom.functions.dates import days_between
from tabloom.functions.text import STOP_BIGRAMS, ENGLISH_STOP_WORDS, letters, strip_quotes


def counts_over(inputs: dict[str, DataFrame | None], key: str, by: str | list[str] | None = None) -> DataFrame:
    """One row for each key of any input, with its rows in each (0 if none); null keys go.
    An input may be missing. One with a column row_count is summed instead of counted. With
    `by`, the keys of the most rows of that input (of several: in turn) come first."""
    # one pass over each input and one grouping of the partial counts
    parts = []
    for name, df in inputs.items():
        if df is not None:
            n = F.sum("row_count").cast("bigint") if "row_count" in df.columns else F.count("*")
            parts.append(df.filter(F.col(key).isNotNull()).groupBy(key).agg(n.alias("__n")).select(key, F.lit(name).alias("__of"), "__n"))
    if not parts:
        raise FileNotFoundError("none of the inputs is there")
    counted = reduce(DataFrame.unionByName, parts).groupBy(key)
    total = lambda name: F.coalesce(F.sum(F.when(F.col("__of") == name, F.col("__n"))), F.lit(0)).cast("bigint").alias(name)
    out = counted.agg(*map(total, inputs))
    return out.orderBy(*(F.desc(b) for b in ([by] if isinstance(by, str) else by)), F.asc(key)) if by else out


def feed_summary(records: DataFrame, key: str, comments: DataFrame | None, documents: DataFrame | None, end: str, posted: str) -> DataFrame:
    """Each record with its comments' count and its documents' last end and first posting."""
    out = records.withColumn(key, strip_quotes(F.col(key).cast("string")))
    if comments is not None:
        n = comments.groupBy(strip_quotes(F.col(key).cast("string")).alias(key)).agg(F.count("*").alias("comment_count"))
        out = out.join(n, key, "left").withColumn("comment_count", F.coalesce("comment_count", F.lit(0)))
    else:
        out = out.withColumn("comment_count", F.lit(0).cast("bigint"))
    if documents is not None:
        d = documents.groupBy(strip_quotes(F.col(key).cast("string")).alias(key)).agg(F.max(end).alias("comment_end_date"), F.min(posted).alias("date_created"))
        return out.join(d, key, "left")
    return out.withColumn("comment_end_date", F.lit(None).cast("string")).withColumn("date_created", F.lit(None).cast("string"))


def monthly_volume(df: DataFrame, keys: list[str], when: Column, name: str = "row_count") -> DataFrame:
    """Rows by keys, year and month; rows without a date go."""
    dated = df.withColumn("__when", when).filter("__when IS NOT NULL")
    return dated.groupBy(*keys, F.year("__when").cast("bigint").alias("year"), F.month("__when").cast("bigint").alias("month")).agg(F.count("*").alias(name))


def spike_signals(df: DataFrame, key: str, when: Column, as_of: str, least_prior: int = 24, least_ratio: float = 2.0) -> DataFrame:
    """Keys whose last 30 days far exceed their monthly mean of the twelve months before."""
    now = F.lit(as_of).cast("timestamp_ntz")
    counted = df.withColumn("__when", when).filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if((F.col("__when") >= now - F.expr("INTERVAL '30' DAY")) & (F.col("__when") <= now)).alias("recent_30d"),
        F.count_if((F.col("__when") >= now - F.expr("INTERVAL '13' MONTH")) & (F.col("__when") < now - F.expr("INTERVAL '1' MONTH"))).alias("prior"),
    )
    out = counted.withColumn("baseline", F.col("prior") / F.lit(12.0)).withColumn("ratio", F.try_divide(F.col("recent_30d").cast("double"), F.col("baseline")))
    return out.filter((F.col("prior") >= least_prior) & (F.col("ratio") >= least_ratio))


def lifecycles(proposed: DataFrame, final: DataFrame, key: str, group: str, when: str, floor: str = "2010-01-01", title: str | None = None) -> DataFrame:
    """Earliest proposal of each key and group with the key's earliest final on or after it
    (kind 'pair'), or without any final at all (kind 'stuck'). The floor is of the earliest
    proposal: one from before it leaves the key out, whatever came later. A title is any of
    the group's proposals' (the least that isn't null)."""
    titles = [F.min(title).alias("title")] if title else []
    first = proposed.groupBy(key, group).agg(F.min(when).alias("proposed_date"), *titles).filter(F.col("proposed_date") >= F.lit(floor).cast("date"))
    last = final.groupBy(key).agg(F.min(when).alias("final_date"), F.lit(True).alias("__final"))
    kind = F.when(F.col("final_date") >= F.col("proposed_date"), "pair").when(F.col("__final").isNull(), "stuck")
    joined = first.join(last, key, "left").withColumn("kind", kind).filter("kind IS NOT NULL")
    return joined.select(key, group, *(["title"] if title else []), "kind", "proposed_date", "final_date", days_between("proposed_date", "final_date").alias("days"))


def exploded_links(df: DataFrame, items: Column, name: str, keep: list[str], ordered: bool | list = False) -> DataFrame:
    """A row for each item of an array that isn't blank, with the columns kept; ordered by all of
    them if asked, or by item and then the given columns, F.desc(date) say."""
    out = df.select(F.explode(items).alias(name), *keep).filter(F.btrim(name) != "")
    return out.orderBy(name, *(keep if ordered is True else ordered)) if ordered else out


def distinct_share(df: DataFrame, group: str, text: str, least_rows: int, top: int | None = None) -> DataFrame:
    """Groups with more rows than least_rows whose texts repeat, by their share of repeats."""
    out = df.filter(F.col(text).isNotNull()).groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(text).alias("distinct_texts"))
    out = out.filter((F.col("rows") > least_rows) & (F.col("rows") > F.col("distinct_texts")))
    out = out.withColumn("duplicate_percent", F.round(F.lit(100.0) * (F.col("rows") - F.col("distinct_texts")) / F.col("rows"), 1))
    return out.orderBy(F.desc("duplicate_percent"), F.asc(group)).limit(top) if top else out


def templates(df: DataFrame, text: str, prefix: int, least_rows: int) -> DataFrame:
    """Beginnings that more than least_rows texts share, with how many texts they are."""
    head = F.left(F.col(text), F.lit(prefix))
    return df.filter(F.col(text).isNotNull()).groupBy(head.alias("beginning")).agg(F.count("*").alias("rows"), F.countDistinct(text).alias("variations")).filter(F.col("rows") > least_rows)


def repeated_texts(df: DataFrame, text: str, when: str) -> DataFrame:
    return df.filter(F.col(text).isNotNull()).groupBy(text).agg(F.count("*").alias("rows"), F.min(when).alias("first"), F.max(when).alias("last")).filter("rows > 1")


def unique_texts(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text no other row has. Counted first and joined, so that no text's
    rows have to meet in one task."""
    once = df.groupBy(F.col(text).alias("__t")).agg(F.count("*").alias("__n")).filter("__n = 1 AND __t IS NOT NULL")
    return df.join(once, df[text] == F.col("__t"), "left_semi")


def spike_days(df: DataFrame, when: Column, deviations: float = 2.0) -> DataFrame:
    """Days with more rows than the mean of all days plus so many sample deviations."""
    daily = df.select(when.cast("date").alias("day")).filter("day IS NOT NULL").groupBy("day").agg(F.count("*").alias("rows"))
    limits = daily.agg(F.avg("rows").alias("mean"), F.stddev_samp("rows").alias("deviation"))
    # one row beside all days
    return daily.crossJoin(F.broadcast(limits)).filter(F.col("rows") > F.col("mean") + deviations * F.col("deviation"))


def reach(df: DataFrame, key: str, across: str, least: int, extra: list[Column] = ()) -> DataFrame:
    """Keys that occur with more than `least` distinct values of another column."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"), F.countDistinct(across).alias("distinct_values"), *extra).filter(F.col("distinct_values") > least)


def name_variants(df: DataFrame, name: str, prefix: int) -> DataFrame:
    """Names that share a beginning, where there is more than one."""
    out = df.filter(F.col(name).isNotNull()).groupBy(F.left(F.col(name), F.lit(prefix)).alias("beginning")).agg(F.array_sort(F.collect_set(name)).alias("names"), F.count("*").alias("rows"))
    return out.filter(F.size("names") > 1)


def overview(df: DataFrame, text: str, when: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.countDistinct(text).alias("distinct_texts"), F.min(when).alias("first"), F.max(when).alias("last"), F.avg(F.length(text)).alias("mean_length"))


def shares(df: DataFrame, by: Column, name: str) -> DataFrame:
    """Rows by a class, and their percentage of all."""
    counted = df.groupBy(by.alias(name)).agg(F.count("*").alias("rows"))
    whole = counted.agg(F.sum("rows").alias("__all"))
    return counted.crossJoin(F.broadcast(whole)).select(name, "rows", F.round(F.lit(100.0) * F.col("rows") / F.col("__all"), 1).alias("percent"))  # a single row beside each class


def dataset_statistics(tables: dict[str, DataFrame], top_of: str, by: str) -> DataFrame:
    """One row: the rows of each table (total_<name>), and the most frequent value of a column
    in one of them with its rows (ties by the value; null only if there is none)."""
    counts = reduce(DataFrame.crossJoin, (t.agg(F.count("*").alias(f"total_{n}")) for n, t in tables.items()))  # of one row each
    most = tables[top_of].filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(1)
    return counts.join(F.broadcast(most.select(F.col(by).alias(f"top_{by}"), F.col("n").alias(f"top_{by}_{top_of}"))), F.lit(True), "left")


def organizations(df: DataFrame, title: str, across: str, least: int = 50, top_n: int | None = 15, not_like: tuple[str, ...] = ("Comment%", "Anonymous%"), least_length: int = 6) -> DataFrame:
    """Titles that name someone who writes in many places: those of no stock form and not too
    short, with more than `least` distinct values of another column, by their number."""
    named = df.filter(F.col(title).isNotNull() & (F.length(title) >= least_length))
    for pattern in not_like:
        named = named.filter(~F.col(title).like(pattern))
    out = named.groupBy(title).agg(F.count("*").alias("comment_count"), F.countDistinct(across).alias("docket_count")).filter(F.col("docket_count") > least)
    return out.orderBy(F.desc("docket_count"), F.asc(title)).limit(top_n) if top_n else out


def activity(df: DataFrame, by: str, across: str, when: str, top_n: int | None = None) -> DataFrame:
    """Rows, distinct values of another column, and first and last date of each group, the most active first."""
    out = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("rows"), F.countDistinct(across).alias("distinct_values"), F.min(when).alias("first"), F.max(when).alias("last"))
    return out.orderBy(F.desc("rows"), F.asc(by)).limit(top_n) if top_n else out


def word_counts(df: DataFrame, text: str, least: int = 4, stop=ENGLISH_STOP_WORDS) -> DataFrame:
    words = df.select(F.explode(letters(text, least)).alias("word"))
    return words.filter(~F.col("word").isin(*stop)).groupBy("word").agg(F.count("*").alias("n"))


def bigram_counts(df: DataFrame, text: str, least: int = 3, stop=STOP_BIGRAMS) -> DataFrame:
    w = F.col("w")
    pairs = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.array_join(F.slice(w, i, 2), " ")))
    grams = df.select(letters(text, least).alias("w")).select(F.explode(pairs).alias("bigram"))
    return grams.filter(~F.col("bigram").isin(*stop)).groupBy("bigram").agg(F.count("*").alias("n"))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ends(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first and last n rows in an order, with their ranks from either end; two
    bounded top-n's, so that no task sorts the whole table."""
    w_early = Window.orderBy(*(F.col(c).asc_nulls_last() for c in order))
    w_late = Window.orderBy(*(F.col(c).desc_nulls_last() for c in order))
    early = df.orderBy(*(F.col(c).asc_nulls_last() for c in order)).limit(n).withColumn("rank", F.row_number().over(w_early)).withColumn("end", F.lit("early"))
    late = df.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(n).withColumn("rank", F.row_number().over(w_late)).withColumn("end", F.lit("late"))
    return early.union(late)


def search_documents(df: DataFrame, key: str, title: Column, body: Column, version: str) -> DataFrame:
    """Rows of a search index: the newest of each key, cleaned, without those that are blank."""
    from .merge import latest

    out = latest(df, [key], version).select(F.col(key).cast("string").alias("id"), title.alias("t"), body.alias("s"), F.col(version).alias("d"))
    out = out.filter((F.col("t") != "") | (F.col("s") != ""))
    return out.withColumn("s", F.nullif("s", F.lit("")))


def exact_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows, the same ones for a seed: those with the least hashes of key and seed."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
