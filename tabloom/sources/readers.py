"""Readers: Parquet of mixed vintage, JSON objects in a tree, XML dumps, views, listings."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.layout import exists, swap
from tabloom.operators.state import unseen

from .records import RecordType

log = logging.getLogger(__name__)


def parquet(spark: SparkSession, *paths: str, partitions: bool = True, skip_corrupt: bool = False) -> DataFrame:
    """Files of different schemas as one table, by name; with or without partition columns."""
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", skip_corrupt)
    if not partitions:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*paths)


def listing(spark: SparkSession, path: str, kinds: dict[str, RecordType], years: tuple[int, ...] = (), groups: tuple[str, ...] = (), done: DataFrame | None = None) -> DataFrame:
    """JSON objects below a path: key, kind (the first whose path part it has), grp (its
    first folder) and year (of a folder name like X-2024-0001), without those done."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path).select(F.col("path").alias("key"), F.col("length"))
    base = path.rstrip("/").removeprefix("file://")
    rel = F.regexp_replace(F.col("key"), r"^.*?" + base.replace(".", r"\."), "")
    kind = F.lit(None).cast("string")
    for name, k in reversed(list(kinds.items())):
        kind = F.when(rel.contains(k.path_part), F.lit(name)).otherwise(kind)
    out = files.withColumn("kind", kind).withColumn("grp", F.regexp_extract(rel, r"^/?([^/]+)/", 1)).withColumn("year", F.regexp_extract(rel, r"/[A-Za-z_]+-(\d{4})-", 1).try_cast("int"))
    out = out.filter("kind IS NOT NULL")
    if years:
        out = out.filter(F.col("year").isin(*years))
    if groups:
        out = out.filter(F.col("grp").isin(*groups))
    return unseen(out, done) if done is not None else out


def groups(files: DataFrame) -> DataFrame:
    return files.select("grp").filter("grp <> ''").distinct().orderBy("grp")


def json_records(spark: SparkSession, kind: RecordType, paths: list[str] | str) -> tuple[DataFrame, DataFrame]:
    """Records of JSON objects (one a file), and the files that can't be parsed: (key, error)."""
    texts = spark.read.option("wholetext", True).text(paths).select("value", F.col("_metadata.file_path").alias("key"))
    good, bad = json_text_records(kind, texts, "value")
    return good, bad.select("key", F.lit("parse").alias("error"))


def json_text_records(kind: RecordType, df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The same from a column of JSON texts; texts that aren't JSON objects are the second table."""
    parsed = df.withColumn("__r", F.from_json(F.col(column), kind.raw))
    # a text that isn't JSON parses to a row of nulls, or to null
    ok = F.coalesce(F.try_parse_json(column).isNotNull() & F.btrim(F.col(column)).startswith("{"), F.lit(False))
    return kind.extract(parsed.filter(ok).select("__r.*")), parsed.filter(~ok).drop("__r")


def has_doctype(spark: SparkSession, path: str) -> bool:
    """Whether any XML file below path declares a document type, where expanding entities live."""
    return not spark.read.option("recursiveFileLookup", True).text(path).filter("upper(value) LIKE '%<!DOCTYPE%'").isEmpty()


def feed(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of an XML feed; none, with a logged error, if it has a DOCTYPE, as a proper feed has not."""
    if has_doctype(spark, path):
        log.error("%s has a DOCTYPE declaration and isn't parsed", path)
        return spark.createDataFrame([], schema)
    return xml(spark, path, row_tag, schema)


def xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """Rows of an XML dump, one for each element of the tag, without reading a file whole."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def register(spark: SparkSession, tables: dict[str, list[str]], dedupe: dict[str, tuple[str, str]] | None = None) -> list[str]:
    """A view for each table, from the first of its places that there is; those that
    have none are skipped with a warning. dedupe maps tables to key and version: their
    views show the newest row of each key."""
    from tabloom.operators.merge import latest

    have = []
    for name, places in tables.items():
        for place in places:
            try:
                df = parquet(spark, place)
            except AnalysisException as e:
                log.warning("%s: %s can't be read: %s", name, place, e.getCondition())
                continue
            if dedupe and name in dedupe:
                df = latest(df, [dedupe[name][0]], dedupe[name][1])
            df.createOrReplaceTempView(name)
            have.append(name)
            break
        else:
            log.warning("%s has no place that can be read", name)
    return have


def copy_if_there(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a table; False if there is none, an error if it can't be read. The copy takes the
    target's place when it is whole."""
    if not exists(spark, source):
        return False
    swap(spark.read.parquet(source), target)
    return True


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    from tabloom.operators.rollups import exact_sample

    return exact_sample(df, n, seed, key)


def day_windows(spark: SparkSession, first: str, last: str, days: int) -> DataFrame:
    """Date windows of so many days between two days, both included: (since, until)."""
    start: Column = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"INTERVAL {days} DAYS")))
    return spark.range(1).select(start.alias("since")).withColumn("until", F.least(F.date_add("since", days - 1), F.lit(last).cast("date")))


def dump(spark: SparkSession, path: str, envelope: str = "entityData") -> DataFrame:
    """Texts of a dump, a row each (value): the lines of NDJSON files, the elements of a JSON
    array, and those under a key of a JSON object (the envelope), on one line or several;
    plain, gzipped or zipped.

    Files whose lines are JSON are read line by line, however long. Only others, and zips,
    are read whole, each by one task; of those that are no JSON either, lines that are
    JSON objects count and the rest is skipped.
    """
    from tabloom.session import ship

    read = lambda: spark.read.option("recursiveFileLookup", True)
    lines = read().text(path).filter("NOT endswith(lower(_metadata.file_name), '.zip') AND trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    other = lines.filter(F.try_parse_json("value").isNull()).select("file").distinct()
    schema = f"`{envelope}` array<string>"
    first = F.substring(F.ltrim("value"), 1, 1)
    held = F.from_json("value", schema)[envelope]
    items = F.when(first == "[", F.from_json("value", "array<string>")).when((first == "{") & held.isNotNull(), held).otherwise(F.array("value"))
    plain = lines.join(other, "file", "left_anti").select(F.explode(items).alias("value"))
    ship(spark)
    whole = read().format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    whole = whole.join(other, "file", "left_semi").unionByName(whole.filter("lower(file) LIKE '%.zip'"))

    def parsed(frames):
        import pandas as pd

        for f in frames:
            for content in f["content"]:
                rows = dump_records(content, envelope)
                for k in range(0, len(rows), 1000):
                    yield pd.DataFrame({"value": rows[k : k + 1000]})

    return plain.union(whole.select("content").mapInPandas(parsed, "value string")).filter("trim(value) <> ''")


def dump_records(content: bytes, envelope: str) -> list[str]:
    """The JSON objects of one file's bytes, as texts; none if it can't be unpacked."""
    import gzip
    import io
    import json
    import zipfile

    try:
        if content[:2] == b"\x1f\x8b":
            content = gzip.decompress(content)
        elif content[:2] == b"PK":
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                content = b"\n".join(z.read(n) for n in z.namelist()[:1])
    except (OSError, zipfile.BadZipFile):
        return []
    text = content.decode("utf-8", "replace")
    try:
        found = [json.loads(text)]
    except ValueError:
        found = []
        for line in text.splitlines():
            try:
                found.append(json.loads(line))
            except ValueError:
                continue
    if len(found) == 1 and isinstance(found[0], dict) and isinstance(found[0].get(envelope), list):
        found = found[0][envelope]
    elif len(found) == 1 and isinstance(found[0], list):
        found = found[0]
    return [json.dumps(r, ensure_ascii=False) for r in found if isinstance(r, dict)]
