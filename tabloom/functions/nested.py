"""JSON, array and id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def json_list(c: Column | str) -> Column:
    """The texts of a JSON array of texts; null if it isn't one."""
    return F.from_json(col(c), "array<string>")


def to_json_or(c: Column | str, default: str | None = "[]") -> Column:
    """An array or struct as JSON, nulls kept; the default for null."""
    j = F.to_json(col(c), {"ignoreNullFields": "false"})
    return F.coalesce(j, F.lit(default)) if default is not None else F.when(F.size(col(c)) > 0, j)


def present(items: Column | str, field: str | None = None) -> Column:
    """The texts of an array (or of a field of its structs) that aren't blank."""
    values = F.transform(col(items), lambda x: x[field]) if field else col(items)
    return F.filter(values, lambda x: x.isNotNull() & (F.btrim(x) != ""))


def joined_or_null(items: Column | str, field: str | None = None, sep: str = ",") -> Column:
    return F.nullif(F.array_join(present(items, field), sep), F.lit(""))


def first_of_each(items: Column | str, key) -> Column:
    """The first struct for each key, in order of appearance; key takes a struct."""
    a = col(items)
    keys = F.transform(a, key)
    return F.filter(a, lambda x, i: (F.array_position(keys, key(x)) == i + 1) | key(x).isNull())


def composed(*parts: Column | str, sep: str = "-") -> Column:
    """An id of parts, lower case; null if any part is."""
    out: list[Column] = []
    for p in parts:
        out += [F.lit(sep), col(p).cast("string")]
    return F.lower(F.concat(*out[1:]))


def extracted(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def last_segment(url: Column | str) -> Column:
    return F.nullif(F.lower(F.element_at(F.split(F.rtrim(F.regexp_replace(col(url), r"[?#].*$", ""), F.lit("/")), "/"), -1)), F.lit(""))


def pdf_urls(attachments_json: Column | str, file_url: Column | str | None = None) -> Column:
    """Distinct URLs of PDFs named in an attachments list, flat or with formats below;
    the file's own URL if there are none. Malformed JSON names none."""
    flat = F.from_json(col(attachments_json), "array<struct<url:string,format:string>>")
    deep = F.flatten(F.transform(F.from_json(col(attachments_json), "array<struct<formats:array<struct<url:string,format:string>>>>"), lambda x: F.coalesce(x["formats"], F.array().cast("array<struct<url:string,format:string>>"))))
    every = F.concat(F.coalesce(flat, F.array().cast("array<struct<url:string,format:string>>")), F.coalesce(deep, F.array().cast("array<struct<url:string,format:string>>")))
    is_pdf = lambda x: x["url"].isNotNull() & (F.coalesce(F.lower(x["format"]) == "pdf", F.lit(False)) | F.lower(x["url"]).rlike(r"\.pdf(?:[?#].*)?$"))
    urls = F.array_distinct(F.transform(F.filter(every, is_pdf), lambda x: x["url"]))
    if file_url is None:
        return urls
    f = col(file_url)
    own = F.when(F.lower(f).rlike(r"\.pdf(?:[?#].*)?$"), F.array(f)).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(urls) > 0, urls).otherwise(own)


def combined_status(statuses: Column | str, text: Column | str) -> Column:
    """ok if there is any text, else the worst of error, encrypted and empty."""
    s = col(statuses)
    has = lambda x: F.coalesce(F.array_contains(s, x), F.lit(False))
    return F.when(F.btrim(F.coalesce(col(text), F.lit(""))) != "", F.lit("ok")).when(has("error"), F.lit("error")).when(has("encrypted"), F.lit("encrypted")).otherwise(F.lit("empty"))
