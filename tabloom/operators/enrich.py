"""Text enrichment: choose candidates, look up or extract text, coalesce it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.nested import combined_status, pdf_urls
from tabloom.session import ship

from .merge import update_where_present

MOST_BYTES = 100 << 20


def candidates(df: DataFrame, id_col: str, status: str = "text_extraction_status", attachments: str = "attachments_json", overwrite: bool = False, discover: bool = False, limit: int | None = None) -> DataFrame:
    """Rows to enrich, one for each id: with attachments (unless discovering) and without a status (unless overwriting)."""
    out = df.filter(F.col(id_col).isNotNull())
    if not discover:
        out = out.filter(F.coalesce(~F.btrim(attachments).isin("", "[]"), F.lit(False)))
    if not overwrite:
        out = out.filter(F.coalesce(F.col(status), F.lit("")) == "")
    out = out.dropDuplicates([id_col])
    return out.orderBy(id_col).limit(limit) if limit is not None else out


def derived_texts(spark: SparkSession, path: str) -> DataFrame:
    """Texts extracted beforehand, from files <id>_attachment_<n>_extracted.txt below path:
    id and text, the parts in order of their numbers, a blank line between them."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_name").alias("file"))
    name = r"^(.+)_attachment_(\d+)_extracted\.txt$"
    parts = files.filter(F.col("file").rlike(name)).select(F.regexp_extract("file", name, 1).alias("id"), F.regexp_extract("file", name, 2).cast("int").alias("n"), F.btrim("value").alias("text"))
    return joined_parts(parts)


def joined_parts(parts: DataFrame) -> DataFrame:
    """(id, n, text) to one text for each id; an id has as many parts as its files."""
    kept = parts.filter("text <> ''").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("p"))
    return kept.select("id", F.array_join("p.text", "\n\n").alias("text"))


def with_derived(df: DataFrame, texts: DataFrame, id_col: str, text: str = "text_content", status: str = "text_extraction_status", **choose) -> DataFrame:
    """The table with texts filled in for candidates that have one; all others stay as they are."""
    wanted = candidates(df, id_col, status, **choose).select(F.col(id_col).alias("__id"))
    updates = texts.join(wanted, F.col("id") == F.col("__id"), "left_semi").select(F.col("id").alias(id_col), F.col("text").alias(text), F.lit("ok").alias(status))
    return update_where_present(df, updates, id_col, [text, status])


def stats(wanted: DataFrame, texts: DataFrame, id_col: str) -> DataFrame:
    """How many candidates there are, and for how many a text is known."""
    hit = texts.select(F.col("id").alias("__id"), F.lit(True).alias("__hit"))
    return wanted.join(hit, F.col(id_col) == F.col("__id"), "left").agg(F.count("*").alias("selected"), F.count("__hit").alias("ok"), (F.count("*") - F.count("__hit")).alias("missing"))


def pdf_text(data: bytes | None) -> tuple[str, str]:
    """Text and status (ok, empty, encrypted, error) of a PDF; needs pypdf, without which all are errors."""
    if not data:
        return "", "error"
    try:
        import io

        from pypdf import PdfReader

        reader = PdfReader(io.BytesIO(data))
        if reader.is_encrypted:
            return "", "encrypted"
        text = "\n\n".join(t for t in ((p.extract_text() or "").strip() for p in reader.pages) if t)
        return text, "ok" if text else "empty"
    except Exception:  # a broken file has a status, like any other
        return "", "error"


def capped(found, most: int = MOST_BYTES) -> bytes | None:
    """The bytes of a download, or None if there are more than `most`. A download may come in chunks, and
    is then left off as soon as it is too large, so that no more than that is ever held."""
    if found is None or isinstance(found, (bytes, bytearray)):
        return found if found is not None and len(found) <= most else None
    held, size = [], 0
    try:
        for chunk in found:
            size += len(chunk)
            if size > most:
                return None
            held.append(chunk)
    finally:
        close = getattr(found, "close", None)
        if close:
            close()
    return b"".join(held)


def from_pdfs(df: DataFrame, id_col: str, fetch, extract=pdf_text, attachments: str = "attachments_json", file_url: str | None = None, text: str = "text_content", status: str = "text_extraction_status", **choose) -> DataFrame:
    """The table with the texts of its PDFs. fetch takes a URL and returns its bytes, an
    iterator of chunks of them (read until they are too many) or None; extract takes bytes and returns text and status. Every row that was tried has a status."""
    import pandas as pd

    ship(df.sparkSession)
    wanted = candidates(df, id_col, status, attachments, **choose)
    urls = wanted.select(F.col(id_col).alias("__id"), F.posexplode(pdf_urls(attachments, file_url)).alias("n", "url"))

    def run(frames):
        for f in frames:
            got = [extract(d) if (d := capped(fetch(u))) is not None else ("", "error") for u in f["url"]]
            yield pd.DataFrame({"__id": f["__id"], "n": f["n"], "text": [t for t, _ in got], "status": [s for _, s in got]})

    parts = urls.mapInPandas(run, f"__id {urls.schema[0].dataType.simpleString()}, n int, text string, status string")
    merged = parts.groupBy("__id").agg(F.array_sort(F.collect_list(F.struct("n", "text", "status"))).alias("p"))
    joined = F.array_join(F.filter("p.text", lambda t: t != ""), "\n\n")
    updates = merged.select(F.col("__id").alias(id_col), F.nullif(joined, F.lit("")).alias(text), combined_status("p.status", joined).alias(status))
    return update_where_present(df, updates, id_col, [text, status])
