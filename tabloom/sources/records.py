"""Record types: declared columns, key, version, and how raw JSON becomes a flat row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.nested import to_json_or
from tabloom.functions.text import strip_quotes

FILE = "array<struct<fileUrl:string,format:string,size:bigint>>"
DOCUMENT_ATTRIBUTES = "agencyId:string,docketId:string,title:string,documentType:string,postedDate:string,modifyDate:string,commentStartDate:string,commentEndDate:string,frDocNum:string,withdrawn:string,reasonWithdrawn:string,additionalRins:array<string>,fileFormats:" + FILE
COMMENT_ATTRIBUTES = "agencyId:string,docketId:string,firstName:string,lastName:string,organization:string,category:string,title:string,comment:string,documentType:string,postedDate:string,modifyDate:string,receiveDate:string"


@dataclass(frozen=True)
class RecordType:
    """A kind of record. `raw` is the DDL of its JSON; `columns` maps each declared column
    to an expression over that (all columns are text)."""

    name: str
    key: str
    raw: str
    columns: dict[str, Column | str]
    version: str = "modify_date"
    path_part: str = ""

    def __post_init__(self) -> None:
        for c in (self.key, self.version):
            if c not in self.columns:
                raise ValueError(f"{c} isn't a column of {self.name}")

    @property
    def schema(self) -> dict[str, str]:
        return dict.fromkeys(self.columns, "string")

    def extract(self, raw: DataFrame) -> DataFrame:
        return raw.select(*((F.col(e) if isinstance(e, str) else e).cast("string").alias(c) for c, e in self.columns.items()))


def _nothing() -> Column:
    return F.lit(None).cast("string")


def _files(formats: str | Column) -> Column:
    """Formats that have a URL, as url, format, size."""
    have = F.filter(F.col(formats) if isinstance(formats, str) else formats, lambda f: F.coalesce(f["fileUrl"] != "", F.lit(False)))
    return F.transform(have, lambda f: F.struct(f["fileUrl"].alias("url"), f["format"].alias("format"), f["size"].alias("size")))


def _attachments() -> Column:
    kept = F.filter(F.col("included"), lambda i: i["type"] == "attachments")
    made = F.transform(kept, lambda i: F.struct(F.coalesce(i["attributes"]["title"], F.lit("")).alias("title"), _files(i["attributes"]["fileFormats"]).alias("formats")))
    return to_json_or(F.filter(made, lambda a: F.size(a["formats"]) > 0), None)


def record_types() -> dict[str, RecordType]:
    """The three kinds of a docket-based comment portal; made in a call, as columns need a session."""
    a = "data.attributes."
    return {
        "dockets": RecordType(
            "dockets", "docket_id", "data struct<id:string,attributes:struct<agencyId:string,title:string,docketType:string,modifyDate:string,dkAbstract:string,rin:string>>",
            {"docket_id": strip_quotes("data.id"), "agency_code": a + "agencyId", "title": a + "title", "docket_type": a + "docketType", "modify_date": a + "modifyDate", "abstract": a + "dkAbstract", "rin": a + "rin"},
            path_part="/docket/",
        ),
        "documents": RecordType(
            "documents", "document_id", f"data struct<id:string,attributes:struct<{DOCUMENT_ATTRIBUTES}>>",
            {
                "document_id": "data.id", "docket_id": strip_quotes(a + "docketId"), "agency_code": a + "agencyId", "title": a + "title", "document_type": a + "documentType",
                "posted_date": a + "postedDate", "modify_date": a + "modifyDate", "comment_start_date": a + "commentStartDate", "comment_end_date": a + "commentEndDate",
                "file_url": F.get(_files(a + "fileFormats"), F.lit(0))["url"], "attachments_json": to_json_or(_files(a + "fileFormats"), None), "fr_doc_num": a + "frDocNum",
                "withdrawn": a + "withdrawn", "reason_withdrawn": a + "reasonWithdrawn", "additional_rins": to_json_or(a + "additionalRins", None), "text_content": _nothing(), "text_extraction_status": _nothing(),
            },
            path_part="/documents/",
        ),
        "comments": RecordType(
            "comments", "comment_id", f"data struct<id:string,attributes:struct<{COMMENT_ATTRIBUTES}>>, included array<struct<type:string,attributes:struct<title:string,fileFormats:{FILE}>>>",
            {
                "comment_id": "data.id", "docket_id": strip_quotes(a + "docketId"), "agency_code": a + "agencyId", "first_name": a + "firstName", "last_name": a + "lastName",
                "organization": a + "organization", "category": a + "category", "title": a + "title", "comment": a + "comment", "document_type": a + "documentType",
                "posted_date": a + "postedDate", "modify_date": a + "modifyDate", "receive_date": a + "receiveDate", "attachments_json": _attachments(), "text_content": _nothing(), "text_extraction_status": _nothing(),
            },
            path_part="/comments/",
        ),
    }
