"""The published tables of complementary sources: each as columns over its raw JSON.

Every column is text. A shape's raw DDL declares what is read of a row; its columns map
published names to Spark SQL over that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NAMED = "array<struct<name:string>>"


def _json(expr: str) -> str:
    return f"coalesce(to_json({expr}, map('ignoreNullFields', 'false')), '[]')"


def _names(c: str) -> str:
    return _json(f"filter(transform({c}, x -> x.name), n -> n IS NOT NULL AND trim(n) <> '')")


def _days(c: str) -> str:
    month, d, y = (f"regexp_extract(x, '^\\\\s*(\\\\d{{1,2}})/(\\\\d{{1,2}})/(\\\\d{{4}})\\\\s*$', {i})" for i in (1, 2, 3))
    ok = f"x RLIKE '^\\\\s*\\\\d{{1,2}}/\\\\d{{1,2}}/\\\\d{{4}}\\\\s*$' AND int({month}) BETWEEN 1 AND 12"
    return f"array_sort(array_distinct(transform(filter({c}, x -> {ok}), x -> concat_ws('-', {y}, lpad({month}, 2, '0'), lpad(string(least(greatest(int({d}), 1), 31)), 2, '0')))))"


def _found(c: str, pattern: str) -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', 1), '')"


#: The parts of a code of regulations that its ids tell.
_ID = "coalesce(packageId, granuleId)"
_TITLE, _PART, _SECTION = _found(_ID, r"title(\\d+)"), _found("granuleId", r"part(\\d+)"), _found("granuleId", r"sec([\\w.-]+)")


@dataclass(frozen=True)
class Shape:
    name: str
    key: tuple[str, ...]
    raw: str
    columns: dict[str, str]
    order: tuple[str, ...] = ()

    def apply(self, raw: DataFrame) -> DataFrame:
        return raw.select(*(F.expr(e).cast("string").alias(c) for c, e in self.columns.items()))

    def from_json(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of a column of JSON texts; those that aren't JSON, or lack the key, go."""
        out = self.apply(df.select(F.from_json(F.col(column), self.raw).alias("r")).select("r.*"))
        return out.filter(" AND ".join(f"{k} IS NOT NULL" for k in self.key))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


SHAPES = {
    s.name: s
    for s in (
        Shape(
            "federal_register", ("document_number",),
            "document_number string, title string, abstract string, type string, publication_date string, effective_on string, comments_close_on string, signing_date string, agencies array<struct<name:string,raw_name:string,slug:string>>, docket_ids array<string>, regulation_id_numbers array<string>, cfr_references array<struct<title:string,part:string,chapter:string>>, html_url string, pdf_url string, body_html_url string, volume string, start_page string, end_page string, subtype string, executive_order_number string",
            _same("document_number", "title", "abstract") | {"document_type": "type"} | _same("publication_date", "effective_on", "comments_close_on", "signing_date")
            | {"agencies_json": _json("agencies"), "agency_slugs": "nullif(array_join(filter(transform(agencies, a -> a.slug), s -> s <> ''), ','), '')", "docket_ids_json": _json("docket_ids"), "regulation_id_numbers_json": _json("regulation_id_numbers"), "cfr_references_json": _json("cfr_references")}
            | _same("html_url", "pdf_url", "body_html_url", "volume", "start_page", "end_page", "subtype", "executive_order_number") | {"modify_date": "string(NULL)"},
            ("publication_date",),
        ),
        Shape(
            "fcc_proceedings", ("name",),
            "name string, id_proceeding string, description_display string, description string, bureau struct<code:string,name:string>, bureau_code string, bureau_name string, flag_rulemaking_or_docket string, filingStatus string, date_proceeding_created string, date_closed string, comment_start_date string, comment_end_date string, comment_reply_start_date string, comment_reply_end_date string, filed_by string",
            _same("name", "id_proceeding") | {"description": "coalesce(nullif(description_display, ''), description)", "bureau_code": "coalesce(nullif(bureau.code, ''), bureau_code)", "bureau_name": "coalesce(nullif(bureau.name, ''), bureau_name)", "rulemaking_or_docket": "flag_rulemaking_or_docket", "filing_status": "filingStatus", "date_created": "date_proceeding_created"}
            | _same("date_closed", "comment_start_date", "comment_end_date") | {"reply_comment_start_date": "comment_reply_start_date", "reply_comment_end_date": "comment_reply_end_date"} | _same("filed_by"),
        ),
        Shape(
            "fcc_filings", ("id_submission",),
            f"id_submission string, proceedings {_NAMED}, submissiontype struct<description:string>, express_comment string, date_received string, date_submission string, date_disseminated string, filingstatus struct<description:string>, viewingstatus struct<description:string>, exparte_or_late_filed string, filers {_NAMED}, authors {_NAMED}, lawfirms {_NAMED}, bureaus {_NAMED}, text_data string, total_page_count string, documents array<struct<filename:string,src:string>>",
            _same("id_submission") | {"proceeding_names_json": _names("proceedings"), "submission_type": "submissiontype.description"} | _same("express_comment", "date_received", "date_submission", "date_disseminated")
            | {"filing_status": "filingstatus.description", "viewing_status": "viewingstatus.description"} | _same("exparte_or_late_filed")
            | {"filers_json": _names("filers"), "authors_json": _names("authors"), "lawfirms_json": _names("lawfirms"), "bureaus_json": _names("bureaus")} | _same("text_data", "total_page_count")
            | {"documents_json": _json("documents"), "filing_url": "CASE WHEN id_submission <> '' THEN concat('https://www.fcc.gov/ecfs/filing/', id_submission) END"},
            ("date_received",),
        ),
        Shape(
            "unified_agenda", ("rin", "agenda_edition"),
            "rin string, agency_code string, agency_name string, title string, abstract string, rin_status string, rule_stage string, priority_category string, agenda_edition string, major string, publication_id string, timetable array<struct<action:string,date:string,fr_citation:string>>, cfr_references array<string>, legal_authority array<string>",
            _same("rin", "agency_code", "agency_name", "title", "abstract", "rin_status", "rule_stage", "priority_category", "agenda_edition", "major", "publication_id")
            | {"timetable_json": _json("timetable"), "cfr_references_json": _json("cfr_references"), "legal_authority_json": _json("legal_authority"), "first_action_date": f"get({_days('timetable.date')}, 0)", "next_action_date": f"get({_days('timetable.date')}, 1)",
               "url": "CASE WHEN rin IS NOT NULL AND agenda_edition IS NOT NULL THEN concat('https://www.reginfo.gov/public/do/eAgendaViewRule?pubId=', agenda_edition, '&RIN=', rin) END"},
        ),
        Shape(
            "cfr_sections", ("granule_id",),
            "granuleId string, packageId string, dateIssued string, title string, granuleClass string, lastModified string",
            {
                "granule_id": "granuleId", "package_id": "packageId",
                "cfr_ref": f"CASE WHEN {_TITLE} IS NOT NULL AND {_PART} IS NOT NULL THEN concat({_TITLE}, '-', {_PART}, CASE WHEN {_SECTION} IS NOT NULL THEN concat('.', {_SECTION}) ELSE '' END) END",
                "title": _TITLE, "part": _PART, "section": _SECTION,
                "heading": "title", "structure_level": "granuleClass", "edition_year": "coalesce(nullif(regexp_extract(coalesce(packageId, granuleId), 'CFR-(\\\\d{4})', 1), ''), substring(dateIssued, 1, 4))", "last_modified": "lastModified",
                "url": "concat('https://www.govinfo.gov/app/details/', packageId, '/', granuleId)",
            },
        ),
        Shape(
            "sam_entities", ("uei",),
            "entityRegistration struct<ueiSAM:string,cageCode:string,legalBusinessName:string,dbaName:string,registrationStatus:string,registrationDate:string,registrationExpirationDate:string,exclusionStatusFlag:string,purposeOfRegistrationDesc:string>, coreData struct<entityInformation:struct<entityURL:string>,physicalAddress:struct<stateOrProvinceCode:string,city:string,zipCode:string>,generalInformation:struct<entityStructureDesc:string,entityTypeDesc:string,profitStructureDesc:string>,congressionalDistrict:string>, assertions struct<goodsAndServices:struct<primaryNaics:string>>",
            {
                "uei": "entityRegistration.ueiSAM", "cage_code": "entityRegistration.cageCode", "legal_business_name": "entityRegistration.legalBusinessName", "dba_name": "entityRegistration.dbaName",
                "entity_structure_desc": "coreData.generalInformation.entityStructureDesc", "entity_type_desc": "coreData.generalInformation.entityTypeDesc", "profit_structure_desc": "coreData.generalInformation.profitStructureDesc",
                "state": "coreData.physicalAddress.stateOrProvinceCode", "city": "coreData.physicalAddress.city", "zip_code": "coreData.physicalAddress.zipCode", "congressional_district": "coreData.congressionalDistrict",
                "primary_naics": "assertions.goodsAndServices.primaryNaics", "registration_status": "entityRegistration.registrationStatus", "registration_date": "entityRegistration.registrationDate",
                "registration_expiration_date": "entityRegistration.registrationExpirationDate", "exclusion_status_flag": "entityRegistration.exclusionStatusFlag", "purpose_of_registration_desc": "entityRegistration.purposeOfRegistrationDesc",
                "entity_url": "coreData.entityInformation.entityURL",
            },
        ),
        Shape(
            "fec_committees", ("committee_id",),
            "committee_id string, name string, committee_type string, committee_type_full string, designation string, designation_full string, party string, party_full string, state string, treasurer_name string, organization_type_full string, filing_frequency string, first_file_date string, last_file_date string, cycles array<bigint>, candidate_ids array<string>",
            _same("committee_id", "name", "committee_type", "committee_type_full", "designation", "designation_full", "party", "party_full", "state", "treasurer_name", "organization_type_full", "filing_frequency", "first_file_date", "last_file_date")
            | {"cycles_json": _json("cycles"), "candidate_ids_json": _json("candidate_ids")},
        ),
        Shape(
            "congress_bills", ("bill_id",),
            "congress string, type string, number string, title string, originChamber string, latestAction struct<actionDate:string,text:string>, updateDate string, url string",
            {"bill_id": "lower(congress || '-' || type || '-' || number)", "congress": "congress", "bill_type": "lower(type)", "bill_number": "number", "title": "title", "origin_chamber": "originChamber", "latest_action_date": "latestAction.actionDate", "latest_action_text": "latestAction.text", "update_date": "updateDate", "url": "url"},
            ("update_date",),
        ),
        Shape(
            "crs_reports", ("report_id",),
            "id string, title string, contentType string, status string, publishDate string, updateDate string, version string, url string",
            {"report_id": "id", "title": "title", "report_type": "contentType", "status": "status", "published_date": "publishDate", "update_date": "updateDate", "version": "version", "url": "url"},
            ("update_date",),
        ),
        Shape(
            "lobbying_filings", ("filing_uuid",),
            "filing_uuid string, filing_type string, filing_year string, filing_period string, dt_posted string, registrant struct<name:string,id:string>, client struct<name:string,id:string,client_id:string>, income string, expenses string, lobbying_activities array<struct<general_issue_code:string,general_issue_code_display:string,description:string,government_entities:array<struct<id:bigint,name:string>>>>, filing_document_url string",
            _same("filing_uuid", "filing_type", "filing_year", "filing_period", "dt_posted")
            | {"registrant_name": "registrant.name", "registrant_id": "registrant.id", "client_name": "client.name", "client_id": "coalesce(client.id, client.client_id)", "income": "income", "expenses": "expenses",
               "lobbying_activities_json": _json("transform(lobbying_activities, a -> struct(a.general_issue_code, a.general_issue_code_display, a.description))"),
               "government_entities_json": _json("aggregate(flatten(filter(transform(lobbying_activities, a -> a.government_entities), x -> x IS NOT NULL)), array(CAST(NULL AS struct<id:bigint,name:string>)), (a, e) -> CASE WHEN exists(a, x -> coalesce(string(x.id), x.name) = coalesce(string(e.id), e.name)) THEN a ELSE array_append(a, e) END, a -> slice(a, 2, size(a)))"),
               "url": "filing_document_url"},
            ("dt_posted",),
        ),
        Shape(
            "court_dockets", ("cl_docket_id",),
            "docket_id string, caseName string, case_name_full string, court_id string, court string, court_citation_string string, docketNumber string, dateFiled string, dateTerminated string, dateArgued string, suitNature string, cause string, jurisdictionType string, juryDemand string, assignedTo string, referredTo string, party array<string>, attorney array<string>, firm array<string>, pacer_case_id string, meta struct<date_created:string>, docket_absolute_url string",
            {"cl_docket_id": "docket_id", "case_name": "caseName", "case_name_full": "nullif(case_name_full, '')", "court_id": "court_id", "court": "court", "court_citation_string": "court_citation_string", "docket_number": "docketNumber", "date_filed": "dateFiled", "date_terminated": "dateTerminated", "date_argued": "dateArgued", "nature_of_suit": "suitNature", "cause": "cause", "jurisdiction_type": "jurisdictionType", "jury_demand": "juryDemand", "assigned_to": "assignedTo", "referred_to": "referredTo",
             **{f"{p}_json": _json(f"filter({c}, x -> trim(x) <> '')") for p, c in (("parties", "party"), ("attorneys", "attorney"), ("firms", "firm"))},
             "pacer_case_id": "pacer_case_id", "date_created": "meta.date_created", "absolute_url": "CASE WHEN docket_absolute_url LIKE '/%' THEN concat('https://www.courtlistener.com', docket_absolute_url) ELSE docket_absolute_url END"},
            ("date_filed",),
        ),
        Shape("usaspending_recipients", ("recipient_id",), "id string, uei string, duns string, name string, recipient_level string, amount string", {"recipient_id": "id", "uei": "uei", "duns": "duns", "name": "name", "recipient_level": "recipient_level", "total_award_amount": "amount"}),
        Shape(
            "gao_reports", ("report_id",), "title string, link string, description string, pubDate string",
            {"report_id": "nullif(lower(element_at(split(rtrim('/', link), '/'), -1)), '')", "title": "title", "report_type": "'Report'",
             "published_date": "nullif(concat_ws('-', nullif(regexp_extract(pubDate, '(\\\\d{1,2}) ([A-Z][a-z]{2}) (\\\\d{4})', 3), ''), lpad(nullif(array_position(split('Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec', ' '), regexp_extract(pubDate, '(\\\\d{1,2}) ([A-Z][a-z]{2}) (\\\\d{4})', 2)), 0), 2, '0'), lpad(nullif(regexp_extract(pubDate, '(\\\\d{1,2}) ([A-Z][a-z]{2}) (\\\\d{4})', 1), ''), 2, '0')), '')",
             "abstract": "description", "agencies_json": "'[]'", "topics_json": "'[]'", "url": "link"},
        ),
    )
}
