import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tabloom.operators import state
from tabloom.sources import paged, readers
from tabloom.sources.records import RecordType, record_types
from tabloom.sources.shapes import SHAPES


def test_record_type_needs_key_and_version():
    with pytest.raises(ValueError):
        RecordType("x", "id", "id string", {"id": "id"})


def test_documents_are_flattened(spark, tmp_path):
    doc = {"data": {"id": "D-1", "attributes": {"agencyId": "EPA", "docketId": '"EPA-1"', "title": "T", "withdrawn": True, "additionalRins": ["1-A"], "fileFormats": [{"fileUrl": None}, {"fileUrl": "http://x/a.pdf", "format": "pdf", "size": 3}]}}}
    bare = {"data": {"id": "D-2", "attributes": {"fileFormats": []}}}
    for name, d in (("a", doc), ("b", bare)):
        (tmp_path / f"{name}.json").write_text(json.dumps(d))
    (tmp_path / "c.json").write_text("{broken")
    good, bad = readers.json_records(spark, record_types()["documents"], str(tmp_path))
    r = {x.document_id: x for x in good.collect()}
    assert r["D-1"].docket_id == "EPA-1" and r["D-1"].file_url == "http://x/a.pdf" and json.loads(r["D-1"].additional_rins) == ["1-A"]
    assert json.loads(r["D-1"].attachments_json) == [{"url": "http://x/a.pdf", "format": "pdf", "size": 3}]
    assert r["D-2"].attachments_json is None and r["D-2"].file_url is None and r["D-2"].additional_rins is None and r["D-2"].text_content is None
    assert [x.key.rsplit("/", 1)[-1] for x in bad.collect()] == ["c.json"] and good.columns == list(record_types()["documents"].columns)


def test_comments_from_json_text(spark):
    c = {"data": {"id": "C-1", "attributes": {"comment": "hi"}}, "included": [{"type": "attachments", "attributes": {"title": None, "fileFormats": [{"fileUrl": "u", "format": None}]}}, {"type": "attachments", "attributes": {"title": "none", "fileFormats": None}}, {"type": "other"}]}
    df = spark.createDataFrame([(json.dumps(c),), ("nope",), ("[1]",), (None,)], "j string")
    good, bad = readers.json_text_records(record_types()["comments"], df, "j")
    assert json.loads(good.first().attachments_json) == [{"title": "", "formats": [{"url": "u", "format": None, "size": None}]}]
    assert good.count() == 1 and bad.count() == 3


def test_listing_and_state(spark, tmp_path):
    for p in ("EPA/EPA-2024-0001/docket/a.json", "EPA/EPA-2024-0001/comments/b.json", "FDA/FDA-2023-0001/documents/c.json", "FDA/other/d.json"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("{}")
    files = readers.listing(spark, str(tmp_path), record_types())
    assert sorted((r.kind, r.grp, r.year) for r in files.collect()) == [("comments", "EPA", 2024), ("dockets", "EPA", 2024), ("documents", "FDA", 2023)]
    assert [r.grp for r in readers.groups(files).collect()] == ["EPA", "FDA"]
    ledger = str(tmp_path / "ledger")
    results = files.select("key", F.when(F.col("kind") == "documents", "transient: reset").when(F.col("kind") == "comments", "parse").alias("error"))
    assert state.settle(results, ledger).count() == 1
    state.record(files.filter("kind = 'dockets'"), ledger)
    assert state.load(spark, ledger).count() == 2
    assert [r.kind for r in readers.listing(spark, str(tmp_path), record_types(), done=state.load(spark, ledger)).collect()] == ["documents"]
    assert [r.key for r in state.slices(spark.createDataFrame([(f"k{i:02d}",) for i in range(10)], "key string"), "key", 1, 4).collect()] == ["k04", "k05", "k06", "k07"]


def test_views_skip_what_is_missing(spark, tmp_path):
    spark.createDataFrame([("a", "1"), ("a", "2")], "id string, v string").write.parquet(str(tmp_path / "t"))
    assert readers.register(spark, {"tt": [str(tmp_path / "no"), str(tmp_path / "t")], "none": [str(tmp_path / "no")]}, {"tt": ("id", "v")}) == ["tt"]
    assert [tuple(r) for r in spark.table("tt").collect()] == [("a", "2")]


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<R><RIN_INFO><RIN>1</RIN></RIN_INFO><RIN_INFO><RIN>2</RIN></RIN_INFO></R>")
    assert sorted(r.RIN for r in readers.xml(spark, str(tmp_path / "a.xml"), "RIN_INFO", "RIN string").collect()) == ["1", "2"]


SAMPLES = {
    "federal_register": ({"document_number": "2024-1", "type": "Rule", "agencies": [{"slug": "epa"}, {"slug": ""}, {"slug": "omb"}], "docket_ids": ["A", "B"], "volume": 89}, {"document_type": "Rule", "agency_slugs": "epa,omb", "volume": "89", "regulation_id_numbers_json": "[]", "docket_ids_json": '["A","B"]'}),
    "fcc_proceedings": ({"name": "17-108", "description": "d", "bureau": {"code": "WCB"}, "bureau_name": "W"}, {"description": "d", "bureau_code": "WCB", "bureau_name": "W"}),
    "fcc_filings": ({"id_submission": 12, "filers": [{"name": "A"}, {"name": " "}, {}], "submissiontype": {"description": "COMMENT"}}, {"id_submission": "12", "filers_json": '["A"]', "submission_type": "COMMENT", "filing_url": "https://www.fcc.gov/ecfs/filing/12", "documents_json": "[]"}),
    "unified_agenda": ({"rin": "2060-AA", "agenda_edition": "202404", "timetable": [{"action": "NPRM", "date": "03/00/2024"}, {"action": "Final", "date": "12/45/2024"}, {"action": "x", "date": "To be"}]}, {"first_action_date": "2024-03-01", "next_action_date": "2024-12-31", "url": "https://www.reginfo.gov/public/do/eAgendaViewRule?pubId=202404&RIN=2060-AA"}),
    "cfr_sections": ({"granuleId": "CFR-2024-title48-vol5-part700-sec60-1", "packageId": "CFR-2024-title48-vol5", "title": "Heading"}, {"cfr_ref": "48-700.60-1", "title": "48", "part": "700", "section": "60-1", "edition_year": "2024", "heading": "Heading"}),
    "sam_entities": ({"entityRegistration": {"ueiSAM": "U", "legalBusinessName": "N"}, "coreData": {"physicalAddress": {"city": "X"}}}, {"uei": "U", "legal_business_name": "N", "city": "X", "primary_naics": None}),
    "fec_committees": ({"committee_id": "C1", "cycles": [2020, 2022]}, {"cycles_json": "[2020,2022]", "candidate_ids_json": "[]"}),
    "congress_bills": ({"congress": 118, "type": "HR", "number": "1", "latestAction": {"text": "t"}}, {"bill_id": "118-hr-1", "bill_type": "hr", "latest_action_text": "t"}),
    "crs_reports": ({"id": "R1", "version": 3}, {"report_id": "R1", "version": "3"}),
    "lobbying_filings": ({"filing_uuid": "f", "client": {"client_id": 5}, "lobbying_activities": [{"general_issue_code": "ENV", "government_entities": [{"id": 1, "name": "EPA"}, {"id": 1, "name": "E.P.A."}]}, {"government_entities": [{"name": "DOE"}]}]}, {"client_id": "5", "government_entities_json": '[{"id":1,"name":"EPA"},{"id":null,"name":"DOE"}]'}),
    "court_dockets": ({"docket_id": 9, "case_name_full": "", "party": ["A", ""], "docket_absolute_url": "/docket/9/"}, {"cl_docket_id": "9", "case_name_full": None, "parties_json": '["A"]', "absolute_url": "https://www.courtlistener.com/docket/9/"}),
    "usaspending_recipients": ({"id": "r", "amount": 12.5}, {"recipient_id": "r", "total_award_amount": "12.5"}),
    "gao_reports": ({"link": "https://www.gao.gov/products/GAO-26-1/", "pubDate": "Tue, 05 Mar 2024 10:00:00 GMT"}, {"report_id": "gao-26-1", "published_date": "2024-03-05", "report_type": "Report"}),
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_shapes(spark, name):
    raw, want = SAMPLES[name]
    shape = SHAPES[name]
    got = shape.from_json(spark.createDataFrame([(json.dumps(raw),), ("junk",), ("{}",)], "j string"), "j").collect()
    assert len(got) == 1 and list(got[0].asDict()) == list(shape.columns)
    assert {k: got[0][k] for k in want} == want


def test_paged_source_halves_windows(spark):
    def fetch(since, until, page):
        days = [since.toordinal() + i for i in range((until - since).days + 1)]
        rows = [{"id": d * 10 + k, "day": str(d)} for d in days for k in range(3)]
        return rows[page * 4 : page * 4 + 4], page * 4 + 4 < len(rows), len(rows)

    windows = readers.day_windows(spark, "2024-01-01", "2024-01-10", 6)
    assert [(str(r.since), str(r.until)) for r in windows.orderBy("since").collect()] == [("2024-01-01", "2024-01-06"), ("2024-01-07", "2024-01-10")]
    got = paged.read(spark, fetch, windows, "id bigint, day string", "id", paged.Policy(ceiling=7))
    assert got.count() == 30 and got.select("id").distinct().count() == 30


def test_paged_retries_and_ends():
    calls = []

    def flaky(since, until, page):
        calls.append(page)
        if len(calls) < 3:
            raise OSError("reset")
        return [{"id": 1}], False, None

    slept = []
    got = list(paged.rows_of(paged.with_retries(flaky, paged.Policy(), slept.append), date(2024, 1, 1), date(2024, 1, 1), paged.Policy()))
    assert got == [{"id": 1}] and slept == [1.0, 2.0]
    over = lambda since, until, page: ([{"id": 1}, {"id": 2}], False, 9)
    back = lambda since, until, page: ([{"id": 3}], False, 9)
    assert sorted(r["id"] for r in paged.rows_of(over, date(2024, 1, 1), date(2024, 1, 1), paged.Policy(ceiling=2), back)) == [1, 2, 3]
