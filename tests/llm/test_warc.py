import base64
import hashlib

import pytest

from lakeshore.llm import queries, warc

from ..conftest import SF001
from ..harness import compare, duck_connection

ROWS = [
    (1, "http://a/ b", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (3, None, None), (4, "http://c", ""), (5, "http://d\r\nx", "é" * 10),
    (6, "http://e", "x" * 300_000), (None, "http://f", "<p>same</p>"), (7, "http://g", "own\r\n\r\nbody"), (7, "http://g", "own\r\n\r\nbody"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("version", ["1", "2"])
def test_round_trip(spark, version):
    got = warc.archive_pages(pages(spark).selectExpr("*", "'x' as size", "'y' as path"), version).collect()
    assert len(got) == len(ROWS)
    for page in {r[0] for r in ROWS}:
        html = next(r[2] for r in ROWS if r[0] == page) or ""
        for g in (g for g in got if g.page_id == page):
            assert g.payload_bytes == len(html.encode())
            assert g.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    at = {g.page_id: g for g in got}
    assert (at[1].record_type, at[1].refers_to) == ("response", None)
    assert (at[2].record_type, at[2].refers_to) == ("revisit", 1) and (at[None].record_type, at[None].refers_to) == ("revisit", 1)
    assert (at[4].record_type, at[4].refers_to) == ("revisit", 3)  # null and empty html are the same payload
    assert sorted((g.record_type, g.refers_to) for g in got if g.page_id == 7) == [("response", None), ("revisit", 7)]


def test_short_payloads_may_all_be_responses(spark):
    got = {g.page_id: g.record_type for g in warc.archive_pages(pages(spark, ROWS[:4]), least_bytes=100).collect()}
    assert set(got.values()) == {"response"}


def test_many_records_roll_over_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    m = warc.write_arc(pages(spark, [(i, f"http://{i}", f"text {i % 30}") for i in range(100)]).coalesce(1))
    assert m.count() >= 1
    got = warc.read_warc(warc.convert(m)).collect()
    assert sorted(g.page_id for g in got) == list(range(100))
    assert all(g.refers_to == (g.page_id % 30 if g.page_id >= 30 else None) for g in got)


def test_archives_of_both_versions_in_turn(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    rows = pages(spark, [(i, f"http://{i}", f"text {i % 30}") for i in range(100)]).repartition(3)
    m = warc.write_arc(rows)
    fields = [{len(header) for _, header, _ in warc.parse_arc(r.path)} for r in m.collect()]
    assert sorted(set(map(tuple, fields))) == [(5,), (10,)]
    got = warc.read_warc(warc.convert(m)).collect()
    assert sorted((g.page_id, g.refers_to) for g in got) == [(i, i % 30 if i >= 30 else None) for i in range(100)]


def test_header_rules():
    assert warc.iso_time("20260102030405") == "2026-01-02T03:04:05Z" and warc.iso_time("199912") == "1999-12-01T00:00:00Z"
    line = warc.arc_record("2", "n.arc.gz", 99, 5, "http://u", "hi").split(b"\n", 1)[0].split(b" ")
    assert len(line) == len(warc.ARC_FIELDS["2"].split(" ")) and line[7] == b"99"


def test_damaged_length_is_an_error(tmp_path):
    a = warc.Archive(f"file://{tmp_path}", ".arc.gz")
    a.add(warc.arc_first("1", a.name), counted=False)
    a.add(b"http://x 0.0.0.0 20260101000000 text/html 50\nshort\n")
    path, _, _ = a.close()
    with pytest.raises(ValueError, match="declares 50 bytes"):
        list(warc.parse_arc(path))


def test_query_matches_sql(spark):
    got, want = queries.op2_warc(spark, SF001).toPandas(), duck_connection(SF001).execute(queries.ORACLE_SQL["op2_warc"]).df()
    assert compare(got, want)["values_match"]


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark).limit(0)).count() == 0
