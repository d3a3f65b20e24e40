import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from cambio.llm.queries import ORACLE_SQL, op4_warc
from cambio.llm.warc import REVISIT_PROFILE, assemble, classify_pages, parse_records, read_archives, write_archives
from tests.llm.helpers import HAVE_TABLES, SF_DIR, duck_rows

BIG = "p" * 100


def pages(spark, rows):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return frame.selectExpr("*", "'x' AS digest", "1 AS first", "2 AS payload_bytes", "3 AS record_id")


def captures(spark, tmp_path, rows):
    path = str(tmp_path / "archive")
    write_archives(classify_pages(pages(spark, rows)), path)
    return assemble(read_archives(spark, path))


def test_round_trip(spark, tmp_path):
    rows = [
        (3, "http://a/x", BIG),
        (1, "http://b/\r\nInjected: yes", BIG),
        (2, None, None),
        (4, "http://é/", "WARC/1.1\r\nfake\r\n\r\n" + "é" * 60),
        (5, "u", "short"),
        (6, "u", "short"),
        (7, "u", ""),
        (None, "u", BIG),
    ]
    got = captures(spark, tmp_path, rows).collect()
    assert len(got) == len(rows)
    by_page = {r.metadata[0].fields["page-id"]: r for r in got}
    first = by_page["1"]
    assert first.record_type == "response" and bytes(first.answer.payload).decode() == BIG
    for page in ("3", ""):
        assert by_page[page].record_type == "revisit"
        assert by_page[page].answer.refers_to == first.capture_id
        assert by_page[page].answer.payload_bytes == 100 and by_page[page].answer.payload is None
    assert {by_page[p].record_type for p in "24567"} == {"response"}
    assert bytes(by_page["4"].answer.payload).decode() == rows[3][2]
    assert by_page["2"].answer.payload_bytes == 0
    for r in got:
        assert [q.record_id.split(":")[-1] for q in r.requests] == ["request>"] and len(r.metadata) == 1
    assert "\r" not in first.target_uri and "\n" not in first.target_uri


def test_repeated_rows_and_empty_table(spark, tmp_path):
    got = captures(spark, tmp_path, [(1, "u", BIG), (1, "u", BIG), (2, "u", BIG)]).collect()
    assert sorted(r.record_type for r in got) == ["response", "response", "revisit"]
    assert captures(spark, tmp_path / "e", []).count() == 0


def test_many_pages_without_an_id_and_many_copies(spark, tmp_path):
    """Every capture has its own companions, or those of its copies: nothing is multiplied."""
    pages_of = spark.range(0, 20_000).selectExpr(
        "CASE WHEN id < 10000 THEN NULL WHEN id < 15000 THEN 7 ELSE id END AS page_id",
        "'http://u/' AS url",
        "CASE WHEN id % 2 = 0 THEN 'short' ELSE repeat('same ', 40) END AS html",
    )
    path = str(tmp_path / "many")
    write_archives(classify_pages(pages_of), path)
    found = assemble(read_archives(spark, path, with_payload=False))
    sums = found.groupBy("record_type").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("requests")).alias("most"), F.min(F.size("metadata")).alias("least")
    )
    counts = {r.record_type: (r.n, r.most, r.least) for r in sums.collect()}
    assert counts == {"response": (10_000 + 2_500, 1, 1), "revisit": (5_000 + 2_500, 1, 1)}
    assert found.where("requests[0].record_id LIKE '%none-%'").select("capture_id").distinct().count() == 10_000


def record(kind, record_id, *headers, block=b""):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", *headers, f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\n\r\npayload\r\n\r\nmore"


def test_members_and_foreign_records(spark, tmp_path):
    parts = [
        record("warcinfo", "<i>", block=b"software: x\r\n"),
        record("response", "<r>", "WARC-Concurrent-To: <q2>", block=HTTP),
        record("request", "<q1>", "WARC-Concurrent-To: <r>", block=b"GET / HTTP/1.1\r\n\r\n"),
        record("request", "<q2>", block=b"GET /2 HTTP/1.1\r\n\r\n"),
        record("metadata", "<m>", "WARC-Concurrent-To: <r>", "WARC-Concurrent-To: <gone>", block=b"a: 1\r\nb: 2\r\n"),
        record("metadata", "<orphan>", "WARC-Concurrent-To: <gone>", block=b"c: 3"),
        record("revisit", "<v>", f"WARC-Profile: {REVISIT_PROFILE}", block=b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n"),
    ]
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "members.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    for raw in (b"".join(parts), gzip.compress(b"".join(parts)), b"\r\n" + b"".join(parts)):
        assert [r[0] for r in parse_records(raw, True)] == ["<i>", "<r>", "<q1>", "<q2>", "<m>", "<orphan>", "<v>"]
    got = {r.capture_id: r for r in assemble(read_archives(spark, str(folder))).collect()}
    assert set(got) == {"<r>", "<v>"}
    assert bytes(got["<r>"].answer.payload) == b"payload\r\n\r\nmore"
    assert got["<r>"].answer.payload_sha256 == hashlib.sha256(b"payload\r\n\r\nmore").hexdigest()
    assert [q.record_id for q in got["<r>"].requests] == ["<q1>", "<q2>"]
    assert [m.fields for m in got["<r>"].metadata] == [{"a": "1", "b": "2"}]
    assert got["<v>"].answer.payload_bytes == 9 and got["<v>"].requests == []


def test_damage_is_noticed():
    whole = record("response", "<r>", block=HTTP)
    with pytest.raises(ValueError, match="cut off"):
        list(parse_records(whole[:-9], True))
    with pytest.raises(ValueError, match="no WARC record"):
        list(parse_records(b"junk" + whole, True))


@pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")
def test_query_equals_its_sql(spark):
    got = op4_warc(spark, SF_DIR)
    html = spark.read.parquet(f"{SF_DIR}/pages.parquet").toPandas()
    sql = "SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM (" + ORACLE_SQL["op4_warc"] + ")"
    assert sorted(map(tuple, got.collect())) == sorted(duck_rows(sql, pages=html))
