import base64
import gzip
import hashlib
import io

import pytest

from stopcast.llm import warc
from stopcast.llm.common import shared_folder

PAGES = [(5, "http://a/5", "same"), (3, "http://a/3\r\n%0A", "same"), (9, None, None), (2, "u", ""), (None, "n", "same"),
         (3, "again", "same"), (7, "z", "é" * 200_000), (8, "tie", "other")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "page_id long, url string, html string, payload string, refers_to int")


def test_round_trip(spark):
    path = warc.write_warc(pages(spark), shared_folder(spark, "t"))
    got = warc.read_warc(spark, path, verify=True).where("record_type <> 'warcinfo'").collect()
    assert sorted([(r.page_id, r.target_uri) for r in got], key=str) == sorted([p[:2] for p in PAGES], key=str)
    want = {p[2] or "" for p in PAGES}
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() in want
            assert r.payload_digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
            assert r.payload_bytes == len(r.payload) and r.refers_to is None
        else:
            assert bytes(r.payload) == b""


def test_contract_columns(spark):
    got = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.archive_round_trip(pages(spark)).collect()}
    assert got[5, 4] == ("revisit", 3) and got[3, 4] == ("response", None) and got[None, 4] == ("revisit", 3)
    assert got[9, 0] == ("revisit", 2) and got[2, 0] == ("response", None)
    assert got[7, 400_000] == ("response", None) and got[8, 5] == ("response", None)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_least_payload(spark):
    got = warc.archive_round_trip(pages(spark), least=5).collect()
    assert {r.record_type for r in got} == {"response"}


def test_predicates_reach_the_reader(spark):
    """No filter is left above the scan, so the rows are those that the reader itself let through."""
    path = warc.write_warc(pages(spark), shared_folder(spark, "t"))
    df = warc.read_warc(spark, path, "page_id bigint, record_type string")
    pushed = df.where("record_type = 'revisit' and page_id > 4")
    assert " Filter (" not in pushed._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id for r in pushed.collect()} == {5, 9}
    own = df.where("page_id % 2 = 1 and page_id > 4")
    assert " Filter (" in own._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id for r in own.collect()} == {r.page_id for r in df.collect() if r.page_id and r.page_id > 4 and r.page_id % 2}


def test_reader_rejects_before_decoding(monkeypatch):
    """A record whose header fails the test is skipped by its length."""
    data = b"".join(warc.gzip_member(warc.page_record(i, f"u{i}", b"<p>" * 50_000, None, "2020-01-01T00:00:00Z")) for i in range(20))
    assert gzip.decompress(data).count(b"WARC/1.1") == 20
    inflated = []
    more = warc.Member.more
    monkeypatch.setattr(warc.Member, "more", lambda self, want=1 << 16: inflated.append(want) or more(self, want))
    rows = list(warc.read_records(io.BufferedReader(io.BytesIO(data)), 0, len(data), [("=", "page_id", 7)], True, True, True))
    assert [r["page_id"] for r in rows] == [7] and rows[0]["payload"] == b"<p>" * 50_000
    assert len(inflated) < 30


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_foreign_archives(spark, pack, tmp_path):
    records = [warc.page_record(i, f"u{i}", b"x" * (i * 1000), None, "2020-01-01T00:00:00Z") for i in range(5)]
    (tmp_path / f"a.warc{'' if pack(b'ab') == b'ab' else '.gz'}").write_bytes(b"".join(map(pack, records)))
    got = warc.read_warc(spark, f"file://{tmp_path}", verify=True).collect()
    assert [(r.page_id, r.payload_bytes) for r in got] == [(i, i * 1000) for i in range(5)]
    assert warc.read_warc(spark, f"file://{tmp_path}", "page_id bigint").count() == 5


def test_damage_is_an_error():
    record = bytearray(warc.page_record(1, "u", b"payload", None, "2020-01-01T00:00:00Z"))
    record[record.index(b"payload")] = 0
    with pytest.raises(ValueError):
        list(warc.read_records(io.BufferedReader(io.BytesIO(bytes(record))), 0, len(record), [], True, True, True))
    with pytest.raises(EOFError):
        list(warc.read_records(io.BufferedReader(io.BytesIO(bytes(record[:-20]))), 0, len(record), [], True, True, False))
