from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from skywarden.llm import warc
from skywarden.session import work_dir


def brute(rows):
    body = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for page, data in body:
        same = [p for p, d in body if d == data and p is not None]
        head = max(same) if len(data) >= 1000 and same and len([1 for _, d in body if d == data]) > 1 else page
        revisit = head != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    head if revisit else None))
    return sorted(out, key=repr)


PAGES = [(1, "http://a", "x" * 2000), (5, "http://b\r\nEvil: 1", "x" * 2000), (None, None, "x" * 2000), (7, None, None),
         (8, "u", "é" * 600), (8, "u", "é" * 600), (9, "s", "x"), (10, "t", "x"), (11, "", ""), (12, "w", "\r\n\r\nWARC/1.1\r\n" * 90),
         (13, "v", "y" * 300_000), (14, "v", "y" * 300_000)]


def test_pages_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1, "p") for r in PAGES], "page_id long, url string, html string, offset int, "
                                                                 "payload string").repartition(3)
    assert sorted((tuple(r) for r in warc.archived_pages(pages).collect()), key=repr) == brute(PAGES)


def test_no_pages(spark):
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_predicates_are_pushed_and_payloads_come_back(spark, monkeypatch, compression):
    monkeypatch.setattr(warc, "FILE_BYTES", 100_000)
    rng = random.Random(1)
    rows = [("response", f"<urn:x:{i}>", f"http://h{i % 3}/", f"2024-01-{i % 28 + 1:02}", None, {"Page-ID": str(i)}, None,
             bytearray(rng.randbytes(rng.choice([0, 10, 5000, 400_000])))) for i in range(24)]
    path = work_dir(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, warc._WRITE).repartition(2), path, compression)
    warc.write_warc(spark.createDataFrame(rows[:1], warc._WRITE), path, compression)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == 25 and {r.record_id: bytes(r.payload) for r in got} == {r[1]: bytes(r[7]) for r in rows}
    chosen = warc.read_warc(spark, path, payload="digest").where("target_uri = 'http://h1/' AND record_type IN ('response')")
    assert " Filter " not in chosen._jdf.queryExecution().executedPlan().toString()
    assert {(r.record_id, r.payload_digest, r.payload) for r in chosen.collect()} == {
        (r[1], hashlib.sha1(r[7]).hexdigest(), None) for r in rows if r[2] == "http://h1/"}
    assert warc.read_warc(spark, path, payload="skip", target_uri=["http://h2/"]).count() == 8
    assert warc.read_warc(spark, path).where("date LIKE '2024-01-0%' AND payload_bytes > 5").count() == sum(
        r[3].startswith("2024-01-0") and len(r[7]) > 5 for r in rows[:1] + rows)


def test_an_unwanted_payload_is_not_inflated(monkeypatch):
    records = [warc.record_bytes({"record_type": "response", "record_id": f"<{i}>", "target_uri": "u", "date": "d",
                                  "refers_to": None, "headers": [], "payload_digest": None,
                                  "payload": bytes(random.Random(i).randbytes(3_000_000))}) for i in range(3)]
    file = io.BytesIO(b"".join(map(warc.gzip_member, records)))
    read = []
    monkeypatch.setattr(warc._Inflated, "read", lambda self, n, f=warc._Inflated.read: (read.append(0), f(self, n))[1])
    wanted = warc.Wanted((("record_id", "in", ("<2>",)),))
    assert [r["record_id"] for r in warc.read_records(file, True, wanted, "skip")] == ["<2>"]
    assert len(read) <= 6


def test_members_of_other_writers_are_read():
    records = [warc.record_bytes({"record_type": "response", "record_id": f"<{i}>", "target_uri": "u", "date": "d",
                                  "refers_to": None, "headers": [], "payload_digest": None, "payload": b"ab" * i}) for i in range(4)]
    whole = b"".join(map(gzip.compress, records))
    assert gzip.decompress(b"".join(map(warc.gzip_member, records))) == b"".join(records)
    for data, packed in ((whole, True), (b"".join(records), False)):
        got = list(warc.read_records(io.BytesIO(data), packed, warc.Wanted(), "keep"))
        assert [r["payload"] for r in got] == [b"ab" * i for i in range(4)]
    bad = records[2].replace(b"abab\r\n\r\n", b"abxx\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(bad), False, warc.Wanted(), "keep"))


def test_uncommitted_files_are_not_read(spark, tmp_path):
    path = str(tmp_path / "w")
    row = ("response", "<a>", "u", "d", None, {}, None, bytearray(b"x"))
    warc.write_warc(spark.createDataFrame([row], warc._WRITE), path)
    lost = warc.gzip_member(warc.record_bytes({"record_type": "response", "record_id": "<lost>", "target_uri": "u", "date": "d",
                                               "refers_to": None, "headers": [], "payload_digest": None, "payload": b""}))
    (tmp_path / "w" / "lost.warc.gz").write_bytes(lost)
    assert [r.record_id for r in warc.read_warc(spark, path).collect()] == ["<a>"]
