"""WARC archives: round trips, pushed filters, other writers' files."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, _id int")


ROWS = [(5, "http://a", "same"), (2, "http://b", "same"), (9, "http://c", "same"), (1, None, None), (7, "http://d\r\nx", ""),
        (3, "http://é", "é" * 5000), (4, "u", "WARC/1.1\r\n\r\n"), (8, "u", "x" * 300_000), (2, "http://b", "same")]


def plain(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        again = len(b) >= min_bytes and i != first[h or ""]
        out.append((i, len(b), digest, "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out)


@pytest.mark.parametrize("min_bytes", [0, 3, 5])
def test_round_trip(spark, min_bytes):
    got = warc.pages_round_trip(pages(spark, ROWS), min_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect())) == plain(ROWS, min_bytes)


def test_odd_tables(spark):
    assert warc.pages_round_trip(pages(spark, ROWS).limit(0)).collect() == []
    out = warc.pages_round_trip(pages(spark, [(None, "u", "a"), (None, "u", "b"), (3, "u", "b")])).collect()
    assert sorted((r.page_id is None, r.record_type, r.refers_to) for r in out) == [
        (False, "response", None), (True, "response", None), (True, "revisit", 3)]


def test_payloads_and_pushed_filters(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write_archive(warc.archive_records(pages(spark, ROWS)), path)
    back = warc.read_archive(spark, path, partition_bytes=1)
    texts = {r.record_id: bytes(r.payload).decode() for r in back.collect() if r.payload is not None}
    assert texts["urn:page:3"] == "é" * 5000 and texts["urn:page:1"] == ""
    revisits = back.where("record_type = 'revisit'")
    assert {r.refers_to for r in revisits.collect()} == {"urn:page:1", "urn:page:2"} and revisits.count() == 3
    assert back.where(F.col("record_type").isin("response") & (F.col("record_id") == "urn:page:8")).count() == 1
    assert back.where("target_uri IS NULL").count() == 1 and back.where("record_type = 'x'").count() == 0
    assert back.where("payload_length > 9000").select("record_id").count() == 2


def test_records_that_fail_are_not_inflated(tmp_path, monkeypatch):
    data = b"".join(warc.record_bytes({"record_id": f"r{k}", "record_type": "response" if k % 2 else "revisit",
                                       "payload": bytes([k]) * 500_000}) for k in range(6))
    made = []
    real = warc._payload
    monkeypatch.setattr(warc, "_payload", lambda h, b: made.append(1) or real(h, b))
    file = tmp_path / "x.warc.gz"
    file.write_bytes(data)
    with open(file, "rb") as f:
        got = list(warc.read_records(f, len(data), lambda r: r["record_id"] == "r3"))
    assert [r["record_id"] for r in got] == ["r3"] and len(got[0]["payload"]) == 500_000 and len(made) == 1


@pytest.mark.parametrize("form", ["plain", "members", "one member"])
def test_files_of_other_writers(tmp_path, form):
    def record(k):
        body = b"body %d" % k
        return (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Type: text/plain\r\n"
                b"Content-Length: %d\r\n\r\n" % (k, len(body))) + body + b"\r\n\r\n"
    records = [record(k) for k in range(5)]
    data = {"plain": b"".join(records), "members": b"".join(map(gzip.compress, records)),
            "one member": gzip.compress(b"".join(records))}[form]
    file = tmp_path / "x"
    file.write_bytes(data)
    for payload in (True, False):
        with open(file, "rb") as f:
            got = list(warc.read_records(f, len(data), lambda r: r["record_id"] != "urn:x:2", payload))
        assert [r["record_id"] for r in got] == ["urn:x:0", "urn:x:1", "urn:x:3", "urn:x:4"]
        assert [r.get("payload") for r in got] == [b"body %d" % k if payload else None for k in (0, 1, 3, 4)]


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_local_paths_with_spaces_and_signs(prefix, tmp_path):
    system, path = warc._open(f"{prefix}{tmp_path}/a b%20c?d")
    system.create_dir(path)
    with system.open_output_stream(f"{path}/x", compression=None) as out:
        out.write(b"1")
    assert (tmp_path / "a b%20c?d" / "x").read_bytes() == b"1"
