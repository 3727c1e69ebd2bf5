import base64
import hashlib
import os
import random

import pytest
import zstandard

from llm.catalog import QUERIES
from llm.warc import base32_sha1, read_archive, read_archives, warc_round_trip, write_archives


def want(rows, least=0):
    best = {}
    for i, h in rows:
        p = (h or "").encode()
        best[p] = max(best.get(p, -1), -1 if i is None else i)
    out = []
    for i, h in rows:
        p = (h or "").encode()
        first = len(p) < least or (-1 if i is None else i) == best[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit",
                    None if first else best[p]))
    return sorted(out, key=str)


def pages(seed):
    rnd = random.Random(seed)
    body = ["<html>" + "".join(rnd.choice(["<p>", "é", "hello ", "\r\n\r\n", "WARC/1.1\r\n"]) for _ in range(rnd.randrange(200))) for _ in range(40)]
    rows = [(i, rnd.choice(body)) for i in range(150)] + [(200, None), (201, ""), (202, None), (203, "x" * 3_000_000)]
    return rows + [(5, body[0]), (5, body[0]), (None, "only null id"), (None, body[1])]


@pytest.mark.parametrize("least", [0, 300])
def test_round_trip(spark, least):
    rows = pages(1)
    df = spark.createDataFrame([(i, h, f"http://e/{i} \r\nX: y", "z") for i, h in rows], "page_id long, html string, url string, _id string").repartition(3)
    manifest, out = warc_round_trip(df, min_revisit_bytes=least)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect()), key=str)
    assert got == want(rows, least)
    assert sum(r.records for r in manifest.collect()) == len(rows)


def test_payloads_come_back_and_damage_is_noticed(spark, tmp_path):
    rows = [(i, None, f"page {i} ".encode() * 50, base32_sha1(f"page {i} ".encode() * 50), i, True) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, uri string, payload binary, digest string, response_id long, is_response boolean").coalesce(1)
    manifest = write_archives(df, str(tmp_path))
    got = {r.page_id: bytes(r.payload) for r in read_archives(manifest, payloads=True).collect()}
    assert got == {r[0]: r[2] for r in rows}
    path = manifest.first().path
    data = open(path, "rb").read()
    assert data[:4] == b"\x5d\x2a\x4d\x18"  # the dictionary comes first
    for bad in (data[:-5], data[:60], data[:-40] + bytes([data[-40] ^ 255]) + data[-39:]):
        broken = tmp_path / "broken.warc.zst"
        broken.write_bytes(bad)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(read_archive(str(broken)))
    plain = tmp_path / "plain.warc.zst"
    plain.write_bytes(zstandard.ZstdCompressor().compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"))
    with pytest.raises(ValueError, match="missing"):
        list(read_archive(str(plain)))
    assert os.path.exists(path)


def test_empty_table(spark):
    manifest, out = warc_round_trip(spark.createDataFrame([], "page_id long, html string, url string"))
    assert manifest.count() == 0 and out.collect() == []


def test_registered_query_on_the_whole_small_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{d}/pages.parquet").collect()]
    got = QUERIES["op4_warc_archives"](spark, d)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want(rows)


def record(kind, block, *fields, version="WARC/1.0", nth=1):
    head = [version, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:00000000-0000-0000-0000-{nth:012d}>", "WARC-Date: 2024-01-01T00:00:00Z",
            *fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n"


def foreign():
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    return [
        record("warcinfo", b"software: other\r\n", "Content-Type: application/warc-fields", version="WARC/1.1"),
        record("request", b"GET / HTTP/1.1\r\nHost: e\r\n\r\n", "Content-Type: application/http; msgtype=request", nth=2),
        record("response", HTTP + b"hello", "WARC-Target-URI: http://e/", "Content-Type: application/http;msgtype=response",
               "WARC-Concurrent-To: <urn:uuid:a>", "WARC-Concurrent-To: <urn:uuid:b>", nth=3),
        record("response", HTTP + b"hello", "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{base32_sha1(b'hello')}",
               "WARC-Block-Digest: sha256:" + hashlib.sha256(HTTP + b"hello").hexdigest(), "X-Long: one\r\n two", nth=4),
        record("response", chunked + b"5\r\nhello\r\n0\r\n\r\n", f"WARC-Payload-Digest: sha1:{base32_sha1(b'hello')}", nth=5),
        record("response", b"20240101 example", "Content-Type: text/dns", "WARC-Payload-Digest: blake9:zzz", nth=6),
        record("revisit", HTTP, "WARC-Refers-To: <urn:uuid:00000000-0000-0000-0000-000000000003>", f"WARC-Payload-Digest: sha1:{base32_sha1(b'hello')}", nth=7),
        record("metadata", b"fetchTimeMs: 1\r\n", nth=8), record("resource", b"", nth=9), record("conversion", "téxt".encode(), nth=10),
        record("response", HTTP + b"cut", "WARC-Truncated: length", f"WARC-Payload-Digest: sha1:{base32_sha1(b'longer')}", nth=11)]


def archive(path, records):
    squeeze = zstandard.ZstdCompressor()
    skippable = b"\x50\x2a\x4d\x18" + (4).to_bytes(4, "little") + b"note"
    path.write_bytes(skippable.join(squeeze.compress(r) for r in records))
    return str(path)


def test_archives_of_others(spark, tmp_path):
    path = archive(tmp_path / "other.warc.zst", foreign())
    rows = read_archives(spark.createDataFrame([(path, None), ("file://" + path, len(foreign()))], "path string, records long"), payloads=True).collect()
    assert len(rows) == 2 * len(foreign())
    first = {int(r.record_id[-13:-1]): r for r in rows}
    assert [first[k].record_type for k in sorted(first)] == ["warcinfo", "request", "response", "response", "response", "response", "revisit",
                                                            "metadata", "resource", "conversion", "response"]
    assert bytes(first[3].payload) == bytes(first[4].payload) == b"hello" and bytes(first[6].payload) == b"20240101 example"
    assert first[2].payload_bytes == 0 and first[9].payload_bytes == 0 and first[10].payload_bytes == 5
    assert first[7].payload_bytes is None and first[7].refers_to_id == "<urn:uuid:00000000-0000-0000-0000-000000000003>"
    assert all(r.page_id is None and r.refers_to is None for r in rows)
    one = list(read_archive(path))
    assert one[2].fields["warc-concurrent-to"] == ["<urn:uuid:a>", "<urn:uuid:b>"] and one[3].get("x-long") == "one two"


@pytest.mark.parametrize("bad, why", [
    (record("response", HTTP + b"x", f"WARC-Payload-Digest: sha1:{base32_sha1(b'y')}"), "payload and digest"),
    (record("metadata", b"x", "WARC-Block-Digest: md5:" + "0" * 32), "block and digest"),
    (record("metadata", b"x", version="WARC/9.9"), "no WARC header"),
    (record("metadata", b"x", "no colon"), "bad header line"),
    (record("metadata", b"x")[:-1], "its header says"),
    (record("metadata", b"x").replace(b"Content-Length: 1", b"Content-Length: -1"), "bad length")])
def test_records_that_do_not_hold(tmp_path, bad, why):
    with pytest.raises(ValueError, match=why):
        list(read_archive(archive(tmp_path / "bad.warc.zst", [bad])))


def test_folders_are_qualified_by_the_default_file_system(spark, tmp_path):
    from llm.warc import _filesystem, qualified

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, str(tmp_path)).startswith("file:/")
    assert _filesystem(qualified(spark, str(tmp_path)))[1] == str(tmp_path)
    rows = [(1, None, b"p", base32_sha1(b"p"), 1, True)]
    df = spark.createDataFrame(rows, "page_id long, uri string, payload binary, digest string, response_id long, is_response boolean")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")
    conf.set("fs.viewfs.mounttable.elsewhere.link./ckpt", f"file://{tmp_path}/")
    try:
        assert qualified(spark, "/ckpt/x") == "viewfs://elsewhere/ckpt/x"
        with pytest.raises(Exception, match="viewfs"):
            write_archives(df, "/ckpt/x")
    finally:
        conf.set("fs.defaultFS", before)
    assert not os.path.exists("/ckpt")
