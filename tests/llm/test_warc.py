import gzip
import hashlib
import io

import pytest

from jobloom.llm import warc

PAGES = "page_id bigint, url string, html string, digest string"


def one(payload=b"x" * 200, refers_to=None, url="http://a/b\r\n%"):
    return warc.record_bytes(5, url, payload, hashlib.sha256(payload).hexdigest(), refers_to)


def read(data, **options):
    return list(warc.read_records(io.BytesIO(data), **options))


def test_round_trip_of_records():
    big = bytes(range(256)) * 5000
    found = read(one() + one(b"") + one(big) + one(b"y" * 300, refers_to=2))
    assert [r["payload"] for r in found] == [b"x" * 200, b"", big, b""]
    assert [r["payload_bytes"] for r in found] == [200, 0, len(big), 300]
    assert [r["record_type"] for r in found] == ["response"] * 3 + ["revisit"]
    assert found[3]["refers_to"] == "<urn:record:2>"
    assert found[1]["at"] == len(one())
    assert warc._unescaped(found[0]["url"]) == "http://a/b\r\n%"


@pytest.mark.parametrize("url", ["http://a/" + "x" * (3 << 20), " http://a/b c\t", "\u00a0a\u2028", "%20%2520%0D%", "", " "])
def test_urls_come_back_as_they_are(url):
    found = read(one(url=url) + one(b"z" * 100, url=url))
    assert [warc._unescaped(r["url"]) for r in found] == [url, url]
    assert [r["payload"] for r in found] == [b"x" * 200, b"z" * 100]


def test_each_record_is_a_member():
    assert gzip.decompress(one()).startswith(b"WARC/1.1\r\n")
    assert gzip.decompress(one()).endswith(b"\r\n\r\n")


def changed(data, old, new):
    return gzip.compress(gzip.decompress(data).replace(old, new))


@pytest.mark.parametrize("data, fault", [
    (one()[:-30], "ends within"),
    (b"no gzip at all, just text", "not a gzip"),
    (changed(one(), b"x" * 200, b"y" + b"x" * 199), "digest"),
    (changed(one(), b"x" * 200, b"x" * 199), "shorter|longer"),
    (changed(one(), b"x" * 200, b"x" * 201), "longer"),
    (changed(one(), b"WARC/1.1", b"HTTP/1.1"), "version"),
    (changed(one(), b"\r\nContent-Length: ", b"\r\nX-Length: "), "content length"),
    (gzip.compress(b"WARC/1.1\r\n"), "header"),
])
def test_damage_is_told(data, fault):
    with pytest.raises(warc.Damaged, match=fault):
        read(data)


def test_digest_in_base_32():
    import base64

    b32 = base64.b32encode(hashlib.sha1(b"x" * 200).digest())
    hexed = b"sha256:" + hashlib.sha256(b"x" * 200).hexdigest().encode()
    assert read(changed(one(), b"Payload-Digest: " + hexed, b"Payload-Digest: sha1:" + b32))


def test_operator(spark):
    long = "é" * 60
    rows = [(3, "u", long, "d"), (1, "v", long, "d"), (2, None, long, "d"), (None, "w", long, "d"),
            (1, "v", long, "d"), (4, "u", "short", "d"), (5, "u", "short", "d"), (6, "u", None, "d"),
            (7, "u", "", "d"), (8, "u", "a" * 100, "d"), (9, "u", "q" * 3_000_000, "d")]
    pages = spark.createDataFrame(rows, PAGES)
    found = warc.round_trip(pages, with_payload=True).collect()
    seen = sorted(((r.id, r.record_type, r.refers_to, r.payload_bytes) for r in found), key=str)
    assert seen == sorted([
        (3, "revisit", 1, 120), (1, "response", None, 120), (2, "revisit", 1, 120),
        (None, "revisit", 1, 120), (1, "response", None, 120), (4, "response", None, 5),
        (5, "response", None, 5), (6, "response", None, 0), (7, "response", None, 0),
        (8, "response", None, 100), (9, "response", None, 3_000_000)], key=str)
    payloads = {r.id: r.payload for r in found if r.record_type == "response"}
    assert payloads[1].decode() == long and payloads[9] == b"q" * 3_000_000
    assert {r.url for r in found if r.id == 2} == {None}
    for r in found:
        content = dict((x[0], x[2] or "") for x in rows)[r.id].encode()
        assert r.payload_digest == hashlib.sha256(content).hexdigest()


def test_many_archives_and_none(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}" * 30, "d") for i in range(40)], PAGES)
    manifest = warc.write_archives(warc.planned_records(pages), f"file://{tmp_path}/a", 400)
    assert manifest.count() > 5
    read = warc.read_archives(spark, manifest, f"file://{tmp_path}/a", with_payload=False)
    assert sorted(r.id for r in read.collect()) == list(range(40))
    assert warc.round_trip(pages.limit(0)).count() == 0
