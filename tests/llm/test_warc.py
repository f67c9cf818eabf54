import base64
import hashlib
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from txguard.llm import warc

ROWS = [
    (1, "http://a/", "<p>same</p>"), (5, "http://b/", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "u\r\nX: y%20 é", "é" * 50), (6, "", None),
    (7, "e", ""), (None, "n", "<p>none</p>"), (None, "n", "<p>none</p>"), (8, "n", "<p>none</p>"), (9, "long", "x" * 3_000_000), (4, "again", "é" * 50)]


@pytest.fixture
def pages(spark):
    def build(rows=ROWS):
        return spark.createDataFrame(rows, "page_id long, url string, html string")

    return build


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def by_hand(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None] if len(payload) >= least else []
        refers = None if not same or page == max(same) or sum((h or "").encode() == payload for _, _, h in rows) < 2 else max(same)
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_round_trip(pages, clashing):
    found = warc.round_trip(clashing(pages())).collect()
    assert sorted((tuple(r) for r in found), key=str) == by_hand(ROWS)
    assert warc.round_trip(pages([])).count() == 0


def test_bundles_are_seekable(spark, pages, folder):
    index = warc.write(pages(), folder, frame_bytes=200, bundle_bytes=400).collect()
    assert len(index) == len(ROWS)
    assert len({r["bundle"] for r in index}) > 1
    texts = {(p, (h or "").encode()) for p, _, h in ROWS}
    for r in index:
        head, body = warc.fetch(folder, r["bundle"], r["frame_offset"], r["at"])
        assert head["WARC-Type"] == "revisit" or (r["page_id"], body) in texts
        with open(f"{folder.removeprefix('file://')}/{r['bundle']}", "rb") as file:
            data = file.read()
        frames = warc.read_seek_table(lambda at, n: data[at:at + n], len(data))
        offset, packed, plain = frames[r["frame"]]
        assert offset == r["frame_offset"]
        assert len(zstandard.ZstdDecompressor().decompress(data[offset:offset + packed])) == plain
    back = warc.read(spark, folder).collect()
    assert sorted((r["url"] for r in back), key=str) == sorted((u for _, u, _ in ROWS), key=str)


def test_records_are_found_by_their_identifier(spark, pages, folder):
    index = warc.write(pages(), folder, frame_bytes=200).collect()
    assert len({r["record_id"] for r in index}) == len(ROWS)
    for r in index:
        head, body = warc.fetch_record(spark, folder, r["record_id"])
        assert head["WARC-Record-ID"] == f"<{r['record_id']}>"
        if r["page_id"] is None:  # reachable all the same
            assert head["WARC-Target-URI"] == "n" and head["WARC-Type"] == "revisit"
    assert warc.fetch_record(spark, folder, "urn:uuid:none") is None


def test_reading_tasks_follow_the_bytes(spark, pages, folder, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 50_000)
    plain = sum(r["length"] for r in warc.write(pages([(i, "u", f"{i:05d}" * 2000) for i in range(100)]), folder, frame_bytes=20_000).collect())
    found = warc.read(spark, folder)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert found.rdd.getNumPartitions() == -(-plain // 50_000) == 21 and sum(sizes) == 100 and len(sizes) > 10


def test_object_stores_by_their_arrow_names():
    assert warc.arrow_uri("file:///x/y") == "file:///x/y" and warc.arrow_uri("/x/y") == "/x/y"
    assert warc.arrow_uri("s3a://bucket/x", {}) == "s3://bucket/x"
    assert warc.arrow_uri("s3a://bucket/x", {"OBJECT_STORE_ENDPOINT": "http://store:9000"}) == "s3://bucket/x?scheme=http&endpoint_override=store:9000"
    assert warc.arrow_uri("s3a://bucket/x", {"OBJECT_STORE_ENDPOINT": "store:9000"}) == "s3://bucket/x?scheme=https&endpoint_override=store:9000"


def test_files_outside_the_index_do_not_count(spark, pages, folder):
    warc.write(pages(), folder)
    with open(f"{folder.removeprefix('file://')}/left-behind.warc.zst", "wb") as file:
        file.write(b"half a frame")
    assert warc.read(spark, folder).count() == len(ROWS)


def test_damage_is_noticed(spark, pages, folder):
    bundle = warc.write(pages([(1, "u", "text " * 1000)]), folder).first()["bundle"]
    path = f"{folder.removeprefix('file://')}/{bundle}"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 3] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        warc.read(spark, folder).collect()


def test_small_payloads_and_the_shuffled_path(spark, pages, folder, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_BROADCAST", 0)
    warc.write(pages(), folder, min_bytes=12)
    found = warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in found), key=str) == by_hand(ROWS, 12)
