import hashlib
import os

import pytest

from lakewright.llm import common
from lakewright.llm import warc as w

PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (3, None, "x" * 999), (4, "http://a/4", "x" * 999), (5, "http://a/\r\nX: y", None), (6, "u", ""),
    (7, "u", "é" * 500), (8, "u", "é" * 500), (8, "u", "é" * 500), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (None, "u", "x" * 1000), (None, "u", "alone" * 300), (10, "u", "big " * 200_000),
]


def brute(rows):
    best = {}
    for k, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and k is not None:
            best[b] = max(best.get(b, k), k)
    n = {}
    for _, _, h in rows:
        n[(h or "").encode()] = n.get((h or "").encode(), 0) + 1
    out = []
    for k, _, h in rows:
        b = (h or "").encode()
        to = best.get(b) if n[b] > 1 else None
        to = None if to == k else to
        out.append((k, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, payload string")


def test_round_trip(spark, pages):
    assert sorted((tuple(r) for r in w.query(pages.repartition(3)).collect()), key=str) == brute(PAGES)
    assert w.query(pages.limit(0)).count() == 0


def test_salted_join_gives_the_same(spark, pages, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    assert sorted((tuple(r) for r in w.query(pages).collect()), key=str) == brute(PAGES)


def test_payloads_and_single_records(spark, pages):
    folder = w._uri(common.new_path(spark, "warc"))
    manifest = w.write(pages, folder)
    got = {(r["page_id"], r["record_type"]): r for r in w.read(manifest, folder, True).collect()}
    assert bytes(got[9, "response"]["payload"]).decode() == PAGES[9][2]
    place = manifest.filter("page_id = 10").first()
    headers, payload = w.read_record(folder, place["bundle"], place["frame_offset"], place["record_offset"])
    assert payload.decode() == PAGES[-1][2] and headers["warc-target-uri"] == "u"


def test_bundle_is_plain_zstandard_with_seek_table(tmp_path):
    import zstandard

    files, root = w.open_folder(str(tmp_path))
    b = w.BundleWriter(files.open_output_stream(f"{root}/b.zst", compression=None))
    raw = [w.record(k, "u", os.urandom(90_000), None) for k in range(9)]
    places = [b.add(x) for x in raw]
    b.close()
    data = (tmp_path / "b.zst").read_bytes()
    assert data[-4:] == (0x8F92EAB1).to_bytes(4, "little")
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data[: data.rindex((0x184D2A5E).to_bytes(4, "little"))]) == b"".join(raw)
    with files.open_input_file(f"{root}/b.zst") as source:
        table = w.seek_table(source)
    assert {f for f, _, _ in places} == set(range(len(table))) and sum(n for _, _, n in table) == sum(map(len, raw))


def test_records_are_http_messages_with_unique_names(spark, pages):
    folder = w._uri(common.new_path(spark, "warc"))
    manifest = w.write(pages.coalesce(1), folder)
    heads = {}
    for r in manifest.filter("page_id in (1, 2, 9)").collect():
        headers, payload = w.read_record(folder, r["bundle"], r["frame_offset"], r["record_offset"])
        heads[r["page_id"]] = headers
        assert headers["content-type"] == "application/http; msgtype=response"
    assert heads[1]["warc-refers-to"] == heads[2]["warc-record-id"] != heads[1]["warc-record-id"]
    raw = w.record(9, "u", b"<p>", None)
    assert b"\r\n\r\nHTTP/1.1 200 OK\r\n" in raw and raw.endswith(b"\r\n\r\n<p>\r\n\r\n")


def test_each_bundle_is_opened_by_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(w, "READ", 1 << 12)
    rows = [(k, f"http://a/{k}", f"{k} " * 2000) for k in range(200)]
    folder = f"file://{tmp_path}/bundles"
    manifest = w.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6), folder)
    df = w.read(manifest, folder)
    assert df.rdd.getNumPartitions() == 6 and df.count() == 200
    from pyspark.sql import functions as F

    names = manifest.select("page_id", "bundle").join(df.select("page_id", F.spark_partition_id().alias("task")), "page_id")
    assert names.groupBy("bundle").agg(F.countDistinct("task").alias("n")).filter("n > 1").count() == 0
