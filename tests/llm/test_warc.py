"""Archives: round trips, framing by chunks of any size, and what damaged archives do."""

import gzip
import hashlib
import zlib

import pytest

from ledgerlark.llm import queries, warc
from ledgerlark.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, payload string, __sha string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def written_and_read(spark, rows, **options):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(pages(spark, rows), folder, **options)
    return manifest, folder, warc.read_archives(manifest, folder, with_payload=True).collect()


def test_frames(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [
        (1, "http://a.com/é b%20\r\nx", big), (5, None, big), (3, "u", big), (2, "", None), (4, "u", ""), (7, "u", "x" * 999),
        (6, "u", "x" * 999), (8, "u", other), (8, "u", other), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 90), (None, None, other),
        (10, "u", "long " * 400_000), (-7, "u", "y"),
    ]
    manifest, _, out = written_and_read(spark, rows)
    assert manifest.count() >= 1
    assert len(out) == len(rows) and all(r.verified for r in out)
    for r in out:
        same = [x for x in rows if x[0] == r.page_id]
        payload = (same[0][2] or "").encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha1(payload).hexdigest()
        assert r.url == same[0][1]
        assert r.payload == (b"" if r.record_type == "revisit" else payload)
    told = sorted((r.page_id if r.page_id is not None else 99, r.record_type, r.refers_to) for r in out)
    assert [t for t in told if t[1] == "revisit"] == [(1, "revisit", 5), (3, "revisit", 5), (99, "revisit", 8)]
    assert written_and_read(spark, [])[2] == []


def test_small_archives(spark):
    rows = [(i, f"http://x/{i}", f"page {i} " * 50) for i in range(200)]
    manifest, folder, out = written_and_read(spark, rows, archive_bytes=2000)
    assert manifest.count() > 20
    assert sorted(r.page_id for r in out) == list(range(200))
    lean = warc.read_archives(manifest, folder)
    assert "payload" not in lean.columns and lean.where("verified").count() == 200


def test_query(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    df = queries.QUERIES["op5_warc"](spark, FOLDER)
    cursor = con.execute(queries.ORACLES["op5_warc"])
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, cursor.fetchall()))


def archive():
    return [warc.record(i, f"http://h/{i}", b"payload %d " % i * 100, None, False, "2024-01-01T00:00:00Z") for i in range(3)]


def read(data, size):
    return [warc.read_record(m, True) for m in warc.members(iter([data[i : i + size] for i in range(0, len(data), size)]))]


@pytest.mark.parametrize("size", [1, 7, 100, 10**6])
def test_chunks_of_any_size(size):
    out = read(b"".join(archive()), size)
    assert [r["page_id"] for r in out] == [0, 1, 2] and all(r["verified"] for r in out)
    assert out[1]["payload"] == b"payload 1 " * 100


def test_members_are_plain_gzip():
    whole = gzip.decompress(b"".join(archive()))
    assert whole.count(b"WARC/1.1\r\n") == 3 and whole.endswith(b"\r\n\r\n")


def test_damage_is_found():
    parts = archive()
    with pytest.raises(warc.Damaged):
        read(b"".join(parts)[:-20], 50)
    plain = bytearray(zlib.decompress(parts[0], 31))
    plain[-30] ^= 1
    changed = zlib.compressobj(6, zlib.DEFLATED, 31)
    assert not read(changed.compress(bytes(plain)) + changed.flush(), 64)[0]["verified"]
    longer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(warc.Damaged):
        read(longer.compress(bytes(plain) + b"more") + longer.flush(), 64)


def test_a_cut_archive_stops_the_job(spark):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(pages(spark, [(i, "u", f"{i}" * 3000) for i in range(5)]), folder)
    path = manifest.first().path
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[: len(data) // 2])
    with pytest.raises(Exception, match="cut short"):
        warc.read_archives(manifest, folder).collect()


def test_a_record_that_is_missing_is_noticed(spark):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(pages(spark, [(1, "u", "a")]), folder)
    with pytest.raises(Exception, match="1 records of 2"):
        warc.read_archives(manifest.selectExpr("path", "records + 1 AS records", "bytes"), folder).collect()


@pytest.mark.parametrize(
    ("uri", "told"),
    [
        ("s3a://bucket/a b", "s3://bucket/a b"),
        ("s3n://bucket/x", "s3://bucket/x"),
        ("s3://bucket/x", "s3://bucket/x"),
        ("gs://bucket/x", "gs://bucket/x"),
        ("hdfs://name:8020/x", "hdfs://name:8020/x"),
        ("viewfs://cluster/x", "viewfs://cluster/x"),
        ("file:/tmp/x", "file:///tmp/x"),
        ("file:///tmp/x", "file:///tmp/x"),
        ("/tmp/x", "file:///tmp/x"),
    ],
)
def test_stores_by_the_names_that_hadoop_gives_them(uri, told):
    assert warc.arrow_uri(uri) == told


def test_a_url_of_any_length(spark):
    url = "http://a.example/" + "x" * 1_200_000
    _, _, out = written_and_read(spark, [(1, url, "body"), (2, "u", "y" * 2000), (3, url + "z", "y" * 2000)])
    assert {r.page_id: r.url for r in out} == {1: url, 2: "u", 3: url + "z"} and all(r.verified for r in out)
