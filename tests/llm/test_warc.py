"""WARC archives: exact round trips, and broken archives are told."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from watchledger.llm import warc

PAGE = "page_id long, url string, html string"


def members(*payloads, level=6):
    return [
        warc.encode_record(i, f"http://a/{i}", p, None, False, level=level)
        for i, p in enumerate(payloads)
    ]


def test_each_record_is_a_member_of_its_own():
    for member in members(b"", b"x" * 100_000):
        text = gzip.decompress(member)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def test_reader_gives_back_payloads_of_any_size():
    payloads = [b"", b"\r\n\r\n", b"a" * 70_000, bytes(range(256)) * 3000, "é\0".encode()]
    archive = b"".join(members(*payloads))
    assert [r.payload for r in warc.read_records(io.BytesIO(archive))] == payloads


def test_reader_takes_small_reads():
    class Slow(io.BytesIO):
        def read(self, size=-1):
            return super().read(7)

    archive = b"".join(members(b"abc" * 500, b"", b"z"))
    assert [len(r.payload) for r in warc.read_records(Slow(archive))] == [1500, 0, 1]


@pytest.mark.parametrize("cut", [1, 9, 40])
def test_a_short_archive_is_broken(cut):
    archive = b"".join(members(b"abc", b"def" * 50))[:-cut]
    with pytest.raises(warc.Broken):
        list(warc.read_records(io.BytesIO(archive)))


@pytest.mark.parametrize(
    "old, new",
    [(b"abcdef", b"abcdeg"), (b"Content-Length: 6\r", b"Content-Length: 5\r"), (b"WARC/1.1", b"HTTP/1.1")],
)
def test_changed_records_are_broken(old, new):
    text = gzip.decompress(members(b"abcdef")[0])
    assert old in text
    with pytest.raises(warc.Broken):
        list(warc.read_records(io.BytesIO(gzip.compress(text.replace(old, new)))))


def test_field_values_hold_no_line_breaks():
    member = warc.encode_record(1, "http://a/\r\nWARC-Type: x", b"", None, False)
    (record,) = warc.read_records(io.BytesIO(member))
    assert record.fields["warc-type"] == "response"
    assert record.fields["warc-target-uri"] == "http://a/%0D%0AWARC-Type: x"


def round_trip(pages, scratch, **options):
    archives, folder = warc.archive_pages(pages, scratch, **options)
    return warc.read_archives(archives, folder)


def test_pages_come_back(spark, scratch):
    rows = [
        (3, "u3", "same"), (1, None, "same"), (2, "u2", None), (5, "u5", ""), (4, "u4", "own é"),
        (1, "again", "same"), (None, "n", "same"), (None, "m", "alone"), (None, "m", "alone"),
    ]
    got = round_trip(spark.createDataFrame(rows, PAGE), scratch).collect()
    assert len(got) == len(rows)
    kinds = sorted(
        ((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got), key=repr
    )
    assert kinds == sorted([
        ("3", 4, "revisit", 1), ("1", 4, "response", None), ("1", 4, "response", None),
        ("None", 4, "revisit", 1), ("2", 0, "response", None), ("5", 0, "revisit", 2),
        ("4", 6, "response", None), ("None", 5, "response", None), ("None", 5, "response", None),
    ], key=repr)
    assert {r.url for r in got} == {"u3", None, "u2", "u5", "u4", "again", "n", "m"}
    for r in got:
        if r.record_type == "response":
            assert r.payload_digest == warc.sha1_base32(bytes(r.payload))
    own = next(r for r in got if r.page_id == 4)
    assert bytes(own.payload) == "own é".encode()


def test_short_payloads_need_not_be_revisits(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGE)
    got = {r.page_id: r.record_type for r in round_trip(pages, scratch, revisit_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_archives_are_cut_by_size_and_all_read(spark, scratch):
    pages = spark.range(300).selectExpr("id as page_id", "'u' as url", "repeat(sha1(string(id)), 50) as html")
    folder = scratch.folder("warc")
    written = warc.write_archives(warc.assign_records(pages), folder, archive_bytes=2000)
    archives = scratch.stage(written, "archives")
    assert archives.count() > 8
    got = warc.read_archives(archives, folder)
    want = {i: hashlib.sha1(str(i).encode()).hexdigest() * 50 for i in range(300)}
    assert {r.page_id: bytes(r.payload).decode() for r in got.collect()} == want


def test_empty_table_and_clashing_columns(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "x")], PAGE)
    assert round_trip(pages.limit(0), scratch).collect() == []
    odd = pages.select("*", *[F.lit(9).alias(n) for n in ("payload", "digest", "first_id", "n")])
    assert [r.page_id for r in round_trip(odd, scratch).collect()] == [1]


def test_folders_by_scheme(tmp_path):
    store, path = warc.open_folder(f"file://{tmp_path}")
    assert store.type_name == "local" and path == str(tmp_path)
    with pytest.raises(ValueError, match="cannot be kept"):
        warc.open_folder("ftp://host/archives")
