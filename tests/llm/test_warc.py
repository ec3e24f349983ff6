from __future__ import annotations

import base64
import gzip
import hashlib
import os

import pytest

from clickloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first long, offset int"
PAGES = [
    (5, "http://a/1", "<p>one</p>", "x", 0, 1), (3, "http://a/ 2\r\nX: y", "<p>one</p>", "x", 0, 1),
    (9, None, None, "x", 0, 1), (8, "http://a/3", "", "x", 0, 1), (1, "http://é/", "é\r\n\r\nWARC/1.1", "x", 0, 1),
    (None, "http://n", "<p>one</p>", "x", 0, 1), (None, "http://m", "alone", "x", 0, 1),
    (2, "u", "again", "x", 0, 1), (2, "u", "again", "x", 0, 1), (7, "v", "x" * 300_000, "x", 0, 1),
    (4, "w", "x" * 300_000, "x", 0, 1), (6, "q", "<b>\x00</b>", "x", 0, 1),
]


def plain(pages, at_least=0):
    least = {}
    for i, _, html, *_ in pages:
        if i is not None and len((html or "").encode()) >= at_least:
            least[html or ""] = min(least.get(html or "", i), i)
    out = []
    for i, _, html, *_ in pages:
        raw = (html or "").encode()
        first = least.get(html or "") if len(raw) >= at_least else None
        again = first is not None and first != i
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((str(i), len(raw), sha, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA).repartition(3).cache()


def got(frame):
    names = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(((str(r["page_id"]), *(r[n] for n in names)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("groups", [0, 10_000])
def test_round_trip(pages, monkeypatch, groups):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", groups)
    assert got(warc.digests(pages)) == plain(PAGES)


def test_payloads_urls_and_least_size(pages, tmp_path):
    found = warc.archive_pages(pages, str(tmp_path / "w"), at_least=8).collect()
    assert sorted((str(r["page_id"]), r["record_type"]) for r in found) == sorted(
        (p[0], p[3]) for p in plain(PAGES, 8)
    )
    html = {(p[0], p[1]): (p[2] or "").encode() for p in PAGES}
    for r in found:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]) in {h for (i, _), h in html.items() if i == r["page_id"]}
    assert {r["url"] for r in found if r["page_id"] == 3} == {"http://a/%202%0D%0AX:%20y"}


def test_archives_are_gzip_members_in_index_order(pages, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(warc.with_first(pages), folder, most=200).collect()
    assert len({r["archive"] for r in index}) > 3
    for name in {r["archive"] for r in index}:
        with open(os.path.join(folder, name), "rb") as file:
            raw = file.read()
        at = 0
        for r in sorted((r for r in index if r["archive"] == name), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == len(raw) and gzip.decompress(raw).count(b"WARC-Type: ") >= 1


def test_selected_records_only(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(warc.with_first(pages), folder)
    some = warc.read_records(index.filter("page_id = 1 OR page_id = 6"), folder)
    assert sorted(r["page_id"] for r in some.collect()) == [1, 6]


def test_joined_ranges(monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    ranges = [(0, 5), (5, 5), (20, 5), (36, 5), (41, 80), (300, 5)]
    assert warc.joined_ranges(ranges) == [(0, 25, 3), (36, 121, 2), (300, 305, 1)]


def test_wrong_digest_and_empty_table(spark, pages):
    record = warc.make_record(1, "u", b"abc", warc.digest_of(b"abd"), None)
    with pytest.raises(ValueError):
        warc.parse_record(record)
    assert warc.digests(pages.limit(0)).count() == 0
