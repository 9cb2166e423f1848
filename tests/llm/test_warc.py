import gzip
import hashlib
import io
import json
import os
import zlib

import pytest

from strata.llm.oracles import ORACLES
from strata.llm.queries import op12_warc
from strata.llm.warc import (
    RECORDS, normalise, page_of, read_records, records_as_members, with_first_copies, write_archives,
)
from tests.oracle import differences, duck

DATE = "2020-02-02T00:00:00Z"
PAGES = "page_id long, url string, html string, digest string, payload int, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES)


def archived(spark, rows, folder, **more):
    archives = write_archives(with_first_copies(frame(spark, rows)), f"{folder}/whole", DATE, **more)
    index = normalise(archives, f"{folder}/members")
    return archives, index, read_records(index, 5)


def test_query_equals_oracle(spark, sf_dir):
    assert differences(op12_warc, ORACLES["op12_warc"], spark, duck(sf_dir), sf_dir) == []


def test_round_trip_of_odd_pages(spark, tmp_path):
    big, other = "<p>é" + "copy " * 50, "x" * 99
    rows = [
        (5, "http://a/5", big), (2, "http://a/2", big), (9, None, big), (None, "http://a/none", big), (2, "http://b", big),
        (3, "http://a/\r\nX-Evil: 1 ü", None), (4, "", ""), (6, "u", other), (7, "u", other), (None, None, None),
        (8, "u", "日本" * 400_000), (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9),
        (None, "u", "only without ids " * 20), (None, "v", "only without ids " * 20), (-1, "u", "\x00\x01" * 60),
    ]
    _, index, records = archived(spark, rows, tmp_path, archive_bytes=3_000)
    assert index.where("type = 'warcinfo'").count() > 1
    assert records.schema == RECORDS
    got = [tuple(r) for r in records.collect()]
    assert len(got) == len(rows)
    firsts = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = firsts.get(html)
        first = None if first == page else first
        want.append((page, "revisit" if first is not None else "response", first, len(body),
                     hashlib.sha256(body).hexdigest(), None if first is not None else body))
    assert sorted(((g[0], *g[2:4], g[4], g[5], g[6] and bytes(g[6]) if g[2] == "revisit" else bytes(g[6])) for g in got),
                  key=repr) == sorted(want, key=repr)
    assert {g[1] for g in got if g[0] == 3} == {"http://a/%0D%0AX-Evil:%201%20%C3%BC"}


def test_members_are_the_same_records_and_stand_alone(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i % 40} " * (i % 300)) for i in range(500)]
    archives, index, _ = archived(spark, rows, tmp_path)
    whole = [gzip.open(r["archive"]).read() for r in archives.collect()]
    by_file = {}
    for r in index.orderBy("archive", "offset").collect():
        by_file.setdefault(r["archive"], []).append(r)
    again = []
    for path, entries in by_file.items():
        data = open(path, "rb").read()
        at, text = 0, b""
        for e in entries:
            assert e["offset"] == at
            member = zlib.decompressobj(31)
            text += member.decompress(data[at : at + e["length"]])
            assert member.eof and not member.unused_data
            at += e["length"]
        assert at == len(data)
        again.append(text)
        lines = [json.loads(x) for x in open(f"{path}.idx")]
        assert [x["offset"] for x in lines] == [e["offset"] for e in entries]
    assert sorted(whole) == sorted(again)
    left = [f for _, _, names in os.walk(tmp_path / "members") for f in names]
    assert all(f.endswith((".gz", ".idx", ".crc")) for f in left)


def test_normalising_again_replaces_equal_files(spark, tmp_path):
    archives, index, _ = archived(spark, [(1, "u", "a" * 200), (2, "u", "a" * 200)], tmp_path)
    before = sorted(tuple(r) for r in index.collect())
    assert sorted(tuple(r) for r in normalise(archives, f"{tmp_path}/members").collect()) == before


def members(data):
    out = io.BytesIO()
    entries = list(records_as_members(io.BytesIO(data), out))
    return entries, out.getvalue()


def test_foreign_archives():
    record = (
        b"WARC/1.0\r\nWARC-Type: resource\r\nwarc-target-uri: http://x/\r\n  folded\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    )
    entries, data = members(gzip.compress(record) + gzip.compress(record + record))
    assert [e["type"] for e in entries] == ["resource"] * 3
    assert entries[0]["uri"] == "http://x/ folded"
    assert gzip.decompress(data) == record * 3
    assert members(gzip.compress(b"")) == ([], b"")
    for broken in (gzip.compress(record)[:-20], gzip.compress(record[:-7]), gzip.compress(b"nonsense\r\n"), b"plain text",
                   gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\n\r\n")):
        with pytest.raises((ValueError, EOFError, OSError)):
            members(broken)


def test_damage_names_the_archive(spark, tmp_path):
    path = str(tmp_path / "bad.warc.gz")
    with open(path, "wb") as f:
        f.write(gzip.compress(b"WARC/1.0\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(Exception, match="bad.warc.gz"):
        normalise(spark.createDataFrame([(path,)], "archive string"), f"{tmp_path}/members").collect()


def test_empty_table(spark, tmp_path):
    archives, index, records = archived(spark, [], tmp_path)
    assert archives.count() == index.count() == records.count() == 0


def test_ids():
    assert page_of("<urn:page:-12:ab>") == -12 and page_of("<urn:page:none:ab>") is None and page_of(None) is None
