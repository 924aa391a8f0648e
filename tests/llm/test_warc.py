import gzip
import hashlib
import random
from pathlib import Path
from urllib.parse import urlparse

import pytest

from aerolake.llm import warc
from aerolake.llm.common import tune

LONG = "<html>" + "pagé " * 30_000

ROWS = [
    (5, "http://a.example/5", "x" * 100),
    (3, "http://a.example/3", "x" * 100),
    (9, None, "x" * 100),
    (None, "http://a.example/none", "x" * 100),
    (1, "http://a.example/1", "short"),
    (2, "http://a.example/2", "short"),
    (4, "http://a.example/4", None),
    (6, "http://a.example/6", ""),
    (7, "http://a.example/ü\r\nX-Page-Id: 1", LONG),
    (8, "http://a.example/8", LONG),
    (10, "http://a.example/10", "é" * 50),
    (11, "http://a.example/11", "é" * 50),
    (12, "http://a.example/12", "é" * 49),
    (13, "http://a.example/13", "é" * 49),
    (14, "http://a.example/14", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9),
    (15, "http://a.example/15", "y" * 200),
    (15, "http://a.example/15", "y" * 200),
    (15, "http://a.example/15", "y" * 200),
    (16, "http://a.example/16", "y" * 200),
    (17, "http://b.example/17", "z" * 200),
    (17, "http://a.example/17", "z" * 200),
    (None, "http://a.example/q", "q" * 150),
    (None, "http://a.example/q", "q" * 150),
]


def pages(spark, rows):
    schema = "page_id long, url string, html string, digest string, payload string, record_id string"
    return tune(spark).createDataFrame([(*r, "d", "p", "i") for r in rows], schema).repartition(3)


def brute(rows):
    out, seen = [], {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for page, _, html in order:
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        if len(data) >= 100 and digest in seen:
            out.append((page, len(data), digest, "revisit", seen[digest]))
        else:
            seen[digest] = page
            out.append((page, len(data), digest, "response", None))
    return sorted(out, key=str)


def resolved(found):
    return sorted((tuple(r) for r in warc.resolve(found).collect()), key=str)


@pytest.fixture
def archive(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write(pages(spark, ROWS), path)
    return path


def files(path):
    return sorted(p for p in Path(urlparse(path).path).iterdir() if p.name.startswith("part"))


def test_archives_give_back_the_pages(spark, archive):
    found = warc.read(spark, archive)
    assert resolved(found) == brute(ROWS)
    assert found.where("kind = 'gap'").isEmpty()
    assert found.select("record_id").distinct().count() == len(ROWS)
    payloads = {r[0]: r[1] for r in found.where("record_type = 'response'").select("page_id", "payload").collect()}
    assert payloads[7].decode() == LONG
    assert found.where("page_id = 7").first()["target_uri"] == "http://a.example/%C3%BC%0D%0AX-Page-Id:%201"


def test_archive_files_are_plain_gzip(archive):
    for file in files(archive):
        content = gzip.decompress(file.read_bytes())
        assert not content or content.startswith(b"WARC/1.1\r\n") and content.endswith(b"\r\n\r\n")


def test_archives_are_closed_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    warc.write(pages(spark, ROWS), str(tmp_path / "small"))
    assert len(files(str(tmp_path / "small"))) >= len(ROWS)
    assert resolved(warc.read(spark, str(tmp_path / "small"))) == brute(ROWS)


def test_empty_table(spark, tmp_path):
    warc.write(pages(spark, []), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


# --- salvage -------------------------------------------------------------------------


def made(number, payload=None, extra=""):
    data = (payload or f"payload {number} " * 20).encode()
    digest = hashlib.sha256(data).hexdigest()
    head = (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:r:{number}>\r\nX-Page-Id: {number}\r\n"
        f"WARC-Block-Digest: sha256:{digest}\r\nContent-Length: {len(data)}\r\n{extra}\r\n"
    )
    return head.encode() + data + b"\r\n\r\n"


def ids(events):
    found = [e["fields"].get("x-page-id", "") for _, _, e in events if isinstance(e, dict)]
    return [int(i) if i.isdecimal() else -1 for i in found]


def gaps(events):
    return [(a, b) for a, b, e in events if isinstance(e, str)]


def check_cover(events, size):
    at = 0
    for a, b, _ in events:
        assert a == at
        at = b
    assert at == size


@pytest.mark.parametrize("packed", [True, False])
def test_every_damaged_byte_costs_one_record_at_most(packed):
    parts = [made(i) for i in range(4)]
    parts = [gzip.compress(p, mtime=0) for p in parts] if packed else parts
    data = b"".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(5)]
    for at in range(0, len(data), 3):
        bad = bytearray(data)
        bad[at] ^= 0x20
        events = list(warc.salvage(bytes(bad)))
        check_cover(events, len(data))
        hit = next(i for i in range(4) if starts[i] <= at < starts[i + 1])
        assert set(ids(events)) >= set(range(4)) - {hit}
        found = gaps(events)
        if found:
            assert (found[0][0], found[-1][1]) == (starts[hit], starts[hit + 1])
        else:  # only headers that no check covers may be hurt unseen
            assert len(events) == 4


def test_cut_off_inserted_and_removed_bytes():
    parts = [gzip.compress(made(i), mtime=0) for i in range(5)]
    data = b"".join(parts)
    events = list(warc.salvage(data[:-20]))
    assert ids(events) == [0, 1, 2, 3]
    assert gaps(events) == [(len(data) - len(parts[4]), len(data) - 20)]
    junk = random.Random(1).randbytes(5_000) + b"WARC/1.0\r\nnot a record" + b"\x1f\x8b\x08\x00"
    events = list(warc.salvage(junk + parts[0] + junk + parts[1] + b"\0\0\0" + parts[2][20:] + parts[3]))
    assert ids(events) == [0, 1, 3]
    # plain records between members are found by their version line
    events = list(warc.salvage(parts[0][:-9] + made(7) + parts[1]))
    assert ids(events) == [7, 1]


def test_a_record_inside_a_damaged_payload_is_not_taken_for_one():
    inner = made(66)
    outer = made(1, "before " * 20 + inner.decode() + " after")
    bad = outer.replace(b"before", b"bEfore", 1)
    events = list(warc.salvage(made(0) + bad + made(2)))
    assert ids(events) == [0, 2]
    assert [e for *_, e in events if isinstance(e, str)] == ["block digest"]
    # in a sound member with a broken record the others are kept
    events = list(warc.salvage(gzip.compress(made(0) + bad + made(2)) + gzip.compress(made(3))))
    assert ids(events) == [0, 2, 3]


def test_headers_of_other_writers():
    data = b"body"
    digest = hashlib.sha1(data).digest()
    import base64

    head = (
        "WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <a>\r\nWARC-Date: 2024\r\n  -01-01\r\n"
        "Content-Type: application/http;msgtype=response\r\n"
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}\r\nContent-Length: 23\r\n\r\n"
    )
    record = head.encode() + b"HTTP/1.1 200 OK\r\n\r\nbody" + b"\r\n\r\n"
    events = list(warc.salvage(record))
    assert events[0][2]["payload"] == data
    assert events[0][2]["fields"]["warc-date"] == "2024 -01-01"
    assert isinstance(list(warc.salvage(record.replace(b"body", b"bodi")))[0][2], str)


def test_lost_response_leaves_revisits_unresolved(spark, archive):
    where = warc.read(spark, archive).where("page_id = 3").select("archive", "start", "stop").first()
    file = Path(urlparse(where["archive"]).path)
    data = bytearray(file.read_bytes())
    data[where["start"] + 30] ^= 255
    file.write_bytes(bytes(data))
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    found = warc.read(spark, archive)
    gap = found.where("kind = 'gap'").select("start", "stop").collect()
    assert (gap[0]["start"], gap[-1]["stop"]) == (where["start"], where["stop"])
    lost = [r for r in brute(ROWS) if r[0] != 3 and r[4] != 3]
    left = [r for r in resolved(found) if r[1] is not None]
    assert left == lost
    assert sum(r[1] is None for r in resolved(found)) == 3
