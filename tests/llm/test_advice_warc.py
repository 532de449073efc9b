"""Salvage of damaged archives, through read_warc."""

import base64
import gzip
import hashlib
import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from earshot.llm import warc

DRAW = random.Random(3)


def record(n, payload, base32=False, kind="response"):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    name = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode() if base32 else hashlib.sha1(b).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x-page:{n}>\r\nWARC-Payload-Digest: sha1:{name(payload)}\r\nWARC-Block-Digest: sha1:{name(block)}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


RECORDS = [record(n, DRAW.randbytes(3_000)) for n in range(6)]


@pytest.fixture
def read(spark, tmp_path):
    def run(raw):
        (tmp_path / "a.warc").write_bytes(raw)
        rows = warc.read_warc(spark, f"file://{tmp_path}").collect()
        return sorted(r.record_id[12:-1] for r in rows if r.kind == "record"), [r for r in rows if r.kind == "gap"], rows

    return run


def test_plain_archive_with_damaged_first_bytes(read):
    names, gaps, _ = read(b"XXXX" + b"".join(RECORDS)[4:])
    assert names == list("12345") and [(r.member_from, r.record_from, r.record_to) for r in gaps] == [(0, 0, len(RECORDS[0]))]


def test_plain_archive_with_packed_payloads(read):
    packed = [record(n, gzip.compress(b"page %d" % n)) for n in range(4)]
    broken = bytearray(b"".join(packed))
    broken[len(packed[0]) + 2] ^= 255
    assert read(bytes(broken))[0] == list("023")


def test_plain_records_among_members(read):
    broken = bytearray(gzip.compress(record(1, b"x" * 3_000)))
    broken[0] ^= 255
    names, gaps, _ = read(RECORDS[0] + bytes(broken) + RECORDS[2] + gzip.compress(RECORDS[3]) + RECORDS[4])
    assert names == list("0234") and len(gaps) == 1


def test_base32_digests(read):
    names, gaps, rows = read(b"".join(record(n, b"page %d" % n, True, "revisit") for n in range(3)))
    assert names == list("012") and not gaps
    assert {r.payload_digest for r in rows} == {hashlib.sha1(b"page %d" % n).hexdigest() for n in range(3)}
    wrong = record(1, b"page 1", True).replace(b"page 1", b"page 2")
    assert read(wrong)[0] == []


@pytest.mark.parametrize("level", [0, 6])
def test_damaged_member_keeps_its_good_prefix_once(read, level):
    broken = bytearray(gzip.compress(b"".join(RECORDS), level))
    broken[-6] ^= 255  # the checksum
    names, gaps, _ = read(bytes(broken) + gzip.compress(record(7, b"x")))
    assert names == list("0123457") and len(gaps) == 1


def test_two_damaged_members_in_a_row(read):
    first, second = (bytearray(gzip.compress(b"".join(RECORDS[i : i + 3]))) for i in (0, 3))
    first[-6] ^= 255
    second[-6] ^= 255
    assert read(bytes(first + second))[0] == list("012345")


def recovered(raw):
    """Record names and gaps (archive offsets of damaged members, or of plain records)."""
    names, gaps = [], []
    for start, end, data, sound in warc.members(raw):
        gaps += [] if sound else [(start, end)]
        for kind, a, b, headers, _ in warc.records(data):
            if kind == "record":
                names.append(headers.get("warc-record-id"))  # no check covers the head of a plain record
            elif sound:
                gaps.append((start + a, start + b))
    return names, gaps


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """One archive of six records as ``write_warc`` lays it down, with where each member lies."""
    path = str(tmp_path_factory.mktemp("written") / "w")
    rows = [(n, f"http://h/{n}", "".join(DRAW.choice("abc <p>") for _ in range(90))) for n in range(6)]
    warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), f"file://{path}")
    raw = open(glob.glob(f"{path}/**/part-*", recursive=True)[0], "rb").read()
    return raw, [m for m in warc.members(raw) if m[2]]


def test_each_record_is_a_member(written):
    raw, members = written
    assert len(members) == 6 and all(m[3] for m in members) and recovered(raw)[1] == []
    assert gzip.decompress(raw) == b"".join(m[2] for m in members)


def test_any_damaged_byte_costs_its_packed_record_alone(written):
    raw, members = written
    names = recovered(raw)[0]
    for hit in (0, 2, 5):
        start, end = members[hit][:2]
        for at in range(start, end):
            bad = bytearray(raw)
            bad[at] ^= 0x55
            got, gaps = recovered(bytes(bad))
            # damage to the checksum leaves the record itself whole
            others = [n for n in names if n != names[hit]]
            assert [n for n in got if n in others] == others and len(got) == len(set(got)) <= 6
            if names[hit] not in got:
                assert gaps[0][0] == start and all(a <= b for a, b in gaps) and gaps[-1][1] <= (members[hit + 1][0] if hit < 5 else len(raw))


def test_any_damaged_byte_costs_its_plain_record_alone(written):
    plain = [m[2] for m in written[1]]
    names = [m[3]["warc-record-id"] for m in map(lambda p: next(warc.records(p)), plain)]
    starts = [sum(map(len, plain[:i])) for i in range(7)]
    for hit in (0, 2, 5):
        for at in range(starts[hit], starts[hit + 1]):
            bad = bytearray(b"".join(plain))
            bad[at] ^= 0x55
            got, gaps = recovered(bytes(bad))
            assert set(names) - set(got) <= {names[hit]} and len(got) <= 6, at
            assert len(got) == len(set(got)) and (len(got) == 6 or gaps == [(starts[hit], starts[hit + 1])]), at


def test_lost_and_doubled_pieces_between_members(written):
    raw, members = written
    names = recovered(raw)[0]
    cut = raw[: members[2][0] + 30] + raw[members[2][1] - 7 :]
    assert recovered(cut)[0] == names[:2] + names[3:]
    assert recovered(raw[:-25])[0] in (names, names[:5])
    assert recovered(raw[: members[1][1]] + b"\0" * 999 + members[3][2] + raw[members[3][1] :])[0] == names[:2] + names[3:]


@pytest.mark.parametrize("piece", [b"WARC/1.1\r\n", b"X: WARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\n", b"\r\n\r\n", b"\x1f\x8b\x08\0", b"\x1f\x8b\x08\0WARC/1.1\r\n"])
def test_hostile_bytes_are_read_once(piece):
    hostile = piece * (1_000_000 // len(piece))
    began = time.time()
    assert recovered(RECORDS[0] + hostile + RECORDS[1])[0][0] == "<urn:x-page:0>"
    assert time.time() - began < 3
    assert recovered(gzip.compress(RECORDS[0]) + hostile + gzip.compress(RECORDS[1]))[0] == ["<urn:x-page:0>", "<urn:x-page:1>"]
    assert time.time() - began < 6


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    draw = random.Random(8)
    rows = [(n, "u", "".join(draw.choices("abcdefgh", k=4_000))) for n in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    clash = df.coalesce(1).withColumns({c: F.lit("x") for c in ["__payload", "__bytes", "__sha1", "__hash", "__keeper", "__refers_to", "archive", "value"]})
    warc.write_warc(clash, f"file://{tmp_path}/w", archive_bytes=20_000)
    files = glob.glob(f"{tmp_path}/w/**/part-*", recursive=True)
    assert len(files) > 3 and all(len(open(f, "rb").read()) < 26_000 for f in files)
    back = warc.read_warc(spark, f"file://{tmp_path}/w").where("kind = 'record'").collect()
    assert {r.record_id: bytes(r.payload).decode() for r in back} == {f"<urn:x-page:{n}>": html for n, _, html in rows}


def test_empty_pages_repeated_rows_and_a_long_page(spark, tmp_path):
    long = "ż" * 3_000_000
    rows = [(1, "u", long), (2, "u", long), (3, "u", "x" * 2_000), (3, "u", "x" * 2_000), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_warc(df, f"file://{tmp_path}/w")
    got = sorted((r.record_id, r.record_type, r.payload_bytes) for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect())
    assert got == [("<urn:x-page:1>", "revisit", 6_000_000), ("<urn:x-page:2>", "response", 6_000_000), ("<urn:x-page:3>", "response", 2_000), ("<urn:x-page:3>", "response", 2_000), ("<urn:x-page:>", "response", 0)]
    warc.write_warc(df.limit(0), f"file://{tmp_path}/none")
    assert warc.read_warc(spark, f"file://{tmp_path}/none").count() == 0
