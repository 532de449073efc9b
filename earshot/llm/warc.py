"""WARC archives: a writer on Spark's text sink and a salvage reader.

Every record is a gzip member of its own, so damage costs the record that it
hits. The members go through Spark's text sink as rows of raw bytes, on any
store and with task commits that survive a lost executor; the sink's line
separator is an empty gzip member, which unpacks to nothing. A task opens the
next archive once the present one holds ``ARCHIVE_BYTES``.

The reader checks every record; where a check fails it searches for the next
valid gzip member or version line, in packed and plain archives alike, recovers
what follows and logs the byte gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import materialize, shared_path, table

CRLF = "\r\n"
END = b"\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 1_000
#: Packed bytes after which a task opens its next archive; an archive exceeds it by one record at most.
ARCHIVE_BYTES = 32 << 20
#: The reader hands on rows once their payloads reach this size.
_BATCH_BYTES, _BATCH_ROWS = 16 << 20, 2_000
_VERSION = re.compile(rb"WARC/\d\.\d\d?\r\n")
_VERSION_AT_END = re.compile(rb"WARC/\d\.\d\d?\Z")
_GZIP = b"\x1f\x8b\x08"
_RECORD_ID = "<urn:x-page:"


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` plus __payload, __bytes, __sha1, __refers_to.

    Payloads are equal when length, SHA-1 and a second hash agree. Counting is
    combined on the map side; only repeated digests are written and joined back.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    own = (
        pages.withColumn("__payload", payload)
        .withColumn("__bytes", F.octet_length("__payload").cast("long"))
        .withColumn("__sha1", F.sha1("__payload"))
        .withColumn("__hash", F.xxhash64("__payload"))
    )
    groups = (
        own.where(F.col("__bytes") >= min_bytes)
        .groupBy("__sha1", "__bytes", "__hash")
        .agg(F.max(id_col).alias("__keeper"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    groups = materialize(groups, "payload-groups")
    refers = F.when(~F.col(id_col).eqNullSafe(F.col("__keeper")), F.col("__keeper"))
    return own.join(groups, ["__sha1", "__bytes", "__hash"], "left").withColumn("__refers_to", refers)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(_RECORD_ID), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record_text(id_col: str, url_col: str) -> Column:
    """A record without its final line breaks, from the columns of ``with_revisits``."""
    revisit = F.col("__refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("__bytes").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("__payload")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col(id_col))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.translate(F.col(url_col), "\r\n", "")),
        line("WARC-Refers-To", F.when(revisit, _record_id(F.col("__refers_to")))),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__sha1"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


def _member(data: bytes) -> bytes:
    """``data`` as one gzip member; equal bytes give equal members."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _packed(archive_bytes: int):
    """Rows of raw record bytes -> (archive, member); archives are numbered within the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, filled = 0, 0
        for batch in batches:
            members, archives = [_member(record + END) for record in batch["value"]], []
            for member in members:
                if filled >= archive_bytes:
                    archive, filled = archive + 1, 0
                filled += len(member)
                archives.append(archive)
            yield pd.DataFrame({"archive": archives, "value": members})

    return run


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Writes one record per row, a gzip member each, as archives below ``path``.

    A null html is an empty payload, a null url has no target line, a null id an
    empty record name. Rows that share id and payload are all responses. Other
    columns are not read, whatever their names; no rows write no archive.
    """
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    records = with_revisits(slim, min_bytes=min_bytes).select(record_text("page_id", "url").cast("binary").alias("value"))
    members = records.mapInPandas(_packed(archive_bytes), "archive int, value binary")
    raw = members.select("archive", F.col("value").cast("string"))
    raw.write.partitionBy("archive").option("encoding", "ISO-8859-1").option("lineSep", _member(b"").decode("latin-1")).text(path)


def _sha1(digest: str) -> bytes | None:
    """The bytes of a labelled SHA-1 in hex or base32; None for anything else."""
    label, _, value = digest.partition(":")
    if label.lower() != "sha1":
        return None
    try:
        return bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value, casefold=True)
    except ValueError:
        return None


def _valid(data: bytes, at: int) -> tuple[dict, int, int] | None:
    """(headers, start and end of the block) of a sound record at ``at``."""
    if not _VERSION.match(data, at):
        return None
    head = data.find(END, at)
    if head < 0:
        return None
    headers = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size, start = headers.get("content-length", ""), head + 4
    if not size.isdigit() or not data.startswith(END, start + int(size)):
        return None
    digest = headers.get("warc-block-digest", "")
    if digest[:5].lower() == "sha1:" and hashlib.sha1(data[start : start + int(size)]).digest() != _sha1(digest):
        return None
    return headers, start, start + int(size)


def _head_start(data: bytes, mark: int, head: int) -> int | None:
    """The first version line from ``mark`` on whose head ends at ``head``: every line between has a colon."""
    start, end = None, head
    while end >= mark:
        at = data.rfind(b"\r\n", mark, end)
        line = data[mark if at < 0 else at + 2 : end]
        if found := _VERSION_AT_END.search(line):
            start = end - len(line) + found.start()
        if b":" not in line or at < 0:
            break
        end = at
    return start


def _next_record(data: bytes, at: int) -> int | None:
    """Where the next sound record from ``at`` on begins. A head holds no blank
    line, so each stretch between two of them is read once and checked once."""
    while mark := _VERSION.search(data, at):
        head = data.find(END, mark.start())
        if head < 0:
            return None
        start = _head_start(data, mark.start(), head)
        if start is not None and _valid(data, start):
            return start
        at = head
    return None


def records(data: bytes) -> Iterator[tuple]:
    """("record", from, to, headers, block) and ("gap", from, to, None, None) of plain WARC bytes."""
    at = 0
    while at < len(data):
        if found := _valid(data, at):
            headers, start, end = found
            yield "record", at, end + 4, headers, data[start:end]
            at = end + 4
            continue
        begin, nxt = at, _next_record(data, at + 1)
        at = len(data) if nxt is None else nxt
        yield "gap", begin, at, None, None


def _unpack(raw: bytes, at: int) -> tuple[int, bytes, bool]:
    """(end, bytes unpacked, sound) of the gzip member at ``at``; of a damaged one all
    bytes before the error. Its end is where the error was found or the archive ends."""
    unpack, parts, to, step = zlib.decompressobj(31), [], at, 65_536
    while to < len(raw) and not unpack.eof:
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(raw[to : to + step]))
        except zlib.error:
            if step == 1:
                return to, b"".join(parts), False
            unpack, step = before, max(1, step // 16)
            continue
        to = min(len(raw), to + step)
    return to - len(unpack.unused_data), b"".join(parts), unpack.eof


class _Starts:
    """Where sound things begin in an archive. What was found ahead is kept, so a search that is taken up again doesn't read the same bytes twice."""

    def __init__(self, raw: bytes):
        self.raw, self.view = raw, memoryview(raw)
        self.plain, self.member = (-1, -1), (-1, -1)  # searched from, found at

    def opens_member(self, at: int) -> bool:
        """Whether a gzip member that unpacks to a version line begins at ``at``."""
        try:
            return bool(_VERSION.match(zlib.decompressobj(31).decompress(self.view[at : at + 4_096], 11)))
        except zlib.error:
            return False

    def next_plain(self, at: int) -> int:
        if not self.plain[0] <= at <= self.plain[1]:
            found = _next_record(self.raw, at)
            self.plain = at, len(self.raw) if found is None else found
        return self.plain[1]

    def next_member(self, at: int) -> int:
        if not self.member[0] <= at <= self.member[1]:
            found = self.raw.find(_GZIP, at)
            while found >= 0 and not self.opens_member(found):
                found = self.raw.find(_GZIP, found + 1)
            self.member = at, len(self.raw) if found < 0 else found
        return self.member[1]

    def next(self, at: int, known: frozenset = frozenset()) -> int:
        """The first gzip member or sound plain record from ``at`` on, but for plain records with a digest in ``known``."""
        plain = self.next_plain(at)
        while plain < len(self.raw) and known:
            end = _valid(self.raw, plain)[2]
            if hashlib.sha1(self.view[plain:end]).digest() not in known:
                break
            plain = self.next_plain(end)
        return min(plain, self.next_member(at))

    def plain_end(self, at: int) -> int:
        """Where plain records from ``at`` on give way to a gzip member, or the end. Members in the blocks of sound records don't count."""
        while at < len(self.raw) and not (self.raw.startswith(_GZIP, at) and self.opens_member(at)):
            found = _valid(self.raw, at)
            at = found[2] + 4 if found else self.next(at + 1)
        return at


def members(raw: bytes) -> Iterator[tuple[int, int, bytes, bool]]:
    """(from, to, bytes unpacked, sound) of each gzip member; plain bytes up to the next member are one."""
    at, starts = 0, _Starts(raw)
    while at < len(raw):
        if raw.startswith(_GZIP, at):
            end, data, sound = _unpack(raw, at)
            if not sound:
                # stored blocks show the records that were unpacked already
                known = frozenset(hashlib.sha1(data[r[1] : r[2] - 4]).digest() for r in records(data) if r[0] == "record")
                end = starts.next(at + 1, known)
        else:
            end, sound = starts.plain_end(at), True
            data = raw[at:end]
        yield at, end, data, sound
        at = end


RECORD_SCHEMA = (
    "archive string, kind string, member_from long, member_to long, record_from long, record_to long, record_type string, "
    "record_id string, url string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)


def _record_row(archive: str, member: tuple, item: tuple, payload: bool) -> tuple:
    kind, start, end, headers, block = item
    where = (archive, kind, member[0], member[1], start, end)
    if kind == "gap":
        return (*where, *[None] * 7)
    head, _, body = block.partition(END)
    if not block.startswith(b"HTTP/"):
        head, body = b"", block
    size, digest = len(body), hashlib.sha1(body).hexdigest()
    if headers.get("warc-type") == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size = int(told[1]) if told else None
        told = headers.get("warc-payload-digest", "")
        digest = known.hex() if (known := _sha1(told)) else told.removeprefix("sha1:").lower() or None
    names = (headers.get(k) for k in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to"))
    return (*where, *names, size, digest, body if payload else None)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record (kind ``record``) and every quarantined byte range (kind
    ``gap``) of the archives below ``path``; offsets of records count unpacked
    bytes of their member, offsets of members count bytes of the archive.

    An archive is one row of Spark's binaryFile source: a task holds it packed,
    and one of its members unpacked. ``write_warc`` bounds both (``ARCHIVE_BYTES``
    and a record); archives of over 2 GB from elsewhere have to be split first.
    Empty archives, and a folder without archives, give no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for archive, raw in zip(batch["path"], batch["content"], strict=True):
                rows: list[tuple] = []
                held = 0
                for member in members(raw):
                    if not member[3]:
                        rows.append((archive, "gap", member[0], member[1], None, None, *[None] * 7))
                    for item in records(member[2]):
                        rows.append(_record_row(archive, member, item, payload))
                        held += len(item[4] or b"") if payload else 0
                        if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, RECORD_SCHEMA)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    found = read_warc(spark, path, payload=False).where("kind = 'record'")
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
m AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
             max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
