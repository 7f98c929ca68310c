"""Legacy web archives (ARC) to WARC, and both formats as files in the shared folder.

ARC is a version block and then records of one header line and a block of declared length;
version 1 has five fields in that line, version 2 has ten. Lines and lengths are read by the
version each file declares, from the end of a line, so that a blank in an address harms nothing. The
converter keeps the bytes of every block and makes what WARC asks for beyond them: an
identifier (from the file and the place in it, so each record has its own), a timestamp,
a type, the address in ASCII and digests. A block that begins as an HTTP answer is a
``response`` with its own status and header; anything else (a name look-up, a plain
file, nothing at all) is a ``resource`` of the declared type; the version block becomes
``warcinfo``. Of responses with equal payloads one is written whole; the others are
``revisit`` records that name it and hold only their own HTTP header.

Spark's writer of text files writes the archives with gzip and its reader of whole files reads
them. A file is closed at ``FILE_BYTES``, by the bytes in it. Places and digests are
shuffled to find equal payloads; the files themselves meet what was decided on their records.

A null html is an empty payload. A null url is ``-``. Rows with the same id, or the
same in all, are records of their own; of equal payloads with the smallest id one is the
response. Rows with a null ``page_id`` are archived and read back with a null id, after
all others where payloads are equal. A date that cannot be read is that of the version block.
An empty table gives no archives and an empty table. Columns of ``pages`` other than
``page_id, url, html`` are not archived.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm.common import written
from tableforge.workspace import new_folder

MIN_REVISIT_BYTES = 0
#: A file is closed once it has so many bytes before compression.
FILE_BYTES = 32 << 20
ARCHIVED_AT = "20240101000000"
NO_URL = "-"
NO_ADDRESS = ("-", "0.0.0.0")
GZIP_MARK = b"\x1f\x8b"
HTTP_MARK = b"HTTP/"

#: Fields of the header line of an ARC record, by version (fixed values of the format).
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
ARC_RECORD = (
    "page_id long, url string, ip string, date string, mime string, record_type string, "
    "header binary, payload binary, record_id string"
)
WARC_RECORD = (
    "page_id long, record_id string, record_type string, target_uri string, ip string, date string, "
    "content_type string, payload_digest string, payload_bytes long, refers_to_id string, "
    "header binary, payload binary"
)
PAGE_HEADER = "X-Page-Id"
#: Field of a revisit record with the number of bytes it does not repeat.
LENGTH_FIELD = "X-Payload-Length"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_header(status: str, page_id: int | None, mime: str, length: int) -> bytes:
    page = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    return f"HTTP/1.1 {status}\r\n{page}Content-Type: {mime}\r\nContent-Length: {length}\r\n\r\n".encode()


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header of an HTTP answer with the empty line that ends it, and its body."""
    at = block.find(b"\r\n\r\n")
    end = len(block) if at < 0 else at + 4
    at = block.find(b"\n\n", 0, end)
    end = end if at < 0 else at + 2
    return block[:end], block[end:]


def fields_of(lines: bytes) -> dict[str, str]:
    """Fields of a header by name in lower case; a name given twice has its first value."""
    found: dict[str, str] = {}
    for line in lines.decode("utf-8", "replace").split("\n"):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def page_of(header: bytes) -> int | None:
    if PAGE_HEADER.encode() not in header:
        return None
    value = fields_of(header)[PAGE_HEADER.lower()]
    return int(value) if value.lstrip("-").isdigit() else None


@dataclass(frozen=True)
class ArcRecord:
    """A record as it stands in its file. ``opening`` marks the version block."""

    fields: dict[str, str]
    block: bytes
    offset: int
    opening: bool = False

    def parts(self) -> tuple[str, bytes, bytes]:
        """WARC type, HTTP header and payload."""
        if self.opening:
            return "warcinfo", b"", self.block
        if self.block.startswith(HTTP_MARK):
            return "response", *split_http(self.block)
        return "resource", b"", self.block


def arc_version_block(version: int) -> bytes:
    """The record that opens an ARC file and says how the others are to be read."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length"}
    names[2] = (
        "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
        "Filename Archive-length"
    )
    body = f"{version} 0 archive\n{names[version]}\n".encode()
    fields = {"url": "filedesc://pages.arc", "ip": "0.0.0.0", "date": ARCHIVED_AT, "type": "text/plain"}
    # The opening line has the five fields of version 1 whatever the version of the others.
    return arc_line(1, fields, len(body)) + body


def arc_line(version: int, fields: dict[str, str], length: int) -> bytes:
    values = {"result": "200", "filename": "pages.arc", "offset": "0", **fields, "length": str(length)}
    line = " ".join((values.get(name) or "-").replace(" ", "%20") for name in ARC_FIELDS[version])
    return line.replace("\n", "%0A").replace("\r", "%0D").encode() + b"\n"


def _arc_fields(line: bytes, names: tuple[str, ...]) -> dict[str, str]:
    values = line.rstrip(b"\r").rsplit(b" ", len(names) - 1)
    if len(values) != len(names) or not values[-1].isdigit():
        raise ValueError(f"not a header line of {len(names)} fields: {line[:200]!r}")
    url = urllib.parse.quote_from_bytes(values[0], safe="".join(map(chr, range(33, 127))))
    return dict(zip(names, [url, *(value.decode("latin-1") for value in values[1:])], strict=True))


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, by declared lengths, the version block first."""
    at, names = 0, None
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        line = content[at:end]
        if names is None:
            # Archives of version 2 open with a line of either form.
            found = ARC_FIELDS[2] if len(line.split(b" ")) >= len(ARC_FIELDS[2]) else ARC_FIELDS[1]
        else:
            found = names
        fields = _arc_fields(line, found)
        block = content[end + 1 : end + 1 + int(fields["length"])]
        if len(block) != int(fields["length"]):
            raise ValueError(f"record of {fields['length']} bytes ends after {len(block)}")
        if names is None:
            version = block.split(b" ", 1)[0]
            if not version.isdigit() or int(version) not in ARC_FIELDS:
                raise ValueError(f"ARC version {version[:20].decode('latin-1')} is not known")
            names = ARC_FIELDS[int(version)]
            yield ArcRecord(fields, block, at, True)
        else:
            yield ArcRecord(fields, block, at)
        at = end + 1 + len(block)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower case) and block of each record of a WARC file."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or content[at : at + 5] != b"WARC/":
            raise ValueError("not at the start of a WARC record")
        fields = fields_of(content[at:end])
        length = int(fields["content-length"])
        block = content[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError(f"record of {length} bytes ends after {len(block)}")
        yield fields, block
        at = end + 4 + length


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def _content(file: pa.Scalar) -> bytes:
    content = file.as_py()
    return gzip.decompress(content) if content[:2] == GZIP_MARK else content


class _Pack:
    """Records put together to contents of files of ``FILE_BYTES``."""

    def __init__(self, separator: bytes, opening: bytes | None = None):
        self.separator = separator
        self.opening = [opening] if opening else []
        self.records, self.size = [*self.opening], 0

    def add(self, record: bytes) -> Iterator[pa.RecordBatch]:
        self.records.append(record)
        self.size += len(record)
        if self.size >= FILE_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            content = self.separator.join(self.records)
            self.records, self.size = [*self.opening], 0
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])


def _write(contents: DataFrame, folder: str, separator: str) -> None:
    """A file for each row. A cast of bytes to text does not change them."""
    options = {
        "lineSep": separator, "compression": "gzip", "zlib.compress.level": "TWO", "maxRecordsPerFile": 1,
    }
    contents.select(F.col("content").cast("string")).write.options(**options).text(folder)


def write_arc(pages: DataFrame, folder: str, version: int = 1) -> None:
    """``pages`` as ARC files: an HTTP response for each row."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))

    def contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack(b"\n", arc_version_block(version))
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for page_id, url, value in zip(ids, urls, batch.column(2).cast(pa.binary()), strict=True):
                payload = value.as_py()
                block = http_header("200 OK", page_id, "text/html", len(payload)) + payload
                fields = {"url": url or NO_URL, "ip": "0.0.0.0", "date": ARCHIVED_AT, "type": "text/html"}
                yield from pack.add(arc_line(version, fields, len(block)) + block)
        yield from pack.rest()

    _write(rows.mapInArrow(contents, "content binary"), folder, "\n")


def record_id(path: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>"


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of ARC files, without the version blocks."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = []
                for record in parse_arc(_content(file)):
                    kind, header, payload = record.parts()
                    if not record.opening:
                        f = record.fields
                        found.append(
                            (page_of(header), f["url"], f["ip"], f["date"], f["type"], kind, header, payload)
                            + (record_id(path, record.offset),)
                        )
                yield _batch(found, ARC_RECORD)

    return _files(spark, folder).mapInArrow(rows, ARC_RECORD)


KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, KINDS[kind]) for column, kind in zip(columns, kinds, strict=True)], list(names)
    )


def warc_date(arc_date: str, other: str = ARCHIVED_AT) -> str:
    """The date as WARC writes it; ``other`` where it is none."""
    for date in (arc_date, other):
        for form, digits in (("%Y%m%d%H%M%S", 14), ("%Y%m%d%H%M", 12), ("%Y%m%d", 8)):
            if len(date) < digits or not date.isdigit():
                continue
            try:
                return datetime.datetime.strptime(date[:digits], form).strftime("%Y-%m-%dT%H:%M:%SZ")
            except ValueError:  # no such day or hour
                continue
    return "1970-01-01T00:00:00Z"


RESPONSES = "path string, offset long, page_id long, digest string, record_id string"


def _responses(min_bytes: int):
    def responses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = []
                for record in parse_arc(_content(file)):
                    kind, header, payload = record.parts()
                    if kind == "response" and len(payload) >= min_bytes:
                        own = record_id(path, record.offset)
                        found.append((path, record.offset, page_of(header), base32_sha1(payload), own))
                yield _batch(found, RESPONSES)

    return responses


def convert_arc(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write the records of ``arc_folder`` as WARC files."""
    files = _files(spark, arc_folder)
    read = written(files.mapInArrow(_responses(min_bytes), RESPONSES), "responses")
    # The smallest page of each payload, a null id last, and its record.
    key = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id")
    firsts = read.groupBy("digest").agg(F.min(key).alias("first"), F.count("*").alias("number"))
    firsts = firsts.where("number > 1").select("digest", F.col("first.record_id").alias("first_id"))
    again = read.join(firsts, "digest").where("record_id <> first_id")
    # A list for each file, no longer than its records.
    again = again.groupBy("path").agg(F.collect_list(F.struct("offset", "first_id")).alias("revisits"))

    def contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack(b"\r\n\r\n")
        for batch in batches:
            paths, revisits = batch.column("path").to_pylist(), batch.column("revisits")
            for path, file, pairs in zip(paths, batch.column("content"), revisits, strict=True):
                first_of = {pair["offset"]: pair["first_id"] for pair in pairs.as_py() or ()}
                opening = None
                for record in parse_arc(_content(file)):
                    opening = opening or record
                    yield from pack.add(_warc_record(path, record, opening, first_of.get(record.offset)))
        yield from pack.rest()

    decided = files.join(again, "path", "left")
    _write(decided.mapInArrow(contents, "content binary"), warc_folder, "\r\n\r\n")


def _warc_record(path: str, record: ArcRecord, opening: ArcRecord, first_id: str | None) -> bytes:
    kind, header, payload = record.parts()
    kind = "revisit" if first_id else kind
    date = warc_date(record.fields["date"], opening.fields["date"])
    fields = {"WARC-Type": kind, "WARC-Record-ID": record_id(path, record.offset), "WARC-Date": date}
    if kind == "warcinfo":
        fields["WARC-Filename"] = urllib.parse.quote(path.rsplit("/", 1)[-1])
        lines = [b"description: converted from ARC", b"arc-line: " + record.fields["url"].encode()]
        lines += [b"arc-version-block: " + line for line in payload.splitlines()]
        block, mime = b"".join(line + b"\r\n" for line in lines), "application/warc-fields"
    else:
        fields["WARC-Target-URI"] = record.fields["url"]
        if record.fields["ip"] not in NO_ADDRESS:
            fields["WARC-IP-Address"] = record.fields["ip"]
        fields["WARC-Warcinfo-ID"] = record_id(path, opening.offset)
        fields["WARC-Payload-Digest"] = f"sha1:{base32_sha1(payload)}"
        mime = record.fields["type"] if kind == "resource" else "application/http;msgtype=response"
        block = header if kind == "revisit" else header + payload
    if kind == "revisit":
        fields["WARC-Refers-To"] = first_id
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields[LENGTH_FIELD] = str(len(payload))
    fields["Content-Type"] = mime
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def _warc_row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    http = kind == "revisit" or kind == "response" and block.startswith(HTTP_MARK)
    header, payload = split_http(block) if http else (b"", block)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind != "revisit" and digest and base32_sha1(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    length = len(payload)
    if kind == "revisit":  # not known of archives that others wrote
        length = int(fields[LENGTH_FIELD.lower()]) if LENGTH_FIELD.lower() in fields else None
    return (
        page_of(header),
        fields["warc-record-id"],
        kind,
        fields.get("warc-target-uri"),
        fields.get("warc-ip-address"),
        fields["warc-date"],
        fields.get("content-type"),
        digest,
        length,
        fields.get("warc-refers-to"),
        header,
        None if kind == "revisit" else payload,
    )


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of WARC files; a payload is checked against its digest."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("content"):
                yield _batch([_warc_row(*record) for record in parse_warc(_content(file))], WARC_RECORD)

    return _files(spark, folder).mapInArrow(rows, WARC_RECORD)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    convert_arc(spark, arc, warc)
    read = read_warc(spark, warc).where("record_type in ('response', 'revisit')")
    read = written(read.drop("header", "payload", "target_uri", "ip", "date", "content_type"), "read-back")
    named = read.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # Responses refer to nothing; as nulls of a join they would meet in one task.
    revisits = read.where("record_type = 'revisit'").join(named, "refers_to_id", "left")
    responses = read.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(*columns).union(revisits.select(*columns))


def _base32(sha1: str) -> str:
    """SQL for the base32 form of 40 hex digits: four letters for each five digits."""
    number = f"('0x' || substr({sha1}, 5 * g + 1, 5))::INTEGER"
    letters = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({number} >> {shift}) & 31) + 1, 1)"
        for shift in (15, 10, 5, 0)
    )
    return f"list_aggregate([{letters} for g in range(8)], 'string_agg', '')"


ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), d AS (
  SELECT *, {_base32("hex")} AS payload_digest, min(page_id) OVER (PARTITION BY hex) AS first,
    row_number() OVER (PARTITION BY hex ORDER BY page_id NULLS LAST) = 1 AS is_first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN is_first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN NOT is_first THEN first END AS refers_to
FROM d
"""
