"""ARC archives to WARC: versioned ARC records in, equivalent WARC records with revisits out."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import new_path, query, staged, table

# The record definitions of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
SALTS = 8
RAW = "record binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_records(records: DataFrame, path: str) -> None:
    """Write byte records to gzip files, one a task. Each record must end with a line feed, which the sink adds."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of each file. Archives are files of bounded size, read one at a time."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


# --- ARC ------------------------------------------------------------------------------


def write_arc(pages: DataFrame, path: str, *, id_col: str, url_col: str, html_col: str, date: str, versions: tuple[int, ...] = (1, 2)) -> None:
    """Write pages as legacy archives: version block first, then one record a page; tasks take ``versions`` in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = versions[part % len(versions)]
        block = f"{version} 0 staylens\n{ARC_FIELDS[version]}\n".encode()
        middle = " 200 - - 0 -" if version == 2 else ""
        first = f"filedesc://part-{part:05d}.arc 0.0.0.0 {date} text/plain{middle} {len(block)}\n".encode() + block
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.binary())], ["record"])
        offset = len(first) + 1
        for batch in batches:
            records = []
            for key, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = (html or "").encode()
                http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Page-Id: {key}\r\n" if key is not None else "")
                body = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                name = "".join(f"%{ord(c):02X}" if c <= " " else c for c in (url or "urn:none"))
                extra = f" 200 {hashlib.md5(payload).hexdigest()} - {offset} part-{part:05d}.arc" if version == 2 else ""
                records.append(f"{name} 0.0.0.0 {date} text/html{extra} {len(body)}\n".encode() + body)
                offset += len(records[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    write_records(pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, RAW), path)


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of each record after the version block.

    The version block declares the version and the names of the header fields; every record is as
    long as its header line declares.
    """
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as file:
        names, count = None, 0
        while line := file.readline():
            if line == b"\n":
                continue
            words = line.decode().rstrip("\n").split(" ")
            if names is not None and len(words) != len(names):
                raise ValueError(f"record {count}: {len(words)} header fields where the archive declares {len(names)}")
            body = file.read(int(words[-1]))
            if len(body) != int(words[-1]):
                raise ValueError(f"record {count} ends before its declared length")
            if names is None:
                version, definition = body.decode().split("\n")[:2]
                names = definition.split(" ")
                if ARC_FIELDS.get(int(version.split(" ")[0])) != definition:
                    raise ValueError(f"unknown ARC version or record definition: {version}")
                continue
            yield dict(zip(names, words, strict=True)), body
            count += 1


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in fields}, payload


# --- WARC -----------------------------------------------------------------------------


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without its last line feed."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r"


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields with lower-case names, block) of each record, by declared lengths."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as file:
        while line := file.readline():
            if line != b"WARC/1.0\r\n":
                raise ValueError("a WARC record should begin here")
            fields = {}
            while (line := file.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                fields[name.lower()] = value.strip()
            block = file.read(int(fields["content-length"]))
            if file.read(4) != b"\r\n\r\n":
                raise ValueError("a WARC record ends before or after its declared length")
            yield fields, block


def record_id(url: str, date: str, digest: str, page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((url, date, digest, page)))}>"


def warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def find_revisits(arc: DataFrame, min_bytes: int) -> DataFrame:
    """(file, place, response_page, response_url, response_date): records whose payload another record responds with.

    Of records with equal payloads of ``min_bytes`` or more, that with the largest page id responds
    (of equal ids the last in the archives). Winners are found by a combined aggregate, and
    joined on digest and salt so that one digest may belong to a third of all records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for place, (fields, body) in enumerate(arc_records(content.as_py())):
                    http, payload = http_parts(body)
                    page = int(http["x-page-id"]) if "x-page-id" in http else None
                    rows.append((file, place, page, digest_of(payload), len(payload), fields["URL"], fields["Archive-date"]))
                names = ["file", "place", "page_id", "digest", "bytes", "url", "date"]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    records = arc.mapInArrow(run, "file string, place long, page_id long, digest string, bytes long, url string, date string")
    records = staged(records.where(F.col("bytes") >= min_bytes), "arc-records")
    best = F.max(F.struct("page_id", "file", "place", "url", "date")).alias("best")
    winners = records.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1")
    winners = winners.select("digest", "best", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    salted = records.select("file", "place", "digest", F.pmod(F.xxhash64("file", "place"), F.lit(SALTS)).cast("int").alias("salt"))
    return (
        salted.join(winners, ["digest", "salt"])
        .where((F.col("file") != F.col("best.file")) | (F.col("place") != F.col("best.place")))
        .select("file", "place", F.col("best.page_id").alias("response_page"), F.col("best.url").alias("response_url"), F.col("best.date").alias("response_date"))
    )


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, *, min_bytes: int = 0) -> None:
    """Convert archives: one warcinfo record an archive, then a response or revisit record for each ARC record.

    Identifiers are name-based UUIDs of URL, date, digest and page, so a task that runs again
    writes the same records. Dates become ISO, payload digests are SHA-1 in base32; a revisit
    keeps the HTTP header, names its response and carries no payload. The archives' compressed
    bytes meet the list of their revisits in one shuffle by file.
    """
    arc = read_files(spark, arc_path)
    revisits = find_revisits(arc, min_bytes)

    def convert(left: pa.Table, right: pa.Table) -> pa.Table:
        again = {r["place"]: r for r in right.to_pylist()}
        out = []
        for file, content in zip(left.column("path").to_pylist(), left.column("content"), strict=True):
            info = f"software: staylens\r\nconformsTo: WARC 1.0\r\nsource: {file.rsplit('/', 1)[-1]}\r\n".encode()
            first = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(file, "", "", "")), ("WARC-Date", warc_date("19700101000000"))]
            out.append(warc_record([*first, ("Content-Type", "application/warc-fields")], info))
            for place, (fields, body) in enumerate(arc_records(content.as_py())):
                http, payload = http_parts(body)
                digest, url, date, page = digest_of(payload), fields["URL"], fields["Archive-date"], http.get("x-page-id", "")
                head = [("WARC-Record-ID", record_id(url, date, digest, page)), ("WARC-Date", warc_date(date)), ("WARC-Target-URI", url)]
                head += [("WARC-IP-Address", fields["IP-address"]), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
                if found := again.get(place):
                    other = "" if found["response_page"] is None else str(found["response_page"])
                    head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(found["response_url"], found["response_date"], digest, other))]
                    head += [("WARC-Refers-To-Target-URI", found["response_url"]), ("WARC-Refers-To-Date", warc_date(found["response_date"])), ("X-Refers-To-Page", other)]
                    block = body[: len(body) - len(payload)]
                else:
                    block = body
                out.append(warc_record([("WARC-Type", "revisit" if found else "response"), *head], block))
        return pa.table({"record": pa.array(out, pa.large_binary()).cast(pa.binary())})

    records = arc.groupBy("path").cogroup(revisits.groupBy("file")).applyInArrow(convert, RAW)
    write_records(records, warc_path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The digest of every payload that is there is checked against the header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def some(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in warc_records(content.as_py()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, payload = http_parts(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and digest != digest_of(payload):
                        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                    page, refers = http.get("x-page-id"), fields.get("x-refers-to-page")
                    size = int(http["content-length"])
                    rows.append((page and int(page), fields["warc-target-uri"], size, digest, kind, int(refers) if refers else None, payload if kind == "response" else None))
                    if len(rows) == 1000:
                        yield some(rows)
                        rows = []
                yield some(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return read_files(spark, path).select("content").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, *, min_bytes: int = 0, date: str = "20240101000000", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write pages as ARC archives, convert these to WARC and read the WARC records back.

    Null html is an empty payload, a null url is ``urn:none``, white space in a url is
    escaped; a null page id ranks below all others and comes back null; of repeated
    page ids with equal payloads the last in the archives responds; an empty table
    gives an empty result; only the three named columns are read.
    """
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, id_col=id_col, url_col=url_col, html_col=html_col, date=date)
    arc_to_warc(spark, arc, warc, min_bytes=min_bytes)
    return read_warc(spark, warc)


@query(
    "op7_warc",
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages
), b AS (
  SELECT *, list_aggregate([lpad(CAST(instr('0123456789abcdef', substr(hex, i, 1)) - 1 AS VARCHAR), 2, '0') FOR i IN range(1, 41)], 'string_agg', '') AS digits FROM p
), v AS (
  SELECT *, [CAST(substr(digits, 2 * i + 1, 2) AS INT) FOR i IN range(0, 40)] AS nibbles FROM b
), w AS (
  SELECT *, [
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((nibbles[1 + (5 * g) // 4] * 16 + coalesce(nibbles[2 + (5 * g) // 4], 0)) >> (3 - (5 * g) % 4)) & 31), 1)
    FOR g IN range(0, 32)] AS letters
  FROM v
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       list_aggregate(letters, 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM w
""",
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("url", "payload")
