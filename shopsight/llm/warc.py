"""Legacy archive converter: ARC records become WARC records.

An ARC file opens with a version block, whose second line names the version and whose third the fields of every record header
(version 1: URL, IP address, date, type, length; version 2 adds result code, checksum, location, offset and
file name). A record is its header line, then as many bytes as the header declares, then a newline. The block of a record
is a protocol response; its body is the payload.

For WARC the converter makes up what ARC has not: a record id from the record's content, an ISO timestamp, the type (response, or
revisit of the response with the smallest id that has an equal payload of at least 100 bytes), and SHA-256 digests.

Files are written by Spark's text writer, gzipped, a bounded number of records each, and read whole, a file per row.

Defined results: a null payload is empty; a null URL is written as "-", white space in it percent-encoded; records with
null ids revisit others but are never the first while one with an id exists.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import folder, written

RECORDS_PER_FILE = 256
ZLIB_LEVEL = "THREE"  # Hadoop's name of it: files of pages are about 5 % larger than at the usual 6, for a third of the CPU time
LEAST_BYTES = 100
ADDRESS, DATE = "192.0.2.1", "19990101000000"
# Header fields of the two ARC versions, in their order.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
RECORD_SCHEMA = "page_id long, url string, address string, date string, block binary, payload_bytes long, payload_digest string"


def opening(version: int) -> str:
    """The version block that every ARC file opens with."""
    about = f"{version} 0 shopsight\n{FIELDS[version]}\n"
    return f"filedesc://pages.arc 0.0.0.0 {DATE} text/plain" + (" 200 - - 0 pages.arc" if version == 2 else "") + f" {len(about)}\n{about}"


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = tuple(FIELDS)) -> None:
    """Pages (page_id, url, html) as ARC files of `RECORDS_PER_FILE` rows, the first of which is the version block.

    Tasks take the versions in turn, so the pages are read once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, version = 0, versions[TaskContext.get().partitionId() % len(versions)]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if n % RECORDS_PER_FILE == 0:
                    out.append(opening(version))
                    n += 1
                body = row["html"] or ""
                size = len(body.encode())
                number = "" if row["page_id"] is None else f"X-Page-Id: {row['page_id']}\r\n"
                block = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {size}\r\n\r\n{body}"
                url = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"] or "") or "-"
                more = "200 - - 0 pages.arc " if version == 2 else ""
                out.append(f"{url} {ADDRESS} {DATE} text/html {more}{len(block.encode())}\n{block}")
                n += 1
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    lines = pages.select("page_id", "url", "html").mapInArrow(run, "value string")
    lines.write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", ZLIB_LEVEL).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_arc(content: bytes) -> Iterator[dict]:
    """Header fields and block of every record of one ARC file."""
    at, names = 0, None
    while at < len(content):
        if content[at : at + 1] == b"\n":
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode().split(" ")
        size = int(values[-1])
        block = content[end + 1 : end + 1 + size]
        if len(block) != size:
            raise ValueError("an ARC record is shorter than it declares")
        at = end + 1 + size
        if names is None:  # the version block says how the other headers are laid out
            version, layout = block.decode().split("\n")[:2]
            names = layout.split(" ")
            if names != FIELDS.get(int(version.split(" ")[0]), "").split(" "):
                raise ValueError(f"unknown ARC layout: {layout}")
            continue
        if len(values) != len(names):
            raise ValueError("an ARC header does not match its version")
        yield dict(zip(names, values)) | {"block": block}


def _response(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}, body


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for record in parse_arc(gzip.decompress(content.as_py())):
                    headers, body = _response(record["block"])
                    number = headers.get("x-page-id")
                    out.append(
                        {
                            "page_id": None if number is None else int(number),
                            "url": record["URL"],
                            "address": record["IP-address"],
                            "date": record["Archive-date"],
                            "block": record["block"],
                            "payload_bytes": len(body),
                            "payload_digest": hashlib.sha256(body).hexdigest(),
                        }
                    )
                if out:
                    yield from pa.Table.from_pylist(out, schema=RECORD_ARROW).to_batches()

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


RECORD_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("address", pa.string()), ("date", pa.string()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def record_id(page_id: int | None, url: str, date: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {date} {url}'.encode()).digest()[:16], version=5)}>"


def write_warc(records: DataFrame, path: str) -> None:
    """Records as WARC files. Equal payloads are found by digest; only digests and ids are grouped."""
    firsts = records.where(F.col("payload_bytes") >= LEAST_BYTES).groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "date")).alias("first"))
    joined = records.join(firsts, "payload_digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first, block = r["first"] if r["payload_bytes"] >= LEAST_BYTES else None, r["block"].decode()
                again = first is not None and not first["none"] and first["page_id"] != r["page_id"]
                d = r["date"]
                head = [
                    "WARC/1.1",
                    f"WARC-Type: {'revisit' if again else 'response'}",
                    f"WARC-Record-ID: {record_id(r['page_id'], r['url'], d)}",
                    f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                    f"WARC-Target-URI: {r['url']}",
                    f"WARC-IP-Address: {r['address']}",
                    f"WARC-Payload-Digest: sha256:{r['payload_digest']}",
                ]
                if again:
                    head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(first['page_id'], first['url'], first['date'])}"]
                    block = block.partition("\r\n\r\n")[0] + "\r\n\r\n"
                raw = block.encode()
                head += [f"WARC-Block-Digest: sha256:{hashlib.sha256(raw).hexdigest()}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(raw)}"]
                out.append("\r\n".join(head) + "\r\n\r\n" + block)
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    lines = joined.select(*records.columns, "first").mapInArrow(run, "value string")
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", ZLIB_LEVEL).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(headers["content-length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) != size or hashlib.sha256(block).hexdigest() != headers["warc-block-digest"].partition(":")[2]:
            raise ValueError("a WARC block does not match its header")
        at = end + 4 + size + 4
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per record: record_id, page_id, payload_bytes, payload_digest, record_type, refers_to_id."""
    arrow = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for headers, block in parse_warc(gzip.decompress(content.as_py())):
                    inner, body = _response(block)
                    kind, digest = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2]
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError("a WARC payload does not match its digest")
                    number = inner.get("x-page-id")
                    out.append({"record_id": headers["warc-record-id"], "page_id": None if number is None else int(number), "payload_bytes": int(inner["content-length"]), "payload_digest": digest, "record_type": kind, "refers_to_id": headers.get("warc-refers-to")})
                if out:
                    yield from pa.Table.from_pylist(out, schema=arrow).to_batches()

    schema = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to_id string"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def convert(pages: DataFrame) -> DataFrame:
    """Pages through ARC files of both versions into WARC files and back: one row per page."""
    spark = pages.sparkSession
    base = folder(spark)
    typed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    write_arc(typed, f"{base}/arc")
    write_warc(read_arc(spark, f"{base}/arc"), f"{base}/warc")
    records = written(read_warc(spark, f"{base}/warc"), "records")  # read once: ids and digests, no blocks
    responses = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.min("page_id").alias("refers_to"))
    return records.join(responses, "refers_to_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
