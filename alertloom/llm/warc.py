"""Web archives: writing pages as WARC records, and assembling captures from the records of archives.

A page is written as three records: the request, the response with the page's html (or a revisit, if an
equal payload is a response already), and metadata. Request and metadata name the response's record as
the one they are concurrent to. Archives are plain WARC/1.1 files; records end where the next separator
of two empty lines is, so Spark's text writer makes them. Pages of like size share files, so that a file, which is
read back as one row, has a bounded number of bytes.

Reading takes records apart by their Content-Length, whatever their payload holds, and joins those of a
transaction through the concurrent-to identifiers into one nested row per capture.

Defined cases: a null html is an empty payload. Of equal payloads of `least` bytes or more, the page with the
largest page_id is the response (null is smallest; of repeated rows with that id, one); smaller payloads
are all responses. A null url leaves the target header out; line breaks and spaces in it are escaped.
A response without request or metadata makes a capture with nulls there; records concurrent to
nothing in the archives make none. Pages that are not read from plain files are written once first.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.llm.text import free_prefix
from alertloom.session import scratch_dir, settled, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# Pages of up to so many bytes, and the records of such pages in one file: about 32 MB at most, or one page.
FILE_SIZES = ((16 << 10, 6000), (256 << 10, 375), (4 << 20, 24), (None, 3))
_LINE, _END = "\r\n", "\r\n\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(row: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{row}/{kind}'.encode()).digest())}>"


def _record(headers: list[tuple[str, str | None]], block: str) -> str:
    """One record without its final separator."""
    lines = [VERSION, *[f"{k}: {v}" for k, v in headers if v is not None]]
    lines.append(f"Content-Length: {len(block.encode())}")
    return _LINE.join(lines) + _END + block


def _records(row: int, page_id, url: str | None, html: str, first_row: int | None) -> list[str]:
    """Request, response or revisit, and metadata of a page. `first_row` is the row of an equal response."""
    data = html.encode()
    target = None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    parts = urlsplit(target) if target and "[" not in target and "]" not in target else None
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "") if parts else "/"
    me = _record_id(row, "response")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    head = _LINE.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(data)}"]) + _END
    digest = ("WARC-Payload-Digest", f"sha1:{payload_digest(data)}")
    http = ("Content-Type", "application/http; msgtype=response")
    if first_row is None:
        answer = _record([("WARC-Type", "response"), ("WARC-Record-ID", me), *common, digest, http], head + html)
    else:
        refers = [("WARC-Profile", REVISIT), ("WARC-Refers-To", _record_id(first_row, "response"))]
        answer = _record([("WARC-Type", "revisit"), ("WARC-Record-ID", me), *common, digest, *refers, http], head)
    beside = [*common, ("WARC-Concurrent-To", me)]
    asked = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _record_id(row, "request")), *beside]
        + [("Content-Type", "application/http; msgtype=request")],
        _LINE.join([f"GET {path} HTTP/1.1", f"Host: {parts.netloc if parts else ''}"]) + _END,
    )
    about = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id(row, "metadata")), *beside]
        + [("Content-Type", "application/warc-fields")],
        "" if page_id is None else f"page-id: {page_id}{_LINE}",
    )
    return [asked, answer, about]


def _revisits(numbered: DataFrame, row: str, least: int) -> DataFrame:
    """Rows with an equal payload elsewhere, and the row that is its response."""
    html = F.coalesce("html", F.lit(""))
    digests = numbered.select(
        F.col(row).alias("row"), "page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("size")
    )
    digests = stored(digests.where(F.col("size") >= least))
    order = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "row")
    firsts = digests.groupBy("digest", "size").agg(F.max(order).alias("first"), F.count("*").alias("c")).where("c > 1")
    # A hot digest is a skewed key of narrow rows on one side only.
    joined = digests.join(firsts.select("digest", "size", F.col("first.row").alias("first_row")), ["digest", "size"])
    return stored(joined.where("row != first_row").select("row", "first_row"))


def _size_class(html: Column, url: Column) -> Column:
    """Which of FILE_SIZES a page belongs to: its payload, and its url in three records, each byte escaped."""
    size = F.coalesce(F.octet_length(html), F.lit(0)).cast("long") + 9 * F.coalesce(F.octet_length(url), F.lit(0))
    out = F.lit(len(FILE_SIZES) - 1)
    for number, (most, _) in reversed(list(enumerate(FILE_SIZES[:-1]))):
        out = F.when(size <= most, number).otherwise(out)
    return out


def write_archives(pages: DataFrame, folder: str, least: int = 0, compression: str = "none") -> None:
    """Write the pages (page_id, url, html) as WARC files."""
    pages = settled(pages.select("page_id", "url", "html"))
    row = free_prefix(pages) + "row"
    numbered = pages.withColumn(row, F.monotonically_increasing_id())
    revisits = _revisits(numbered, row, least)
    # Spark sends the revisits along if their table is small, and moves the pages only if it is not.
    joined = numbered.join(revisits.withColumnRenamed("row", row), row, "left")
    sized = _size_class(F.col("html"), F.col("url"))
    # The first class is always written, so that an empty table gives an empty archive.
    classes = {0, *(r[0] for r in pages.select(sized).distinct().collect())}

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                rows = batch.slice(low, 200)
                values = zip(*(rows.column(i).to_pylist() for i in range(5)))
                made = [r for row, page, url, html, first in values for r in _records(row, page, url, html or "", first)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["value"])

    columns = joined.select(row, "page_id", "url", "html", "first_row")
    for number in sorted(classes):
        made = columns.where(sized == number).mapInArrow(run, "value string")
        writer = made.write.mode("append").option("lineSep", _END).option("compression", compression)
        writer.option("maxRecordsPerFile", FILE_SIZES[number][1]).text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode().split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if stop > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, data[start:stop]
        at = stop + 4


_FIELDS = (
    "record_id string, type string, uri string, date string, concurrent_to string, refers_to string, "
    "payload_bytes long, payload_digest string, content binary, fields string"
)


def read_records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives; without `payloads`, content is null but still measured."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    kinds = [*[pa.string()] * 6, pa.int64(), pa.string(), pa.binary(), pa.string()]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_buffer().to_pybytes()
                if batch.column(0)[i].as_py().endswith(".gz"):
                    import gzip

                    data = gzip.decompress(data)
                rows = []
                for headers, block in parse(data):
                    rows.append(_row(headers, block, payloads))
                    if len(rows) == 500:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return files.mapInArrow(run, _FIELDS)


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = headers.get("warc-type")
    size = digest = content = fields = None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            size, digest = len(payload), payload_digest(payload)
            if headers.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                raise ValueError(f"the payload of {headers.get('warc-record-id')} has another digest")
            content = payload if payloads else None
        else:
            # The full payload is in the record referred to; its size and digest are told here too.
            told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            size = int(told[1]) if told else None
            digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    elif kind == "metadata":
        fields = block.decode()
    elif payloads:
        content = block
    ids = (headers.get(k) for k in ("warc-target-uri", "warc-date", "warc-concurrent-to", "warc-refers-to"))
    return headers.get("warc-record-id"), kind, *ids, size, digest, content, fields


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its id, page_id, and the nested response (or revisit), request and metadata.

    Records of a transaction meet under the response's id; a capture has a few records, so groups are small.
    """
    told = F.regexp_extract("fields", r"(?m)^page-id: (-?\d+)", 1)
    answer = F.struct("record_id", "type", "uri", "date", "refers_to", "payload_bytes", "payload_digest", "content")
    request = F.struct("record_id", "uri", "date", "content")
    about = F.struct("record_id", "fields", F.when(told != "", told).cast("long").alias("page_id"))
    kind = F.col("type")
    grouped = records.where(kind.isin("response", "revisit", "request", "metadata")).groupBy(
        F.coalesce("concurrent_to", "record_id").alias("capture_id")
    )
    captures = grouped.agg(
        F.first(F.when(kind.isin("response", "revisit"), answer), ignorenulls=True).alias("response"),
        F.first(F.when(kind == "request", request), ignorenulls=True).alias("request"),
        F.first(F.when(kind == "metadata", about), ignorenulls=True).alias("metadata"),
    )
    return captures.where("response is not null").withColumn("page_id", F.col("metadata.page_id"))


def capture_digests(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id)."""
    flat = captures.select("capture_id", "page_id", "response.payload_bytes", "response.payload_digest",
                           F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("target"))
    answers = captures.select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    # Only revisits look their response up.
    found = flat.where("target is not null").join(answers, "target", "left")
    none = flat.where("target is null").withColumn("refers_to", F.lit(None).cast("long"))
    return none.unionByName(found).drop("capture_id", "target")


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages to the shared folder as archives, read these back, and digest the captures."""
    spark = pages.sparkSession
    folder = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, least)
    return capture_digests(stored(assemble(read_records(spark, folder, payloads=False))))
