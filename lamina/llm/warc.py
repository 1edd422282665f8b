"""WARC archives as tables of record chunks.

A record is rows (record, chunk, whole, data, digest): its bytes in pieces of at most ``CHUNK`` payload bytes, in
order; the data of all chunks, put together, are the WARC record with its headers and closing line ends. Each row
carries the SHA-1 of the payload up to its end, so a reader verifies as it goes and never holds a whole record.
The first chunk holds the headers; a record of one chunk is marked whole, and read without any grouping.

Of records with equal payloads of at least ``least_bytes`` bytes, that of least page_id is a response and all
others revisit it; a revisit keeps the HTTP header, which states the length of the full payload, and no payload.

A null or empty payload has 0 bytes; a null url is written as an empty one. A row without page_id is written under
the name "null", after all others in rank. page_id names a page: rows that repeat one with the same payload are of
the same type. An empty table gives empty archives. Columns other than the three that are named are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, shared_folder, task
from .graph import redealt

CHUNK = 64 << 10
URN = "urn:page:"
#: All records bear one date, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def head(page_id: int | None, url: str, size: int, digest: str, first: int | None) -> bytes:
    """The WARC and HTTP headers of a record; first: the page that it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = "null" if page_id is None else page_id
    said = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<{URN}{name}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join(url.split())), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
        *([] if first is None else [("WARC-Refers-To", f"<{URN}{first}>"), ("WARC-Profile", PROFILE)]),
        ("Content-Length", str(len(http) + (size if first is None else 0))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in said).encode() + b"\r\n" + http


def chunks(page_id: int | None, url: str, body: memoryview, first: int | None, size: int = CHUNK) -> Iterator[tuple[int, bool, bytes, str]]:
    """(chunk, whole, data, digest) of one record, from a view of its payload."""
    full = hashlib.sha1()
    for at in range(0, len(body), size):
        full.update(body[at : at + size])
    lead = head(page_id, url, len(body), _base32(full.digest()), first)
    left = body if first is None else body[:0]
    count, so_far = max(1, -(-len(left) // size)), hashlib.sha1()
    for i in range(count):
        piece = left[i * size : (i + 1) * size]
        so_far.update(piece)
        yield i, count == 1, b"".join((lead if i == 0 else b"", piece, b"\r\n\r\n" if i == count - 1 else b"")), so_far.hexdigest()


class Reader:
    """Reads one record from its chunks, one at a time."""

    def __init__(self):
        self.held, self.fields, self.http, self.left = b"", None, {}, 0
        self.sha1, self.size = hashlib.sha1(), 0

    def _lines(self) -> dict[str, str] | None:
        block, found, rest = self.held.partition(b"\r\n\r\n")
        if not found:
            return None
        self.held = rest
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")[1:])}

    def feed(self, data: bytes, digest: str) -> None:
        self.held += data
        if self.fields is None and (fields := self._lines()) is not None:
            self.fields, self.left = fields, int(fields["content-length"])
        if self.fields is not None and not self.http:
            before = len(self.held)
            if (http := self._lines()) is None:
                return
            self.http, self.left = http, self.left - (before - len(self.held))
        if self.fields is not None:
            body, self.held = self.held[: self.left], self.held[self.left :]
            self.sha1.update(body)
            self.size, self.left = self.size + len(body), self.left - len(body)
            if self.sha1.hexdigest() != digest:
                raise ValueError(f"a chunk of {self.fields.get('warc-record-id')} fails its digest")

    def result(self) -> dict[str, object]:
        if self.fields is None or self.left or self.held != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        revisit, page = self.fields["warc-type"] == "revisit", lambda name: self.fields[name].strip("<>").removeprefix(URN)
        digest = self.fields["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and digest != _base32(self.sha1.digest()):
            raise ValueError(f"{self.fields['warc-record-id']} fails its payload digest")
        own = page("warc-record-id")
        return {
            "page_id": None if own == "null" else int(own), "payload_bytes": int(self.http["content-length"]) if revisit else self.size, "payload_digest": digest,
            "record_type": self.fields["warc-type"], "refers_to": int(page("warc-refers-to")) if revisit else None, "url": self.fields["warc-target-uri"],
        }


def records(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """The chunk table of a table of pages."""
    prepare(pages.sparkSession)

    def digest(column: str) -> Column:
        return F.sha1(F.coalesce(F.col(column), F.lit("")).cast("binary"))

    pages = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("payload"))
    known = pages.select("page_id", digest("payload").alias("sha1"), F.octet_length(F.coalesce("payload", F.lit(""))).alias("size")).where(f"size >= {least_bytes}")
    firsts = known.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("many")).where("many > 1 and first is not null").select("sha1", "first")
    again = known.join(redealt(firsts, "sha1"), "sha1").where("not (page_id <=> first)").select(F.col("page_id").alias("id"), "sha1", "first").distinct()
    rows = pages.withColumn("sha1", digest("payload"))
    rows = rows.join(redealt(again, "id", "sha1").withColumnRenamed("sha1", "sha"), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha1") == F.col("sha")), "left")
    schema = pa.schema([("record", pa.string()), ("chunk", pa.int32()), ("whole", pa.bool_()), ("data", pa.binary()), ("digest", pa.string())])

    def write(batches):
        # pages may share an identifier; with the number of its task and its own in it, a record has a name of its own
        partition, number = TaskContext.get().partitionId(), 0
        for batch in task(batches):
            # payloads are views of the batch's buffer, not copies of it
            column = batch.column("payload")
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            column = column.cast(pa.large_string())
            offsets, data = memoryview(column.buffers()[1]).cast("q")[column.offset :], memoryview(column.buffers()[2] or b"")
            out, held = [], 0
            for i, (page_id, address, first) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "first")), strict=True)):
                body = data[offsets[i] : offsets[i + 1]] if column[i].is_valid else data[:0]
                record, number = f"{page_id}-{partition}-{number}", number + 1
                for n, whole, piece, so_far in chunks(page_id, address or "", body, first):
                    out.append((record, n, whole, piece, so_far))
                    held += len(piece)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return rows.select("page_id", "url", "payload", "first").mapInArrow(write, "record string, chunk int, whole boolean, data binary, digest string")


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write the archives of a table of pages, one for each part file, to a path that all executors reach."""
    records(pages, **options).write.parquet(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record, verified."""
    table = prepare(spark).read.parquet(path)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def parse(batches):
        now, reader, place = None, None, 0
        for batch in task(batches):
            out = []
            for record, n, data, digest in zip(*(batch.column(c) for c in ("record", "chunk", "data", "digest")), strict=True):
                if n.as_py() == 0 or record.as_py() != now:
                    if reader:
                        out.append(reader.result())
                    now, reader, place = record.as_py(), Reader(), 0
                if n.as_py() != place:
                    raise ValueError(f"chunk {place} of {now} is missing")
                reader.feed(data.as_py(), digest.as_py())
                place += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if reader:
            yield pa.RecordBatch.from_pylist([reader.result()], schema=schema)

    said = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    columns = ("record", "chunk", "data", "digest")
    single = table.where("whole").select(*columns).mapInArrow(parse, said)
    parted = table.where("not whole").select(*columns).repartition("record").sortWithinPartitions("record", "chunk").mapInArrow(parse, said)
    return single.unionByName(parted)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archives of the pages in the shared checkpoint folder, which go with the driver, and what reading them gives."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark, 'warc')}/records"
    write_archives(pages, path, **options)
    return read_archives(spark, path)
