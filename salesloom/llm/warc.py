"""WARC archives: a writer with revisit records and a reader that splits compressed files.

Every record is a gzip member of its own. A reading task owns the members that start inside its byte range: it scans
for the gzip magic, takes a place for a member only if its first bytes decode to a WARC header, and from there follows
member after member, past the end of its range for the last one. Nothing has to know the members' places beforehand.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.store import filesystem, staged, staged_texts

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture


# ---------------------------------------------------------------- records

def _record_id(page_id: int | None, digest: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _one_line(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit without the payload where ``refers_to`` names the page that holds it."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _record_id(refers_to, digest)),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields (lower-case names), length that the HTTP header states, and payload of a record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not found:
        raise ValueError("not a WARC record")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields.get("content-length", -1))
    if size < 0 or len(rest) < size:
        raise ValueError("a WARC record is cut short")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    stated = [h.partition(b":")[2] for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:")]
    return fields, int(stated[0]) if stated else len(payload), payload


# ---------------------------------------------------------------- writer

FILES = pa.schema([("file", pa.string()), ("size", pa.int64()), ("records", pa.int64())])


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        part, out, size, n, name = TaskContext.get().partitionId(), None, 0, 0, ""
        closed = []
        for batch in batches:
            for page, url, html, digest, refers in zip(*batch.columns):
                if out is None:
                    name, size, n = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)  # members are compressed already
                data = member(record(page.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), refers.as_py()))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    closed.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            closed.append((name, size, n))
        if closed:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*closed), FILES)], schema=FILES)
    return run


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, html, digest and ``refers_to``: the largest page_id with the same payload, on the other rows.

    Payloads under ``least_bytes`` are never referred to. Null html is an empty payload. Rows that repeat the largest
    page_id are all responses; a row without page_id refers to the largest like any other.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    first = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(first, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to"))


def write(pages: DataFrame, folder: str, archive_bytes: int = 1 << 30) -> DataFrame:
    """Archive ``pages`` (page_id, url, html; other columns are ignored) in ``folder``.

    Returns file, size, records; files of attempts that failed are not listed. An empty table writes no file.
    """
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    return staged_texts(with_revisits(pages).mapInArrow(
        _write(folder, archive_bytes), "file string, size long, records long"), "warc-files")


# ---------------------------------------------------------------- reader

class Members:
    """Gzip members of an open file that start in [start, stop), with their places."""

    def __init__(self, source, start: int, stop: int):
        self.source, self.start, self.stop = source, start, stop
        self.end = source.size()

    def _decode(self, at: int, header_only: bool) -> tuple[bytes, int]:
        """The member's content and the place behind it, or its first bytes only."""
        unpack, parts, size = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            data = self.source.read_at(min(CHUNK if not header_only else 1024, self.end - at), at)
            if not data:
                raise ValueError("a gzip member is cut short")
            at += len(data)
            parts.append(unpack.decompress(data, 64) if header_only else unpack.decompress(data))
            size += len(parts[-1])
            if header_only and size >= 5:
                break
        return b"".join(parts), at - len(unpack.unused_data)

    def _starts(self, at: int) -> bool:
        try:
            return self._decode(at, True)[0].startswith(b"WARC/")
        except (zlib.error, ValueError):
            return False

    def _next(self, at: int) -> int | None:
        """The first place from ``at`` on and before the range's end where a record starts."""
        while at < self.stop:
            data = self.source.read_at(min(CHUNK + 2, self.end - at), at)
            found = data.find(MAGIC)
            while found >= 0 and at + found < self.stop:
                if self._starts(at + found):
                    return at + found
                found = data.find(MAGIC, found + 1)
            at += max(1, len(data) - 2)
        return None

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        at = self._next(self.start)
        while at is not None:
            content, behind = self._decode(at, False)
            yield at, content
            at = self._next(behind)


RECORDS = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()),
    ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload", pa.binary())])
RECORDS_DDL = ("file string, place long, record_type string, page_id long, url string, digest string, "
               "refers_to long, payload_bytes long, payload binary")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{root}/{name}") as source:
                    rows, held = [], 0
                    for place, content in Members(source, start, stop):
                        fields, stated, payload = parse(content)
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        number = lambda key: int(fields[key]) if key in fields else None  # noqa: E731, B023
                        rows.append((name, place, kind, number("x-page-id"), fields.get("warc-target-uri"),
                                     fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                                     number("x-refers-to-page-id"), stated, payload if kind == "response" else None))
                        held += len(content)
                        if held > 1 << 23 or len(rows) >= 2000:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)


def read(spark: SparkSession, files: DataFrame, folder: str, split_bytes: int = 1 << 23) -> DataFrame:
    """Response and revisit records of the archives listed in ``files`` (file, size).

    ``payload_bytes`` is the length that the record's HTTP header states; ``payload`` is null in revisits.
    """
    ranges = staged(files.select("file", "size", F.explode(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("size") - 1), F.lit(split_bytes).cast("long"))).alias("start"))
        .select("file", "start", F.least("size", F.col("start") + split_bytes).alias("stop")), "warc-ranges")
    return ranges.repartition(max(1, min(ranges.count(), 100_000))).mapInArrow(_read(folder), RECORDS_DDL)
