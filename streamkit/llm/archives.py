"""WARC archives: a writer of one gzip member per record, and a splittable reader.

The writer's tasks each write a file of their own under a fresh name; the list
of files is a table written with Spark's commit protocol, so files of failed or
repeated attempts are never read.  The reader cuts the files into byte ranges.
A task looks for the gzip magic in its range, takes a candidate for a member
only if it decodes to a WARC header and its checksum holds, and owns the
records that start inside its range (it reads past the range's end to finish
the last).  One member is held at a time; it may hold several records.

Archives of other writers are read as they are: header names in any case, with
or without a space after the colon, on folded lines, in bytes that are not
UTF-8 (replaced).  Digests are compared if their algorithm is known (SHA-1,
SHA-256, SHA-512 and MD5, in hex or base 32).  A record that is cut short or damaged, or
whose header or digest does not hold, is a row that says so in ``problem``.

Files are opened through pyarrow's file systems, by URI, in the tasks."""

from __future__ import annotations

import base64
import binascii
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import fresh_dir, query, saved, table

MAGIC = b"\x1f\x8b\x08"
SPLIT = 32 << 20  # bytes of an archive read by one task
FILE = 256 << 20  # bytes after which a task begins another archive
LEAST_REVISIT = 100  # payload bytes from which equal payloads become revisits
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _line(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def record(page: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        kind, more = "response", []
    else:
        block, kind = b"", "revisit"
        more = [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url)}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", *more,
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size = None, "", 0, 0
        listed = lambda: pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})
        try:
            for batch in batches:
                for page, url, html, digest, refers in zip(*batch.columns):
                    if out is None:
                        path, n, size = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                        system, local = _open(path)
                        system.create_dir(local.rsplit("/", 1)[0], recursive=True)
                        out = system.open_output_stream(local, compression=None)
                    data = record(page.as_py(), url.as_py() or "", (html.as_py() or "").encode(), digest.as_py(), refers.as_py())
                    out.write(data)
                    n, size = n + 1, size + len(data)
                    if size >= file_bytes:
                        out.close()
                        out = None
                        yield listed()
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield listed()
    return run


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", file_bytes: int = FILE) -> DataFrame:
    """Writes a record per row below the shared folder; returns the table of
    files (path, records, bytes), of about ``file_bytes`` at most.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, that of the
    smallest id is a response, others revisit it (rows that repeat that id are
    responses too); smaller ones are all responses.  A null payload is empty, a
    null url "", a null id stays null; other columns are ignored; an empty
    table gives no files."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"),
                        F.sha2(payload.cast("binary"), 256).alias("digest"))
    rows = rows.withColumn("key", F.when(F.octet_length("html") >= LEAST_REVISIT, F.col("digest")).otherwise(
        F.concat(F.lit("small-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    # only payloads that repeat; written, so that the join can split the rows of one payload
    first = saved(rows.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1").drop("n"), "warc-first")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    ready = rows.join(first, "key", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return saved(ready.mapInArrow(_write(fresh_dir(spark, "warc"), file_bytes), "path string, records long, bytes long"), "warc-files")


class _Window:
    """Bytes of a file from a position on, read as needed and dropped behind."""

    def __init__(self, file, at: int, step: int = 1 << 20):
        self.file, self.base, self.data, self.step, self.done = file, at, b"", step, False
        file.seek(at)

    def more(self) -> bool:
        new = b"" if self.done else self.file.read(self.step)
        self.done = not new
        self.data += new
        return bool(new)

    def drop(self, upto: int) -> None:
        self.data, self.base = self.data[upto - self.base:], upto


def _member(window: _Window, at: int) -> tuple[bytes, int, str | None] | None:
    """The decoded gzip member at ``at``, its end and what is wrong with it, if it begins with a WARC header."""
    unpack, parts, size, pos, problem = zlib.decompressobj(31), [], 0, at, None
    while not unpack.eof:
        if pos - window.base >= len(window.data) and not window.more():
            problem = "cut"
            break
        chunk = window.data[pos - window.base:pos - window.base + (1 << 16)]
        try:
            data = unpack.decompress(chunk)
        except zlib.error:
            problem, data = "damaged", _until_error(window, at, pos)
            parts = []
        pos += len(chunk) - len(unpack.unused_data)
        parts.append(data)
        if problem:
            break
        if size < 5:
            size += len(data)
            if size >= 5 and b"".join(parts)[:5] != b"WARC/":
                return None
    body = b"".join(parts)
    return (body, pos, problem) if body[:5] == b"WARC/" else None


def _until_error(window: _Window, at: int, upto: int) -> bytes:
    """What a damaged member decodes to before the fault, found byte by byte from ``upto`` on."""
    unpack, out = zlib.decompressobj(31), []
    try:
        out.append(unpack.decompress(window.data[at - window.base:upto - window.base]))
        for i in range(upto - window.base, len(window.data)):
            out.append(unpack.decompress(window.data[i:i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes, str | None]]:
    """(position, content, problem) of the members that start in [start, end)."""
    window, at = _Window(file, start), start
    while at < end:
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            keep = max(at, window.base + len(window.data) - len(MAGIC) + 1)
            window.drop(min(keep, window.base + len(window.data)))
            at = window.base
            if not window.more():
                return
            continue
        at = window.base + found
        if at >= end:
            return
        member = _member(window, at)
        if member is None:
            at += 1
            continue
        body, upto, problem = member
        yield at, body, problem
        at = at + 1 if problem else upto  # behind a fault the next member is looked for
        window.drop(at)


_READ = pa.schema([("path", pa.string()), ("at", pa.int64()), ("number", pa.int32()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()),
                   ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])
_READ_SQL = "path string, at long, number int, record_type string, record_id string, url string, refers_to string, payload_digest string, payload_length long, payload binary, problem string"


def header(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; of repeated names the first counts."""
    fields: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and name is not None:
            fields[name] = f"{fields[name]} {line.strip()}"
        elif ":" in line:
            key, _, value = line.partition(":")
            name = key.strip().lower() if key.strip().lower() not in fields else None
            if name is not None:
                fields[name] = value.strip()
    return fields


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.isascii() and text.isdigit() and len(text) < 19 else None


def digest_holds(stated: str, data: bytes) -> bool:
    """False if ``algorithm:value`` is of a known algorithm and not that of ``data``."""
    algorithm, _, value = stated.partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return True
    real, value = hashlib.new(algorithm, data).digest(), value.strip()
    if len(value) == 2 * len(real):
        return value.lower() == real.hex()
    try:
        return base64.b32decode(value.upper() + "=" * (-len(value) % 8)) == real
    except binascii.Error:
        return False


def _split_head(data: bytes) -> tuple[bytes, bytes, int]:
    """(header, rest, header's length with the empty line); no empty line: all is header."""
    ends = [(data.find(mark), len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if mark in data]
    at, width = min(ends, default=(len(data), 0))
    return data[:at], data[at + width:], at + width


def parse(body: bytes, problem: str | None = None) -> Iterator[tuple]:
    """The columns, after path, position and number, of the records in a member's content.

    Payload: of HTTP messages what follows their header, of revisits none, else
    the block.  problem: the member's, of its last record; ``header`` if type or
    length is missing or no number, ``cut`` if the block is shorter than stated,
    ``digest`` if a stated digest of block or payload does not hold, else null."""
    while body.strip(b"\r\n"):
        body = body.lstrip(b"\r\n")
        head, rest, used = _split_head(body)
        fields = header(head)
        kind, length = fields.get("warc-type"), _number(fields.get("content-length"))
        block = rest if length is None else rest[:length]
        body = b"" if length is None or not rest[length:].lstrip(b"\r\n").startswith(b"WARC/") else rest[length:]
        wrong = "header" if kind is None or length is None or not head.startswith(b"WARC/") else "cut" if len(block) < length else None
        http = fields.get("content-type", "").lower().startswith("application/http")
        payload = None if kind == "revisit" else _split_head(block)[1] if http else block
        if wrong is None and not (digest_holds(fields.get("warc-block-digest", ""), block)
                                  and (payload is None or digest_holds(fields.get("warc-payload-digest", ""), payload))):
            wrong = "digest"
        digest = fields.get("warc-payload-digest", "")
        size = len(payload) if payload is not None else _number(fields.get("x-payload-length"))
        yield (kind, fields.get("warc-record-id"), fields.get("warc-target-uri", ""), fields.get("warc-refers-to"),
               digest.partition(":")[2] if ":" in digest else digest, size, payload, (problem if not body and problem else None) or wrong)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            system, local = _open(path)
            rows, size = [], 0
            with system.open_input_file(local) as file:
                for at, body, problem in records_in(file, start, end):
                    rows += [(path, at, k, *columns) for k, columns in enumerate(parse(body, problem))]
                    size += len(body)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _READ)], schema=_READ)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _READ)], schema=_READ)


def read_archives(files: DataFrame, *, split: int = SPLIT) -> DataFrame:
    """The records of the archives in ``files`` (path, bytes), by ranges of
    ``split`` bytes: (path, at, number, record_type, record_id, url, refers_to,
    payload_digest, payload_length, payload, problem).

    ``at`` is the member's position, ``number`` the record's in it.  Missing fields
    are null (url: empty); ``payload_digest`` is as stated, without the algorithm.
    Nothing that begins with a WARC header is skipped: see ``parse`` for
    ``problem``.  After damage reading goes on at the next member.  Files without
    members, and no files, give no rows."""
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start")) \
        .select("path", "start", F.least(F.col("start") + split, "bytes").alias("end"))
    count = files.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    return ranges.repartition(int(count)).mapInArrow(_read, _READ_SQL)


def page_of(column: str) -> F.Column:
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


@query("op3_warc_round_trip", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha256(t) AS payload_digest,
             CASE WHEN strlen(t) >= 100 THEN min(page_id) OVER (PARTITION BY t) END AS low FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN low < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN low < page_id THEN low END AS refers_to FROM d
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_archives(write_archives(table(spark, sf_dir, "pages")))
    return read.select(page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
                       page_of("refers_to").alias("refers_to"))
