"""WARC archives: index first, then coalesced byte-range reads.

Writing: each task writes one archive of gzip members (one a record) to the shared folder and returns the index of
what it wrote: file, offset, length, URL, digest. The index is stored before anything is read. A task that is run
again writes another file; the index names only files of tasks that succeeded. Reading: the index rows that are
selected are sorted by file and offset, neighbouring ranges are fetched with one read, and the records are parsed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, scratch, stored

#: Payloads below this many bytes are never revisits; ranges closer than GAP are read at once, up to SPAN bytes.
REVISIT_BYTES, GAP, SPAN, LEVEL = 1000, 1 << 16, 8 << 20, 4
#: Bytes of archive that a reading task has at least (where there are cores for more tasks) and at most.
LEAST_BYTES, MOST_BYTES = 2 << 20, 128 << 20
INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
DATE = "2000-01-01T00:00:00Z"


def _identity(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to`` not None) has the HTTP header without the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_identity(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{_base32(digest)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_identity(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an unpacked record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a broken record")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda k: int(fields[k]) if k in fields else None
    if fields["WARC-Type"] == "response" and (digest != hashlib.sha1(payload).hexdigest() or len(payload) != sizes[0]):
        raise ValueError("the payload differs from its digest or length")
    return number("X-Page-Id"), sizes[0], digest, fields["WARC-Type"], number("X-Refers-To-Page-Id")


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """INDEX of the records written; ``pages`` has page_id, url, html, digest, refers_to. Evaluate it once only."""

    def run(batches):
        out, name, at = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        try:
            for batch in batches:
                rows = [[], [], [], [], [], [], []]
                for page, url, html, digest, refers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    raw = pack.compress(record(page, url, html.encode(), digest, refers)) + pack.flush()
                    if out is None:
                        store, path = _open(name)
                        store.create_dir(path.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(path, compression=None)  # the members are packed already
                    out.write(raw)
                    for column, value in zip(rows, (name, at, len(raw), url, digest, page, "response" if refers is None else "revisit"), strict=True):
                        column.append(value)
                    at += len(raw)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["file", "offset", "length", "url", "digest", "page_id", "record_type"])
        finally:
            if out is not None:
                out.close()

    return pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, INDEX)


def _ranges(rows, gap: int, span: int):
    """Runs of (offset, length) of one file that one read fetches."""
    run: list = []
    for row in rows:
        if run and (row[0] != run[0][0] or row[1] > run[-1][1] + run[-1][2] + gap or row[1] + row[2] - run[0][1] > span):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_archives(index: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """RECORDS of the index rows given, by sorted and coalesced range reads; memory is bounded by ``span`` or a record.

    The index is dealt to tasks by file and offset, as many as its bytes of archive are worth.
    """

    def run(batches):
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        name, file, out = None, None, []
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        emit = lambda out: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        for part in _ranges(rows, gap, span):
            if part[0][0] != name:
                if file is not None:
                    file.close()
                name = part[0][0]
                store, path = _open(name)
                file = store.open_input_file(path)
            first = part[0][1]
            file.seek(first)
            got = memoryview(file.read(part[-1][1] + part[-1][2] - first))
            out += [parse(zlib.decompress(got[at - first : at - first + size], 31)) for _, at, size in part]
            if len(out) >= 1000:
                yield emit(out)
                out = []
        if file is not None:
            file.close()
        if out:
            yield emit(out)

    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    cores = 2 * index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, -(-total // LEAST_BYTES)), -(-total // MOST_BYTES))
    return index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES) -> DataFrame:
    """The stored index of the archives of ``pages`` (page_id, url, html).

    Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is the response and
    the others revisit it; smaller ones are responses. Null html is an empty payload; rows that repeat the largest
    page_id are responses all; a null page_id never is the largest and, alone in its group, stays a response. The
    html shuffles once at most, by page_id, and not where the revisits fit a broadcast.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    long = rows.filter(F.octet_length("html") >= least).select("page_id", "digest")
    groups = stored(long.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last is not null"), "payloads")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    again = attach_groups(long, groups, "digest", "n", total, "page_id").filter(~F.col("page_id").eqNullSafe(F.col("last")))
    again = again.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), F.col("last").alias("refers_to")).distinct()
    joined = rows.join(again, rows.page_id.eqNullSafe(again._p) & (rows.digest == again._d), "left")
    folder = folder or scratch(pages.sparkSession, "warc")
    return stored(write_archives(joined, folder), "index")
