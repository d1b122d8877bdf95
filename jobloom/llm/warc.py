"""WARC archives: a writer of files with revisit records, and a sequential reader.

Every record is a gzip member of its own.  The reader feeds compressed bytes to an
incremental decompressor as they come, ends a record where its member ends, frames
the block by Content-Length and checks both digests; it holds one record at a time.
Workers write and read ``.warc.gz`` files of the shared folder themselves, where
pyarrow knows its kind of store; elsewhere archives are rows of a table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import ship, shared_folder, stored, text_blocks

VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 64 << 10
#: Record ids of pages, percent-coded; a null id has one of its own.
PAGE, NO_PAGE = "urn:page:", "urn:no-page"
#: Revisits up to this number (48 bytes each) are broadcast to the writers; beyond it they are joined by shuffling.
BROADCAST_ROWS = 200_000


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes  # empty in a revisit

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


def _gz(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_bytes(kind: str, record_id: str, date: str, block: bytes, content_type: str, more: Iterable[tuple[str, str]] = ()) -> bytes:
    """One record as a gzip member."""
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *more, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = VERSION + "\r\n" + "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]+', ' ', v)}\r\n" for k, v in headers) + "\r\n"
    return _gz(head.encode() + block + b"\r\n\r\n")


def page_urn(page: str | None) -> str:
    return NO_PAGE if page is None else PAGE + quote(page, safe="")


def page_of(urn: str | None) -> str | None:
    """The page of a record id, as written by ``page_urn``; null for null, and ids of other writers as they are."""
    bare = (urn or "").removeprefix("<").removesuffix(">")
    return unquote(bare.removeprefix(PAGE)) if bare.startswith(PAGE) else None if bare in ("", NO_PAGE) else bare


def page_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A response record, or a revisit of the page ``refers_to``, whose payload is the same."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    more = [("WARC-Target-URI", url or "urn:none"), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())]
    if refers_to is not None:
        more += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<{page_urn(refers_to)}>")]
        return record_bytes("revisit", page_urn(page), date, http, "application/http; msgtype=response", more)
    return record_bytes("response", page_urn(page), date, http + payload, "application/http; msgtype=response", more)


def members(data: Iterable[bytes]) -> Iterator[bytes]:
    """Decompressed gzip members of a stream of chunks."""
    z, out = None, []
    for chunk in data:
        while chunk:
            z = z or zlib.decompressobj(31)
            out.append(z.decompress(chunk))
            chunk = b""
            if z.eof:
                chunk = z.unused_data
                yield b"".join(out)
                z, out = None, []
    if z is not None:
        raise ValueError("the archive ends within a record")


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise ValueError(f"no header: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def parse(record: bytes) -> Record:
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        raise ValueError("no record header")
    headers = _fields(lines[1:])
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{headers.get('warc-record-id')}: the block is not Content-Length bytes long")
    block = rest[:length]
    _verify(headers.get("warc-block-digest"), block, headers)
    if not headers.get("content-type", "").startswith("application/http"):
        return Record(headers, {}, block)
    http, _, payload = block.partition(b"\r\n\r\n")
    if headers["warc-type"] == "response":
        _verify(headers.get("warc-payload-digest"), payload, headers)
    return Record(headers, _fields(http.split(b"\r\n")[1:]), payload)


def _digest_bytes(value: str, size: int) -> bytes | None:
    """A digest of so many bytes from hex digits or base32, as crawlers write it; None if it is neither."""
    try:
        found = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return None
    return found if len(found) == size else None


def _verify(digest: str | None, data: bytes, headers: dict[str, str]) -> None:
    """Digests of algorithms that aren't known here are passed over."""
    if digest is None:
        return
    kind, _, value = digest.partition(":")
    name = kind.strip().lower().replace("-", "")
    if name not in hashlib.algorithms_available or not (made := hashlib.new(name)).digest_size:
        return
    made.update(data)
    if _digest_bytes(value.strip(), made.digest_size) != made.digest():
        raise ValueError(f"{headers.get('warc-record-id')}: the {kind} digest differs")


def payload_digest(record: Record) -> str | None:
    """SHA-256 of the payload as hex digits; of a revisit as its header says it, and with the algorithm's name if that is another."""
    kind, _, value = record.headers.get("warc-payload-digest", "").partition(":")
    if kind.lower().replace("-", "") == "sha256" and (found := _digest_bytes(value.strip(), 32)) is not None:
        return found.hex()
    return hashlib.sha256(record.payload).hexdigest() if record.kind == "response" else f"{kind}:{value}" if value else None


def read_records(content: bytes | Iterable[bytes]) -> Iterator[Record]:
    """Records of an archive, one at a time, from its bytes or from chunks of them as they come."""
    if isinstance(content, bytes):
        view = memoryview(content)
        content = (bytes(view[i : i + CHUNK]) for i in range(0, len(view), CHUNK))
    return map(parse, members(content))


def chunks_of(path: str) -> Iterator[bytes]:
    """A file as a stream of chunks, from any store that pyarrow knows."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as stream:
        while chunk := stream.read(CHUNK):
            yield chunk


def revisits(pages: DataFrame, least_bytes: int = 100, id_column: str = "page_id", payload_column: str = "html") -> DataFrame:
    """(id, digest, refers_to) of the rows whose payload, of ``least_bytes`` at least, a row with a smaller id has too.

    A null payload is empty and thus too short.  Repeated rows count once; a row with
    a null id may revisit another but is never referred to, unless all have null ids,
    when none does.  An empty table gives an empty result.
    """
    sums = stored(pages.select(F.col(id_column).alias("__id"), F.sha2(F.coalesce(F.col(payload_column), F.lit("")).cast("binary"), 256).alias("__digest"), F.octet_length(payload_column).alias("n")).filter(F.col("n") >= least_bytes).select("__id", "__digest"))
    first = stored(sums.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("__digest", "__first"))
    return sums.join(first, "__digest").filter(~F.col("__id").eqNullSafe(F.col("__first"))).select("__id", "__digest", "__first").distinct()


def _warcinfo(name: str, date: str) -> bytes:
    return record_bytes("warcinfo", f"urn:archive:{name}", date, b"format: WARC File Format 1.1\r\n", "application/warc-fields", [("WARC-Filename", name)])


def _rows(pages: DataFrame, least_bytes: int, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    """(id, url, refers_to, payload) of what is to be written."""
    again = stored(revisits(pages, least_bytes, id_column, payload_column))
    few = again.count() <= BROADCAST_ROWS
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.coalesce(F.col(payload_column), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(rows.payload.cast("binary"), 256))
    rows = rows.join(F.broadcast(again) if few else again, rows.id.eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    return rows.select(F.col("id").cast("string").alias("id"), "url", F.col("__first").cast("string").alias("refers_to"), "payload")


def _records(part: pa.RecordBatch, payloads: list[str], date: str) -> Iterator[bytes]:
    for page, url, refers_to, payload in zip(*(part.column(c).to_pylist() for c in ("id", "url", "refers_to")), payloads):
        yield page_record(page, url, payload.encode(), refers_to, date)


def write_files(pages: DataFrame, folder: str, least_bytes: int = 100, archive_bytes: int = 64 << 20, date: str = "2000-01-01T00:00:00Z", id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Writes ``.warc.gz`` files of about ``archive_bytes`` each into ``folder``, a URI that pyarrow knows, and returns their paths (path, bytes).

    A record per row of ``pages``; a null payload is empty.  Rows with one id and one
    payload are all responses if the id is the smallest that has it.  Other columns are
    ignored, null urls written as urn:none.  A file appears under its name when it is
    whole, and a task that runs again writes the same files; without rows there are none.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top)
        number, out, name, hidden, size = 0, None, "", "", 0

        def close() -> pa.RecordBatch:
            out.close()
            store.move(hidden, f"{top}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64())], names=["path", "bytes"])

        for part, payloads in text_blocks(batches, "payload"):
            for record in _records(part, payloads, date):
                if out is None:
                    name = f"pages-{task.partitionId() if task else 0:05d}-{number:05d}.warc.gz"
                    hidden = f"{top}/.{name}.{uuid.uuid4().hex}"
                    out, number = store.open_output_stream(hidden, compression=None), number + 1
                    info = _warcinfo(name, date)
                    out.write(info)
                    size = len(info)
                out.write(record)
                size += len(record)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stored(_rows(pages, least_bytes, id_column, url_column, payload_column).mapInArrow(run, "path string, bytes bigint"))


def write_archives(pages: DataFrame, least_bytes: int = 100, archive_bytes: int = 8 << 20, date: str = "2000-01-01T00:00:00Z", id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """As ``write_files``, but (archive, content) as rows, as ``binaryFile`` would read the files: for stores that only Spark reaches."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for i, (part, payloads) in enumerate(text_blocks(batches, "payload", archive_bytes)):
            name = f"pages-{task.partitionId() if task else 0:05d}-{i:05d}.warc.gz"
            content = b"".join([_warcinfo(name, date), *_records(part, payloads, date)])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["archive", "content"])

    return _rows(pages, least_bytes, id_column, url_column, payload_column).mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, content_column: str = "content", payloads: bool = False) -> DataFrame:
    """One row per response or revisit record: page (string), url, payload_bytes, payload_digest, record_type, refers_to (string), and with ``payloads`` payload (binary).

    ``content_column`` holds archives (binary, as ``binaryFile`` reads them) or the
    paths of files, which are read as streams.  Records of other writers keep their
    ids; digests are hex or base32; a revisit that doesn't say how long its payload
    is has null payload_bytes.  A record that is cut short, framed wrongly or fails a
    digest raises.  An empty archive gives no rows.
    """
    ship(archives.sparkSession)
    by_path = archives.schema[content_column].dataType.simpleString() == "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.schema([("page", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), *([("payload", pa.binary())] if payloads else [])])

        def batch_of_rows(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), names)], schema=names)

        for batch in batches:
            for i in range(batch.num_rows):
                content, rows, held = batch.column(0)[i].as_py(), [], 0
                for r in read_records(chunks_of(content) if by_path else content):
                    if r.kind not in ("response", "revisit"):
                        continue
                    length = r.http.get("content-length", "")
                    size = len(r.payload) if r.kind == "response" else int(length) if length.isdigit() else None
                    rows.append((page_of(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), size, payload_digest(r), r.kind, page_of(r.headers.get("warc-refers-to")), *([r.payload] if payloads else [])))
                    held += len(r.payload) if payloads else 256
                    if held > 1 << 20:
                        yield batch_of_rows(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of_rows(rows)

    schema = "page string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + ", payload binary" * payloads
    return archives.select(content_column).mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_column: str = "page_id", **options) -> DataFrame:
    """Writes ``.warc.gz`` files to the shared folder and reads them back as streams: id, payload_bytes, payload_digest, record_type, refers_to.

    One row per row of ``pages``, repeated rows and null ids too; an empty table gives
    an empty result.  Where pyarrow doesn't know the shared folder's store, the
    archives are rows of a table in it.
    """
    kind = pages.schema[id_column].dataType
    folder = f"{shared_folder(pages.sparkSession)}/jobloom-warc-{uuid.uuid4().hex}"
    try:
        fs.FileSystem.from_uri(folder)
    except (ValueError, OSError, ImportError):
        archives, column = stored(write_archives(pages, id_column=id_column, **options)), "content"
    else:
        archives, column = write_files(pages, folder, id_column=id_column, **options).repartition(max(1, pages.sparkSession.sparkContext.defaultParallelism)), "path"
    found = read_archives(archives, column)
    return found.select(F.col("page").cast(kind).alias(id_column), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
