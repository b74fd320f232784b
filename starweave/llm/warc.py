"""WARC archives: writing, normalising whole-file gzip to one member a record, reading."""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch

#: Payloads of at least so many bytes are written once; equal ones refer to the first.
REVISIT_BYTES = 100
#: Uncompressed bytes after which a task starts another archive.
ROLL_BYTES = 256 << 20
CHUNK = 1 << 20
#: Bytes of an archive that a reader fetches at a time.
FETCH = 8 << 20
GZIP = 31  # zlib's number for gzip framing
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(value: str) -> str:
    """A header value on one line: control characters and blanks are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit holds the HTTP header only, and its payload's size."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page is not None:
        head.append(f"X-Page-ID: {quote(page, safe='')}")
    if refers_to is not None:
        head.append(f"WARC-Profile: {PROFILE}")
        head.append(f"X-Refers-To-Page-ID: {quote(refers_to, safe='')}")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and the rest of the block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(head), payload


def _headers(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def inflated(stream) -> Iterator[bytes]:
    """Chunks of a gzip stream of one or more members."""
    unzip, rest = zlib.decompressobj(GZIP), b""
    while data := rest or stream.read(CHUNK):
        rest = b""
        if out := unzip.decompress(bytes(data), CHUNK):
            yield out
        while unzip.unconsumed_tail:
            yield unzip.decompress(unzip.unconsumed_tail, CHUNK)
        if unzip.eof:
            rest, unzip = unzip.unused_data, zlib.decompressobj(GZIP)


def records(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The records of an inflated archive, one at a time in memory."""
    buffer, need, seen = bytearray(), 0, 0
    for chunk in chunks:
        buffer += chunk
        while True:
            if not need:
                end = buffer.find(b"\r\n\r\n", max(0, seen - 3))
                if end < 0:
                    seen = len(buffer)
                    break
                need = end + 8 + int(_headers(bytes(buffer[:end]))["content-length"])
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = seen = 0
    if buffer:
        raise ValueError("the archive ends within a record")


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write rows (page, url, html, digest, refers_to) to ``.warc.gz`` files, each one gzip
    stream, and return a row per file.

    A task that is tried again writes files of another name, and only the names that it
    returns count: what a failed try has left is never read.
    """

    def run(batches):
        where, path = _open(folder)
        where.create_dir(path, recursive=True)
        out = None
        names = []
        for batch in text.blocks(batches, "html"):
            rows = zip(
                *(batch.column(c).to_pylist() for c in ("page", "url", "digest", "refers_to")),
                text.encoded(batch.column("html")),
            )
            for page, url, digest, refers_to, payload in rows:
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = where.open_output_stream(f"{path}/{names[-1]}", compression=None)
                    zipped, size = zlib.compressobj(1, zlib.DEFLATED, GZIP), 0
                raw = record(page, url, payload, digest, refers_to)
                out.write(zipped.compress(raw))
                size += len(raw)
                if size >= ROLL_BYTES:
                    out.write(zipped.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(zipped.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    return pages.mapInArrow(run, "file string")


def normalise(files: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite archives so that each record is a gzip member of its own.

    A file's stream is inflated once, record by record; next to the new archive a sidecar
    of one JSON line a record is written. Returns the same index as rows: ``file``,
    ``offset``, ``length``. Tasks tried again write files of another name, as above.
    """

    def run(batches):
        come, at = _open(source)
        where, path = _open(folder)
        where.create_dir(path, recursive=True)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                new, offsets, lengths = f"{uuid.uuid4().hex}.warc.gz", [], []
                offset = 0
                with (
                    come.open_input_stream(f"{at}/{name}", compression=None) as stream,
                    where.open_output_stream(f"{path}/{new}", compression=None) as out,
                    where.open_output_stream(f"{path}/{new}.cdxj", compression=None) as sidecar,
                ):
                    for raw in records(inflated(stream)):
                        zipped = zlib.compressobj(4, zlib.DEFLATED, GZIP)
                        member = zipped.compress(raw) + zipped.flush()
                        out.write(member)
                        offsets.append(offset)
                        lengths.append(len(member))
                        warc = _headers(raw[: raw.index(b"\r\n\r\n")])
                        entry = {"id": warc["warc-record-id"], "url": warc.get("warc-target-uri"),
                                 "offset": offset, "length": len(member)}
                        sidecar.write((json.dumps(entry) + "\n").encode())
                        offset += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["file", "offset", "length"],
                )

    return files.mapInArrow(run, "file string, offset long, length long")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Rows of the records that an index names, each read at its offset.

    ``page`` (null without one), ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``. A response's digest and size are made from its payload and must agree
    with its headers, else an error is raised; a revisit's are those of its headers.
    """

    def run(batches):
        where, path = _open(folder)
        name, stream, begin, held = None, None, 0, b""
        for batch in batches:
            out = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if stream is not None:
                        stream.close()
                    stream, name, begin, held = where.open_input_file(f"{path}/{file}"), file, 0, b""
                if offset < begin or offset + length > begin + len(held):
                    stream.seek(offset)
                    begin, held = offset, stream.read(max(length, FETCH))
                raw = zlib.decompress(held[offset - begin : offset - begin + length], GZIP)
                warc, http, payload = parsed(raw)
                kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
                size = int(http["content-length"])
                if kind == "response":
                    made = sha256(payload).hexdigest()
                    if (made, len(payload)) != (digest, size):
                        raise ValueError(f"record at {offset} of {file} is damaged")
                page, other = (warc.get(f"x-{n}page-id") for n in ("", "refers-to-"))
                out.append((page and unquote(page), size, digest, kind, other and unquote(other)))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["page", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )
        if stream is not None:
            stream.close()

    return index.mapInArrow(
        run, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )


def archive(pages: DataFrame, scratch: Scratch | None = None, least: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages to archives, normalise these, and read every record back.

    Of pages with equal payloads of ``least`` bytes or more, the one with the smallest id
    is a response and the others are revisits that refer to it. A null id is larger than
    all others and refers or is referred to by no id, so such pages are all responses;
    rows that repeat the smallest id are responses too. Null html is an empty payload,
    a null url is left out. Returns a row per page, with its id as text (``page``,
    ``refers_to``).
    """
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha2(html, 256).alias("digest"),
    )
    large = F.octet_length("html") >= least
    # Payloads that several pages have: what is joined back is small unless copies abound.
    first = scratch.keep(
        rows.filter(large & F.col("page_id").isNotNull())
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"))
        .filter("_first <> _last")
        .drop("_last"),
        "first",
    )
    revisit = F.when(F.col("page_id") != F.col("_first"), F.col("_first").cast("string"))
    marked = rows.join(first, F.col("digest") == F.col("_digest"), "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "html", "digest", revisit.alias("refers_to")
    )
    whole, single = f"{scratch.path}/whole", f"{scratch.path}/archives"
    files = scratch.keep(write_archives(marked, whole), "files")
    spread = files.repartition(max(1, files.count()))
    index = scratch.keep(normalise(spread, whole, single), "index")
    scratch.drop("whole")
    return read_records(index, single)
