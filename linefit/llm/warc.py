"""Web archives (WARC 1.1, one gzip member per record), written with their index and read by it.

Every task writes its pages' records to an archive in the shared folder and returns the index
first: path, offset, length, URL and digest of each record. A reader takes the index rows it
wants, deals them by archive and stretch, sorts them by offset and joins neighbouring ranges
into one read. Only archives that the index names count, so what failed attempts have left is
never read.

Of the pages with one payload of at least ``SHARED`` bytes, the one with the largest id is
written as a response and the others as revisits that refer to it; smaller pages are all
responses. Null payloads count as empty, null URLs as ``urn:page:<id>``. Rows with a null or
repeated id are written like others; a payload's response is then one row with the largest id.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import pieces_of, salted_lookup, staged
from linefit.llm.files import open_store
from linefit.sources.staging import new_path, remove_at_exit

SHARED = 1000
#: Ranges this near are read in one go, and a reader's task gets stretches of about this size.
GAP, STRETCH = 64 << 10, 8 << 20
#: Bytes after which a task begins another archive.
ARCHIVE = 256 << 20
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _safe(value: str) -> str:
    """A header value on one line: control characters and spaces as %XX."""
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_of(page: int | None, url: str | None, payload: bytes, refers: int | None) -> tuple[bytes, str]:
    """A record's bytes (one gzip member) and the URL it has."""
    digest = hashlib.sha1(payload).digest()
    target = _safe(url) if url else f"urn:page:{page}"
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers is None else http
    headers = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{target}')}>",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"X-Page-ID: {'' if page is None else page}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
    ]
    if refers is not None:
        headers += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page: {refers}"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(data, 1, mtime=0), target


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's own headers, its HTTP headers and its payload."""
    data = zlib.decompress(member, 31)
    head, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return headers, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def write(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", shared: int = SHARED
) -> DataFrame:
    """The index of the archives written: page, path, offset, length, url, digest, record_type."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    )
    marked = rows.select("page", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    known, _ = staged(marked.where(F.col("size") >= shared), "payloads")
    groups = known.groupBy("digest").agg(F.max("page").alias("refers"), F.count("*").alias("n")).where("n > 1")
    revisits = salted_lookup(known.select("digest", "page"), "digest", groups.select("digest", "refers"), F.col("page"))
    revisits = revisits.where("refers is not null and page < refers").select("page", "refers").distinct()
    folder = new_path(spark, "warc")
    remove_at_exit(spark, folder)

    def write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, name, offset = None, None, 0
        try:
            for batch in pieces_of(batches, "payload"):
                index = []
                for page, url_, payload, refers in zip(*(
                    batch.column(c).to_pylist() for c in ("page", "url", "payload", "refers")
                )):
                    if out is None or offset > ARCHIVE:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data, target = record_of(page, url_, payload, refers)
                    out.write(data)
                    index.append((
                        page, f"{folder}/{name}", offset, len(data), target,
                        hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit",
                    ))
                    offset += len(data)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*index), kinds)],
                    ["page", "path", "offset", "length", "url", "digest", "record_type"],
                )
        finally:
            if out is not None:
                out.close()

    joined = rows.join(revisits, "page", "left").select("page", "url", "payload", "refers")
    return staged(
        joined.mapInArrow(
            write_records, "page long, path string, offset long, length long, url string, digest string, "
            "record_type string",
        ), "warc-index",
    )[0]


def read(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` selects: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url (and the payload, null for revisits).
    """
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None)

        def members(path: str, spans: list[tuple[int, int]]) -> Iterator[bytes]:
            nonlocal opened
            if opened[0] != path:
                if opened[1] is not None:
                    opened[1].close()
                store, place = open_store(path)
                opened = (path, store.open_input_file(place))
            first, last = spans[0][0], sum(spans[-1])
            data = opened[1].read_at(last - first, first)
            for offset, length in spans:
                yield data[offset - first : offset - first + length]

        def rows_of(found: list[bytes]) -> pa.RecordBatch:
            out = []
            for member in found:
                headers, http, payload = parse(member)
                kind = headers["WARC-Type"]
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
                if kind == "response" and hashlib.sha1(payload).digest() != digest:
                    raise ValueError(f"page {headers['X-Page-ID']} is damaged")
                refers, page = headers.get("X-Refers-To-Page"), headers["X-Page-ID"]
                out.append((
                    int(page) if page else None, int(http["Content-Length"]), digest.hex(), kind,
                    refers and int(refers), headers["WARC-Target-URI"],
                    payload if with_payload and kind == "response" else None,
                ))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(x, k) for x, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns[: 7 if with_payload else 6], names)

        path_now, spans = None, []
        for batch in batches:
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if spans and (path != path_now or not 0 <= offset - sum(spans[-1]) <= GAP
                              or sum(spans[-1]) - spans[0][0] > STRETCH):
                    yield rows_of(list(members(path_now, spans)))
                    spans = []
                path_now = path
                spans.append((offset, length))
        if spans:
            yield rows_of(list(members(path_now, spans)))
        if opened[1] is not None:
            opened[1].close()

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    if with_payload:
        names, schema = [*names, "payload"], schema + ", payload binary"
    stretch = F.floor(F.col("offset") / STRETCH).alias("stretch")
    dealt = index.select("path", "offset", "length", stretch).repartition("path", "stretch")
    return dealt.sortWithinPartitions("path", "offset").mapInArrow(fetch, schema)
