"""WARC archives with a two-level capture index.

Pages are sorted by reversed-host URL key and page id. Each write task puts
its range into WARC files (one gzip member a record) and into one index
file: the captures in sorted order, in compressed blocks, then a sparse
directory with the first key of each block. One row per index file, its
first key, comes back to Spark; that table names the files that count, so
files of a task that failed or ran twice are never read.

To read a capture, its key is looked up by binary search among the index
files, then in the directory of one, then in one block, and one range of
one archive is read.

Files are written and read through ``pyarrow.fs`` from the URI of a folder
that all executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import staged
from pluvio.session import work_path

REVISIT_BYTES = 1000  # smaller payloads are always stored
BLOCK_ENTRIES = 512
ARCHIVE_BYTES = 1 << 30
#: Duplicate groups up to so many rows (under 1 KB each) are broadcast.
BROADCAST_GROUPS = 20_000
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = -(1 << 63) - 1  # sorts before every id, as null does

_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"


def url_key(url: Column) -> Column:
    """Reversed lower-case host, ``)``, path and query: ``com,example)/a?b``.
    A URL without a host is its own key; null is the empty key."""
    host, rest = F.lower(F.regexp_extract(url, _URL, 1)), F.regexp_extract(url, _URL, 2)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    key = F.concat(reversed_host, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))
    return F.coalesce(F.when(host == "", url).otherwise(key), F.lit(""))


# --- one record -----------------------------------------------------------

def _field(value: str) -> str:
    """A header value: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    found = record_id[len("<urn:page:"):-1]
    return None if found == "none" else int(found)


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str,
           refers: tuple[int | None, str | None] | None) -> bytes:
    """A gzip member: a response, or with ``refers`` a revisit of that page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)),
               ("WARC-Date", DATE), ("WARC-Target-URI", _field(url or "about:blank")),
               ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", payload_digest)]
    block = http.encode()
    if refers is None:
        block += payload
    else:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers[0])),
                    ("WARC-Refers-To-Target-URI", _field(refers[1] or "about:blank"))]
    return _member(headers, block)


def parse(member: bytes) -> dict:
    """A record read back, its payload checked against its digest."""
    content = gzip.decompress(member)
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    kind = headers["WARC-Type"]
    if kind == "response" and _digest(payload) != headers["WARC-Payload-Digest"]:
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return {"page_id": _page_id(headers["WARC-Record-ID"]), "record_type": kind,
            "payload_bytes": int(stated["Content-Length"]),
            "payload_digest": base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex(),
            "refers_to": _page_id(headers["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


# --- files ----------------------------------------------------------------

def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    local = re.match(r"(?:file:/{0,2})?(/.*)", uri)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(uri)


class _IndexWriter:
    """Compressed blocks of sorted captures, then the directory of their first keys."""

    def __init__(self, stream) -> None:
        self._stream, self._at, self._entries, self.directory = stream, 0, [], []

    def add(self, entry: list) -> None:
        self._entries.append(entry)
        if len(self._entries) >= BLOCK_ENTRIES:
            self._flush()

    def _put(self, made: list) -> tuple[int, int]:
        block = zstandard.compress("\n".join(json.dumps(x) for x in made).encode())
        self._stream.write(block)
        at, self._at = self._at, self._at + len(block)
        return at, len(block)

    def _flush(self) -> None:
        if self._entries:
            first = self._entries[0]
            self.directory.append([first[0], first[1], *self._put(self._entries)])
            self._entries = []

    def close(self) -> None:
        self._flush()
        at, length = self._put(self.directory)
        self._stream.write(f"{at:020d}{length:020d}".encode())
        self._stream.close()


def _unpacked(block: bytes) -> list[list]:
    return [json.loads(line) for line in zstandard.decompress(block).decode().split("\n")]


def _order(entry) -> tuple[str, int]:
    return entry[0], NO_ID if entry[1] is None else entry[1]


class _Index:
    """Binary search over index files, the last directory and block kept open."""

    def __init__(self, parts: list[tuple]) -> None:
        self._parts = parts  # first key, first page id, path; sorted
        self._firsts = [_order(p) for p in parts]
        self._open: tuple | None = None
        self._block: tuple | None = None

    def _directory(self, part: int) -> tuple:
        if self._open is None or self._open[0] != part:
            store, path = open_store(self._parts[part][2])
            file = store.open_input_file(path)
            size = file.size()
            trailer = file.read_at(40, size - 40)
            rows = _unpacked(file.read_at(int(trailer[20:]), int(trailer[:20])))
            self._open, self._block = (part, file, rows, [_order(r) for r in rows]), None
        return self._open

    def _entries(self, part: int, block: int) -> list[list]:
        if self._block is None or self._block[0] != (part, block):
            _, file, rows, _ = self._directory(part)
            self._block = ((part, block), _unpacked(file.read_at(rows[block][3], rows[block][2])))
        return self._block[1]

    def part_path(self) -> str:
        """The index file of the capture found last."""
        return self._parts[self._open[0]][2]

    def find(self, key: str, page_id: int | None) -> Iterator[list]:
        """All captures of the key and page; equal ones may go on in the next block or file."""
        target = _order((key, page_id))
        part = max(0, bisect_left(self._firsts, target) - 1)
        while part < len(self._parts) and self._firsts[part] <= target:
            firsts = self._directory(part)[3]
            block = max(0, bisect_left(firsts, target) - 1)
            while block < len(firsts) and firsts[block] <= target:
                entries = self._entries(part, block)
                at = bisect_left(entries, target, key=_order)
                while at < len(entries) and _order(entries[at]) == target:
                    yield entries[at]
                    at += 1
                block += 1
            part += 1


# --- operators ------------------------------------------------------------

def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the
    index files: (first_key, first_page_id, path, captures).

    The payload is the html in UTF-8, null counting as empty. Of rows with
    equal payloads of at least 1000 bytes, that with the largest id is the
    response and the others revisit it; rows that share the largest id are
    all responses, and a null id is smaller than any other. Other columns
    are not archived. An empty table writes nothing.
    """
    folder = folder or work_path(pages.sparkSession, "llm", "warc", unique=True)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "*", url_key(F.col("url")).alias("key"), F.sha2("payload", 256).alias("same"))
    large = staged(rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("key", "page_id", "url", "same"), "large")
    groups = staged(large.groupBy("same").agg(
        F.max(F.struct("page_id", "url")).alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"), "originals")
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    revisits = large.join(groups, "same").where("not page_id <=> original.page_id")
    # what a record revisits is a narrow row of its own, sorted before it: payloads move once, to be sorted
    null = lambda kind: F.lit(None).cast(kind)
    ready = rows.select("key", "page_id", F.lit(True).alias("is_page"), "same", "url", null("long").alias("original_id"),
                        null("string").alias("original_url"), "payload").unionByName(revisits.select(
                            "key", "page_id", F.lit(False).alias("is_page"), "same", null("string").alias("url"),
                            F.col("original.page_id").alias("original_id"), F.col("original.url").alias("original_url"),
                            null("binary").alias("payload")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        task = TaskContext.get()
        name = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        index = archive = first = place = None
        at = captures = files = 0
        revisited: dict[str, tuple] = {}
        for b in batches:
            for key, page_id, is_page, same, url, original_id, original_url, content in zip(
                    *(b.column(i) for i in range(8))):
                key, page_id, same = key.as_py(), page_id.as_py(), same.as_py()
                if place != (key, page_id):
                    place, revisited = (key, page_id), {}
                if not is_page.as_py():
                    revisited[same] = original_id.as_py(), original_url.as_py()
                    continue
                content = content.as_py()
                if index is None:
                    store.create_dir(base, recursive=True)
                    index, first = _IndexWriter(store.open_output_stream(f"{name}.idx", compression=None)), (key, page_id)
                if archive is None or at >= ARCHIVE_BYTES:
                    if archive is not None:
                        archive.close()
                    path, files = f"{name}-{files}.warc.gz", files + 1
                    archive = store.open_output_stream(path, compression=None)
                    info = _member([("WARC-Type", "warcinfo"), ("WARC-Date", DATE),
                                    ("WARC-Record-ID", f"<urn:file:{_field(path)}>"),
                                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    archive.write(info)
                    at = len(info)
                made = record(page_id, url.as_py(), content, _digest(content), revisited.get(same))
                archive.write(made)
                index.add([key, page_id, files - 1, at, len(made)])
                at, captures = at + len(made), captures + 1
        if index is not None:
            archive.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"first_key": first[0], "first_page_id": first[1], "path": f"{folder}{name[len(base):]}.idx",
                  "captures": captures}],
                pa.schema([("first_key", pa.string()), ("first_page_id", pa.int64()), ("path", pa.string()),
                           ("captures", pa.int64())]))

    order = ["key", "page_id"]
    written = (ready.repartitionByRange(*order).sortWithinPartitions(*order, "is_page")
               .mapInArrow(work, "first_key string, first_page_id long, path string, captures long"))
    return staged(written, "index")


RECORD = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read(captures: DataFrame, index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the distinct (url, page_id) of ``captures``, looked up
    in ``index`` (from :func:`write`) and read from the archives: page_id,
    record_type, payload_bytes, payload_digest (hex SHA-1), refers_to, and
    the payload of responses. A capture that was written twice gives two
    rows, one that was not written gives none.
    """
    # one row per write task, so bounded by the number of tasks, not by the pages
    parts = sorted(((r["first_key"], r["first_page_id"], r["path"]) for r in index.collect()), key=_order)
    wanted = captures.select(url_key(F.col("url")).alias("key"),
                             F.col("page_id").cast("long").alias("page_id")).distinct()
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    keep = with_payload

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, archive, opened = _Index(parts), None, None
        for b in batches:
            found, size = [], 0
            for key, page_id in zip(b["key"].to_pylist(), b["page_id"].to_pylist()):
                for entry in search.find(key, page_id):
                    part = search.part_path()
                    path = f"{part[:-len('.idx')]}-{entry[2]}.warc.gz"
                    if path != opened:
                        store, at = open_store(path)
                        archive, opened = store.open_input_file(at), path
                    made = parse(archive.read_at(entry[4], entry[3]))
                    if not keep:
                        made["payload"] = None
                    found.append(made)
                    size += len(made["payload"] or b"")
                    if size > 1 << 24 or len(found) >= 2000:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
            if found:
                yield pa.RecordBatch.from_pylist(found, schema)

    # as many tasks as index files: the keys are few bytes, what they make a task read is not
    order = ["key", "page_id"]
    return wanted.repartitionByRange(max(1, len(parts)), *order).sortWithinPartitions(*order).mapInArrow(work, RECORD)
