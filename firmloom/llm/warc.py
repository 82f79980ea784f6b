"""WARC archives with a two-level capture index.

Tasks write gzip-member WARC files into the shared folder and report where each
record lies.  The reports, sorted by reversed-host URL key, become index
shards: blocks of compressed lines, and a sparse directory with the first key
of each block.  A lookup picks the shard by its key range, the block by binary
search in the directory, the line by binary search in the block, and then reads
just the record's bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmloom.llm.common import BROADCAST_ROWS, stored, table
from firmloom.session import ensure_checkpoint_dir, map_frames
from firmloom.skew import lookup_join

#: Payloads of at least so many bytes are stored once and revisited after.
MIN_PAYLOAD = 0
#: A new archive file begins after so many bytes.
FILE_BYTES = 128_000_000
BLOCK_LINES = 500
#: Rows of one payload that are still dealt out by its digest.
HOT_PAYLOADS = 10_000
#: Key ranges of the index; their first keys are all that the driver ever holds.
MAX_SHARDS = 2000
#: Stands in every record that has no date of its own.
EPOCH = "1970-01-01T00:00:00Z"
CRLF = b"\r\n"


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``http://a.b.com/x?y`` is ``com,b,a)/x?y``; empty for null, the text itself if it has no host."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        host, port = "", None
    if not host:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){parts.path or '/'}{query}"


#: Control characters as they are written in keys and headers, where some of them part fields and lines.
ESCAPES = {c: f"%{c:02X}" for c in (*range(32), 127)}


def capture_key(url: str | None, ident) -> str:
    """Sort key of one capture: URL key with escaped control characters, a tab, and the record's id."""
    return f"{url_key(url).translate(ESCAPES)}\t{'' if pd.isna(ident) else int(ident)}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(ident, url: str | None, payload: bytes, first, date: str = EPOCH) -> bytes:
    """A response record, or a revisit record if ``first`` (the id of the response with this payload) is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    name = "none" if pd.isna(ident) else int(ident)
    body = http if first is not None else http + payload
    target = (url or "").translate(ESCAPES)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:record:{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:record:{int(first)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return CRLF.join(h.encode() for h in head) + CRLF * 2 + body + CRLF * 2


@dataclass
class Record:
    headers: dict[str, str]
    payload: bytes
    payload_bytes: int

    @property
    def page_id(self) -> int | None:
        return _number(self.headers["WARC-Record-ID"])

    @property
    def refers_to(self) -> int | None:
        return _number(self.headers.get("WARC-Refers-To", ""))


def _number(urn: str) -> int | None:
    last = urn.strip("<>").rpartition(":")[2]
    return int(last) if last.lstrip("-").isdigit() else None


def parse_record(raw: bytes) -> Record:
    """One record; its payload's length is what the HTTP head says, also where a revisit leaves the payload out."""
    head, _, rest = raw.partition(CRLF * 2)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    body = rest[: int(headers["Content-Length"])]
    http, _, payload = body.partition(CRLF * 2)
    said = next(int(line[15:]) for line in http.split(CRLF) if line.startswith(b"Content-Length:"))
    return Record(headers, payload, said)


def _filesystem(path: str):
    """File system and path for any URI that Arrow can open (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _zip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archive(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder``; (key, file, offset, size) of each.

    Equal payloads: the smallest page_id is the response, the others revisit it;
    payloads under ``min_payload`` bytes are all responses, and so are rows
    without a page_id where all their kind have none.  A null html is an empty
    payload.  A retried task writes a file of its own, and only the successful
    one is reported.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    again = rows.where(F.octet_length("html") >= min_payload).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = stored(again.where("n > 1 AND first IS NOT NULL").select("sha", "first"))
    if again.count() <= BROADCAST_ROWS:
        known = rows.join(F.broadcast(again), "sha", "left")
    else:  # empty and error pages are hot keys
        known = lookup_join(rows, again, "sha", F.concat("sha", F.coalesce(F.col("page_id").cast("string"), "url", F.lit(""))), HOT_PAYLOADS)
    known = known.select("page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        sink, name, at = None, "", 0
        try:
            for f in frames:
                entries = []
                for ident, url, html, first in zip(f["page_id"], f["url"], f["html"], f["first"], strict=True):
                    if sink is None or at >= FILE_BYTES:
                        if sink:
                            sink.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    data = _zip(make_record(ident, url, html.encode(), None if pd.isna(first) else first))
                    sink.write(data)
                    entries.append((capture_key(url, ident), name, at, len(data)))
                    at += len(data)
                yield pd.DataFrame(entries, columns=["key", "file", "offset", "size"])
        finally:
            if sink:
                sink.close()

    return stored(map_frames(known, run, "key string, file string, offset long, size long"))


def write_index(entries: DataFrame, folder: str, shards: int | None = None) -> list[tuple[str, str]]:
    """Write index shards under ``folder``; (first key, name) of each, in key order.

    Sorting by key and place spreads even one URL with very many captures.
    """
    spark = entries.sparkSession
    n = min(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_SHARDS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _filesystem(folder)
        name, first, at = uuid.uuid4().hex, None, 0
        lines: list[str] = []
        directory: list[str] = []
        with io.BytesIO() as held:

            def flush(sink) -> int:
                data = zlib.compress("\n".join(lines).encode(), 6)
                sink.write(data)
                directory.append("\x1f".join((lines[0].split("\x1f", 1)[0], str(at), str(len(data)))))
                lines.clear()
                return at + len(data)

            sink = None
            for f in frames:
                for key, file, offset, size in f.itertuples(index=False):
                    if sink is None:
                        system.create_dir(base, recursive=True)
                        sink, first = system.open_output_stream(f"{base}/{name}.blocks", compression=None), key
                    lines.append(f"{key}\x1f{file}\x1f{offset}\x1f{size}")
                    if len(lines) >= BLOCK_LINES:
                        at = flush(sink)
            if sink is None:
                return
            if lines:
                at = flush(sink)
            sink.close()
            held.write("\n".join(directory).encode())
            with system.open_output_stream(f"{base}/{name}.directory", compression=None) as out:
                out.write(held.getvalue())
        yield pd.DataFrame({"first": [first], "name": [name]})

    ordered = entries.repartitionByRange(n, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    made = stored(map_frames(ordered, run, "first string, name string"))
    return sorted((r[0], r[1]) for r in made.collect())  # at most MAX_SHARDS rows


class CaptureIndex:
    """Reads an index and its archives; keeps one block and a few open files."""

    OPEN_FILES = 32

    def __init__(self, index: str, archive: str, shards: list[tuple[str, str]]):
        self.index, self.archive = index, archive
        self.firsts, self.names = [s[0].encode() for s in shards], [s[1] for s in shards]
        self.directories: OrderedDict[str, tuple] = OrderedDict()
        self.files: OrderedDict[str, object] = OrderedDict()
        self.block: tuple[tuple[str, int], list] | None = None

    def _open(self, path: str):
        if path not in self.files:
            if len(self.files) >= self.OPEN_FILES:
                self.files.popitem(last=False)[1].close()
            system, inner = _filesystem(path)
            self.files[path] = system.open_input_file(inner)
        self.files.move_to_end(path)
        return self.files[path]

    def _directory(self, name: str) -> tuple[list[bytes], list[tuple[int, int]]]:
        if name not in self.directories:
            if len(self.directories) >= self.OPEN_FILES:
                self.directories.popitem(last=False)
            lines = [line.split(b"\x1f") for line in self._open(f"{self.index}/{name}.directory").read().split(b"\n")]
            self.directories[name] = [x[0] for x in lines], [(int(x[1]), int(x[2])) for x in lines]
        return self.directories[name]

    def _lines(self, name: str, number: int) -> tuple[list[bytes], list[list[bytes]]]:
        if not self.block or self.block[0] != (name, number):
            offset, size = self._directory(name)[1][number]
            raw = zlib.decompress(self._open(f"{self.index}/{name}.blocks").read_at(size, offset))
            rows = [line.split(b"\x1f") for line in raw.split(b"\n")]
            self.block = (name, number), ([r[0] for r in rows], rows)
        return self.block[1]

    def shard_of(self, key: str) -> int:
        """First shard that can hold ``key`` (its captures may go on in the next ones)."""
        return max(bisect_left(self.firsts, key.encode()) - 1, 0)

    def find(self, key: str, exact: bool = True) -> Iterator[tuple[str, int, int]]:
        """(file, offset, size) of all captures with this key, or whose key begins with it."""
        wanted = key.encode()
        for s in range(self.shard_of(key), len(self.names)):
            firsts, _ = self._directory(self.names[s])
            for b in range(max(bisect_left(firsts, wanted) - 1, 0), len(firsts)):
                keys, rows = self._lines(self.names[s], b)
                for i in range(bisect_left(keys, wanted), len(keys)):
                    if keys[i] != wanted if exact else not keys[i].startswith(wanted):
                        return
                    yield rows[i][1].decode(), int(rows[i][2]), int(rows[i][3])

    def captures(self, url: str) -> Iterator[Record]:
        """All records of a URL."""
        for place in self.find(capture_key(url, None), exact=False):  # the key ends with the tab before the id
            yield self.read(*place)

    def read(self, file: str, offset: int, size: int) -> Record:
        raw = self._open(f"{self.archive}/{file}").read_at(size, offset)
        return parse_record(zlib.decompress(raw, 31))


def look_up(keys: DataFrame, index: CaptureIndex) -> DataFrame:
    """The records of ``keys`` (key string, distinct): read range by range, each task its own part of the index.

    A key that the index doesn't hold ends the query: nothing is left out silently.
    """
    place = index.index, index.archive, list(zip([f.decode() for f in index.firsts], index.names, strict=True))
    firsts = index.firsts

    def shard(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"key": f["key"], "shard": [max(bisect_right(firsts, k.encode()) - 1, 0) for k in f["key"]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = CaptureIndex(*place)
        for f in frames:
            out = []
            for key in f["key"]:
                places = list(opened.find(key))
                if not places:
                    raise KeyError(f"no capture of {key!r}")
                for where in places:
                    r = opened.read(*where)
                    kind = r.headers["WARC-Type"]
                    digest = payload_digest(r.payload) if kind == "response" else r.headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    out.append((r.page_id, r.payload_bytes if kind == "revisit" else len(r.payload), digest, kind, r.refers_to, r.headers.get("WARC-Target-URI"), where[0], where[1], where[2]))
            rows = pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target", "file", "offset", "size"])
            yield rows.astype({"page_id": "Int64", "refers_to": "Int64"})

    placed = map_frames(keys.select("key"), shard, "key string, shard int").repartition(max(len(index.names), 1), "shard").sortWithinPartitions("shard", "key")
    return map_frames(placed, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string, file string, offset long, size long")


def archive_pages(pages: DataFrame, folder: str | None = None, min_payload: int = MIN_PAYLOAD) -> tuple[CaptureIndex, DataFrame]:
    """Write archives and index for ``pages``; the opened index and the keys of all captures."""
    folder = folder or f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    entries = write_archive(pages, f"{folder}/archive", min_payload)
    return CaptureIndex(f"{folder}/index", f"{folder}/archive", write_index(entries, f"{folder}/index")), entries


def capture_keys(pages: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"key": [capture_key(u, i) for u, i in zip(f["url"], f["page_id"], strict=True)]})

    return map_frames(pages.select("page_id", "url"), run, "key string").distinct()


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, then read each back by its URL through the index.

    Empty tables give no rows; repeated rows are repeated records; a null url
    has the empty key, control characters of a url are escaped.  Long pages are
    one record each.  Other columns play no part, whatever their names.
    """
    pages = table(spark, sf_dir, "pages")
    index, _ = archive_pages(pages)
    return look_up(capture_keys(pages), index)
