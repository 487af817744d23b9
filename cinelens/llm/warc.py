"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. The index sorts captures by
reversed-host URL key into compressed blocks; a sparse directory has the
first key and the place of every block. A lookup searches the directory, then
reads one block by its byte range, then the record by its own.

Files go to a folder that all executors share, through ``pyarrow.fs`` (local
paths, HDFS and object stores by URI). A task writes under a name of its own
attempt; the rows it returns name the files, so what a lost or repeated
attempt left behind is never read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections import OrderedDict
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import slices, staged

#: Payloads of fewer bytes are never revisits.
MIN_REVISIT = 100
#: Bytes after which a task begins a new archive, and lines of an index block.
ARCHIVE_BYTES = 64 << 20
BLOCK_LINES = 300
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """File system and path of a folder named by a URI or a local path."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", uri):
        return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return pa.fs.LocalFileSystem(), uri


def url_key(url: str | None) -> str:
    """Sort key: host labels reversed and joined by commas, a bracket, then the path; ``-`` without a host."""
    m = re.match(r"^[^:/?#]*://([^/?#]*)([^#]*)", url or "", re.S)
    if not m:
        return "-" + quote(url or "", safe="/?=&")
    host = m[1].rpartition("@")[2].lower()
    return quote(",".join(reversed(host.split("."))), safe=",:") + ")" + quote(m[2] or "/", safe="/?=&%")


def header(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def record(page_id, url, kind: str, digest: str, size: int, payload: bytes | None, refers_to, refers_url, date: str) -> bytes:
    """One WARC record: an HTTP response, or a revisit that names the capture with the same payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size)
    block = http + (payload if payload is not None else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>"),
              ("WARC-Date", date), ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%")),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", json.dumps(page_id)),
              ("X-Page-Url", quote(json.dumps(url)))]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{refers_to}')}>"),
                   ("WARC-Refers-To-Target-URI", quote(refers_url or "", safe=":/?#[]@!$&'()*+,;=%")),
                   ("X-Refers-To-Page-Id", json.dumps(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names lower-cased) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def _digests(batches):
    """Payload length, digest and gzip form of every page (what is shuffled is compressed)."""
    for batch in slices(batches, 64):
        rows = [(h or "").encode("utf-8", "surrogatepass") for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(r) for r in rows], pa.int64()),
             pa.array([hashlib.sha256(r).hexdigest() for r in rows]), pa.array([zlib.compress(r, 6) for r in rows], pa.binary())],
            names=["page_id", "url", "size", "digest", "packed"])


_CAPTURES = "key string, page_id long, row string, file string, offset long, length long"


def _write(folder: str, date: str):
    """Write archives; one row per record says where it lies."""

    def run(batches):
        fs, path = filesystem(folder)
        out, name, at = None, "", 0
        cols: list[list] = [[] for _ in range(6)]
        for batch in slices(batches, 256):
            for r in batch.to_pylist():
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{path}/archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(name, compression=None)
                payload = None if r["kind"] == "revisit" else zlib.decompress(r["packed"])
                member = gzip.compress(record(r["page_id"], r["url"], r["kind"], r["digest"], r["size"], payload,
                                              r["refers_to"], r["refers_url"], date), 6, mtime=0)
                out.write(member)
                for c, v in zip(cols, (url_key(r["url"]), r["page_id"], r["row"], name, at, len(member))):
                    c.append(v)
                at += len(member)
        if out is not None:
            out.close()
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        # the files are complete before any row names them
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=[x.split()[0] for x in _CAPTURES.split(", ")])
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages (page_id, url, html)``; returns the captures ``(key, page_id, row, file, offset, length)``.

    Of payloads that are equal and have at least ``MIN_REVISIT`` bytes, the
    one with the smallest page_id is a response and the others revisit it.
    The decision is a partial aggregate by digest, joined back on narrow
    rows; payloads move once, compressed.
    """
    rows = pages.select("page_id", "url", "html").mapInArrow(
        _digests, "page_id long, url string, size long, digest string, packed binary")
    named = rows.withColumn("row", F.concat_ws("-", F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                               F.xxhash64("digest", "url").cast("string")))
    dealt = staged(named, "warc-rows")
    narrow = dealt.where(F.col("size") >= MIN_REVISIT).select("digest", "page_id", "url")
    first = narrow.groupBy("digest").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "url")).alias("f"))
    first = first.where("c > 1").select("digest", F.col("f.page_id").alias("first_id"), F.col("f.url").alias("first_url"))
    joined = dealt.join(first, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("size") >= MIN_REVISIT)
    ready = joined.select("page_id", "url", "size", "digest", "row", F.when(revisit, "revisit").otherwise("response").alias("kind"),
                          F.when(revisit, F.col("first_id")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_url"),
                          F.when(~revisit, F.col("packed")).alias("packed"))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return staged(ready.mapInArrow(_write(folder, date), _CAPTURES), "warc-captures")


def _write_index(folder: str):
    """Per sorted partition: lines in compressed blocks, one directory row per block."""

    def run(batches):
        fs, path = filesystem(folder)
        name, out, at = f"{path}/index-{uuid.uuid4().hex}.cdx.gz", None, 0
        lines: list[str] = []
        rows: list[tuple] = []

        def flush():
            nonlocal out, at
            if lines:
                out = out or fs.open_output_stream(name, compression=None)
                member = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
                out.write(member)
                rows.append((lines[0].partition(" ")[0], lines[-1].partition(" ")[0], name, at, len(member)))
                at += len(member)
                lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                place = {k: r[k] for k in ("page_id", "row", "file", "offset", "length")}
                lines.append(r["key"] + " " + json.dumps(place, separators=(",", ":")))
                if len(lines) >= BLOCK_LINES:
                    flush()
        flush()
        if out is not None:
            out.close()
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["first_key", "last_key", "file", "offset", "length"])
    return run


def write_index(captures: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    """Two-level index of captures; returns the sparse directory ``(first_key, last_key, file, offset, length)``.

    Captures are range-partitioned by key and row name, so a url that a third
    of all captures share is spread over several parts.
    """
    parts = parts or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")
    return staged(ordered.mapInArrow(_write_index(folder),
                                     "first_key string, last_key string, file string, offset long, length long"), "warc-directory")


class Reader:
    """Lookups in one index part: binary search in the directory, then range reads."""

    def __init__(self, folder: str, directory: list[dict], kept: int = 4):
        self.fs, _ = filesystem(folder)
        self.directory = sorted(directory, key=lambda d: (d["first_key"], d["offset"]))
        self.firsts = [d["first_key"] for d in self.directory]
        self.files: OrderedDict = OrderedDict()
        self.blocks: OrderedDict = OrderedDict()
        self.kept = kept

    def read(self, file: str, offset: int, length: int) -> bytes:
        if file not in self.files:
            self.files[file] = self.fs.open_input_file(file)
            if len(self.files) > 64:
                self.files.popitem(last=False)[1].close()
        return gzip.decompress(self.files[file].read_at(length, offset))

    def block(self, k: int) -> list[tuple[str, str]]:
        if k not in self.blocks:
            d = self.directory[k]
            lines = self.read(d["file"], d["offset"], d["length"]).decode().split("\n")
            self.blocks[k] = [(key, rest) for key, _, rest in (x.partition(" ") for x in lines)]
            if len(self.blocks) > self.kept:
                self.blocks.popitem(last=False)
        return self.blocks[k]

    def lookup(self, key: str) -> list[dict]:
        """All captures of a key, over as many blocks as hold it."""
        out, k = [], max(0, bisect.bisect_left(self.firsts, key) - 1)
        while k < len(self.directory) and self.directory[k]["first_key"] <= key:
            lines = self.block(k)
            at = bisect.bisect_left(lines, (key, ""))
            while at < len(lines) and lines[at][0] == key:
                out.append(json.loads(lines[at][1]))
                at += 1
            k += 1
        return out

    def fetch(self, place: dict) -> tuple[dict[str, str], bytes]:
        return parse(self.read(place["file"], place["offset"], place["length"]))


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read_back(folder: str):
    """Per index part: look the wanted urls up, read and check their records."""

    def run(key, wanted: pa.Table, directory: pa.Table) -> pa.Table:
        reader = Reader(folder, directory.to_pylist())
        cols: list[list] = [[] for _ in range(6)]
        for url_sort_key in sorted(set(wanted["key"].to_pylist())) if wanted.num_columns else []:
            for place in reader.lookup(url_sort_key):
                fields, block = reader.fetch(place)
                payload = block.partition(b"\r\n\r\n")[2]
                size = int(re.search(rb"Content-Length: (\d+)", block)[1])
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"damaged record of page {place['page_id']}")
                refers = json.loads(fields["x-refers-to-page-id"]) if fields["warc-type"] == "revisit" else None
                for c, v in zip(cols, (json.loads(fields["x-page-id"]), json.loads(unquote(fields["x-page-url"])), size, digest,
                                       fields["warc-type"], refers)):
                    c.append(v)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.table({x.split()[0]: pa.array(c, k) for x, c, k in zip(_READ.split(", "), cols, kinds)})
    return run


def read_back(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Every capture of the given urls ``(url)`` by way of the index, one row per record.

    Wanted keys go to the index parts whose key range holds them: the range
    of each part (one per written index file) is the only thing the driver
    gathers, its blocks' directory goes to the part's task.
    """
    parts = directory.groupBy("file").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi")).collect()
    ranges = sorted((r["lo"], r["hi"], r["file"]) for r in parts)

    def places(batches):
        los = [x[0] for x in ranges]
        for batch in batches:
            keys, files = [], []
            for url in batch.column(0).to_pylist():
                key = url_key(url)
                k = bisect.bisect_right(los, key) - 1
                while k >= 0 and ranges[k][1] >= key:
                    keys.append(key)
                    files.append(ranges[k][2])
                    k -= 1
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(keys, pa.string())], names=["part", "key"])

    wanted = urls.select("url").mapInArrow(places, "part string, key string").distinct()
    of_part = directory.select(F.concat("file").alias("part"), "first_key", "file", "offset", "length")
    return wanted.groupBy("part").cogroup(of_part.groupBy("part")).applyInArrow(_read_back(folder), _READ)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page, index the archives, and read all records back through the index.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` and
    the url, one row per row of ``pages (page_id, url, html, ...)``. A null
    html is an empty payload; a null url is kept under a key of its own;
    repeated rows of one page are written each, none revisiting its own
    page_id; an empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    captures = write_archives(pages, folder)
    directory = write_index(captures, folder)
    return read_back(pages.select("url"), directory, folder)
