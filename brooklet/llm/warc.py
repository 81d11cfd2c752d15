"""WARC archives of pages, with a two-level capture index.

Archives: every record is a gzip member of its own, so one range read fetches it. Of
pages with equal payloads the smallest page_id is stored as ``response``, the others as
``revisit`` records that refer to it and carry no payload.

Index: a capture's key is its URL with the host reversed, and its page_id. All captures,
sorted by key over the whole table, are written as compressed blocks of ``BLOCK``
entries, one index file per range of keys. Each index file ends with a sparse directory
of its blocks (first key, place), and the list of files (first key, place of the
directory) is a small table. A lookup searches three sorted lists, by bisection: files,
the blocks of one file, the entries of one block; then it reads one record.

Files are written by tasks, under names that no other attempt uses; a file counts once
its rows are in the captures or files table, so a lost task leaves at most an unused file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import slices

BLOCK = 512
ARCHIVE_BYTES, READ_BYTES = 1 << 30, 64 << 20
LEVEL = 4
OPEN_FILES = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- keys and records


def capture_key(url: str | None, page_id: int | None) -> str:
    """The URL with reversed host, then page_id so that keys sort by both."""
    url = url or ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        host, port, parts = "", None, None
    if host:
        where = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
        rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        url = f"{where}){rest}" + (f"#{parts.fragment}" if parts.fragment else "")
    number = 0 if page_id is None else page_id + (1 << 63) + 1
    return f"{url} {number:020d}"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _escaped(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """A WARC record; a revisit where it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {_escaped(url)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    """What a WARC record says. ``payload`` is None for a revisit."""

    page_id: int | None
    record_type: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    refers_to: int | None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}


def _page(name: str | None) -> int | None:
    return int(name[10:-1]) if name and name.startswith("<urn:page:") else None


def parse(data: bytes) -> Record:
    """The record in a gzip member; its payload is held against its digest."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"][5:]
    revisit = fields["warc-type"] == "revisit"
    if not revisit:
        found = base32(hashlib.sha1(payload).digest())
        if len(payload) != size or found != digest:
            raise ValueError(f"record {fields['warc-record-id']}: payload differs from its digest")
    return Record(
        _page(fields["warc-record-id"]), fields["warc-type"], None if revisit else payload, size, digest,
        _page(fields.get("warc-refers-to")),
    )


# ---------------------------------------------------------------- files


def filesystem(path: str) -> tuple[FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class Reader:
    """Range reads; keeps some files open."""

    def __init__(self, root: str) -> None:
        self.store, self.root = filesystem(root)
        self.files: dict[str, object] = {}

    def __call__(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= OPEN_FILES:
                self.close()
            self.files[name] = self.store.open_input_file(f"{self.root}/{name}")
        return self.files[name].read_at(length, offset)

    def close(self) -> None:
        for file in self.files.values():
            file.close()
        self.files.clear()


class Writer:
    """Files of about ``limit`` bytes under new names; ``put`` gives name and offset."""

    def __init__(self, root: str, suffix: str, limit: int = ARCHIVE_BYTES) -> None:
        self.store, self.root = filesystem(root)
        self.suffix, self.limit, self.file = suffix, limit, None
        self.store.create_dir(self.root, recursive=True)

    def put(self, data: bytes) -> tuple[str, int]:
        if self.file is None or self.at >= self.limit:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.file = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
        place = self.name, self.at
        self.file.write(data)
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


CAPTURE = "key string, page_id bigint, url string, file string, offset long, length long"
INDEX_FILE = "first string, file string, offset long, length long"


def _whole(value: str | None) -> int | None:
    """A number that came as text: pandas would round a long beside a null."""
    return None if value is None else int(value)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows with whole numbers or None, which pandas would otherwise make floating."""
    out = pd.DataFrame(rows, columns=names, dtype=object)
    return out.astype({c: "Int64" for c in names if c in ("page_id", "refers_to", "payload_bytes", "offset", "length")})


def _write_records(root: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Writer(root, ".warc.gz")
        try:
            for batch in slices(batches):
                rows = []
                for page_id, url, html, sha1, first in zip(
                    *(batch[c] for c in ("page_id", "url", "text", "sha1", "first")), strict=True
                ):
                    page_id, first = _whole(page_id), _whole(first)
                    digest = base32(bytes.fromhex(sha1))
                    refers_to = first if first is not None and page_id is not None and first < page_id else None
                    data = _gzip(record(page_id, url, html.encode(), digest, refers_to))
                    rows.append((capture_key(url, page_id), page_id, url, *out.put(data), len(data)))
                yield _frame(rows, ["key", "page_id", "url", "file", "offset", "length"])
        finally:
            out.close()

    return write


def _write_index(root: str, block: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, directory, entries = Writer(root, ".index", limit=1 << 62), [], []

        def flush() -> None:
            data = zlib.compress("\n".join(json.dumps(e) for e in entries).encode(), LEVEL)
            _, at = out.put(data)
            directory.append((entries[0][0], at, len(data)))
            entries.clear()

        try:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    entries.append((row.key, row.file, int(row.offset), int(row.length)))
                    if len(entries) == block:
                        flush()
            if entries:
                flush()
            if directory:
                data = zlib.compress(json.dumps(directory).encode(), LEVEL)
                name, at = out.put(data)
                row = (directory[0][0], name, at, len(data))
                yield pd.DataFrame([row], columns=["first", "file", "offset", "length"])
        finally:
            out.close()

    return write


def entries_of(read: Reader, files: list[tuple[str, str, int, int]]):
    """A function from a key to its entries; remembers the file and block it saw last."""
    firsts = [f[0] for f in files]
    seen = {"file": None, "block": None}

    def find(key: str) -> Iterator[tuple[str, str, int, int]]:
        at = bisect_right(firsts, key) - 1
        if at < 0:
            return
        _, name, offset, length = files[at]
        if seen["file"] != name:
            directory = json.loads(zlib.decompress(read(name, offset, length)))
            seen.update(file=name, directory=directory, starts=[d[0] for d in directory], block=None)
        # Equal keys may go on over blocks: start left of the first block that begins with it.
        block = max(0, bisect_left(seen["starts"], key) - 1)
        while block < len(seen["starts"]) and seen["starts"][block] <= key:
            if seen["block"] != block:
                _, offset, length = seen["directory"][block]
                lines = zlib.decompress(read(name, offset, length)).decode().split("\n")
                entries = [json.loads(line) for line in lines]
                seen.update(block=block, entries=entries, keys=[e[0] for e in entries])
            low, high = bisect_left(seen["keys"], key), bisect_right(seen["keys"], key)
            yield from seen["entries"][low:high]
            block += 1

    return find


def _lookup(archives: str, index: str, files: list[tuple[str, str, int, int]], payloads: bool):
    def lookup(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read, read_index = Reader(archives), Reader(index)
        find = entries_of(read_index, files)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        try:
            for batch in batches:
                rows = []
                for key, url in zip(batch["key"], batch["url"], strict=True):
                    for _, file, offset, length in find(key):
                        r = parse(read(file, offset, length))
                        row = (r.page_id, url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                        rows.append((*row, r.payload) if payloads else row)
                yield _frame(rows, [*names, "payload"][: 6 + payloads])
        finally:
            read.close()
            read_index.close()

    return lookup


# ---------------------------------------------------------------- operator


class Archive:
    """WARC files, capture index and captures table in folder ``path``, which executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def write(self, pages: DataFrame, least_bytes: int = 0, block: int = BLOCK) -> Archive:
        """Store every row of ``pages`` (page_id, url, html; other columns are not looked at).

        A null html is an empty payload. Payloads of fewer than ``least_bytes`` bytes are
        all responses. A row without page_id is always a response. Rows that repeat a
        page_id are records of their own; with the same payload both are responses.
        A null url has the empty key. An empty table makes an empty archive.
        """
        rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("text"))
        rows = rows.withColumn("sha1", F.sha1("text"))
        firsts = rows.filter(F.octet_length("text") >= least_bytes).groupBy("sha1")
        firsts = firsts.agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        firsts.filter("first < last").select("sha1", "first").write.parquet(f"{self.path}/firsts")
        # From files on both sides: a payload that very many pages share can be split.
        shared = self.spark.read.parquet(f"{self.path}/firsts")
        numbers = (F.col(c).cast("string").alias(c) for c in ("page_id", "first"))
        marked = rows.join(shared, "sha1", "left").select("url", "text", "sha1", *numbers)
        captures = marked.mapInPandas(_write_records(f"{self.path}/archives"), CAPTURE)
        captures.write.parquet(f"{self.path}/captures")
        sorted_ = self.captures().repartitionByRange("key").sortWithinPartitions("key", "file", "offset")
        files = sorted_.mapInPandas(_write_index(f"{self.path}/index", block), INDEX_FILE)
        files.write.parquet(f"{self.path}/files")
        return self

    def captures(self) -> DataFrame:
        return self.spark.read.schema(CAPTURE).parquet(f"{self.path}/captures")

    def files(self) -> list[tuple[str, str, int, int]]:
        """The top of the index: a row per index file, of which a write makes one per shuffle partition."""
        rows = self.spark.read.schema(INDEX_FILE).parquet(f"{self.path}/files").collect()
        return sorted(tuple(row) for row in rows)

    def lookup(self, wanted: DataFrame, payloads: bool = True) -> DataFrame:
        """The records of the captures ``wanted`` (page_id, url), read from the archives.

        page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the
        payload (null for revisits) if asked for. Each capture is sought once however
        often it is asked for; captures that are not stored give no row. Lookups are
        dealt out and sorted by key, so a task walks through neighbouring blocks.
        """
        key = F.pandas_udf(_key_series, "string")
        keys = wanted.select(F.col("page_id").cast("string").alias("page_id"), "url").distinct()
        keys = keys.withColumn("key", key("page_id", "url"))
        # As many tasks as the archives ask for: what they read is not in the keys' size.
        stored = self.captures().agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        tasks = max(self.spark.sparkContext.defaultParallelism, math.ceil(stored / READ_BYTES))
        dealt = keys.repartitionByRange(tasks, "key").sortWithinPartitions("key").select("key", "url")
        schema = "page_id bigint, url string, payload_bytes long, payload_digest string, record_type string, refers_to bigint"
        paths = f"{self.path}/archives", f"{self.path}/index"
        read = _lookup(*paths, self.files(), payloads)
        return dealt.mapInPandas(read, schema + (", payload binary" if payloads else ""))

    def read_all(self, payloads: bool = False) -> DataFrame:
        """Every record of the archives, through the index."""
        return self.lookup(self.captures(), payloads)


def _key_series(page_id: pd.Series, url: pd.Series) -> pd.Series:
    keys = [capture_key(u, _whole(i)) for i, u in zip(page_id, url, strict=True)]
    return pd.Series(keys, dtype="object")
