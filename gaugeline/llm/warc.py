"""WARC archives with a two-level capture index.

Archives hold one gzip member for each record, so a record can be read by its offset and length.
Of records with equal payloads the one with the smallest page id keeps the payload; the others
are revisits that name it.

The index has a line for each record, sorted by the URL with its host reversed (`com,example)/x`)
and then by page id. It is cut into shards by key range. A shard is a file of compressed blocks of
BLOCK lines, with a directory beside it that holds the first key and the place of each block. A
look-up is sent to the shard with its key, finds the block by binary search in the directory,
reads and unpacks that block only, finds the lines by binary search, and reads the record's bytes.

Files are named by task attempt and are only known through the rows that the attempt returned, so
a task that runs again leaves nothing behind that is read. They go to the folder given, which all
executors must share; pyarrow must be able to open it.

Defined cases: a null page is an empty payload. Payloads of fewer than REVISIT_BYTES bytes are
never revisits. A null URL has the key "-"; a URL that cannot be taken apart is its own key. Line
breaks and blanks in URLs are percent-encoded. Rows with a null page id can be revisits but are
never referred to, and sort first. Rows with equal page id and URL are separate records; a look-up
returns all of them.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections import OrderedDict
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm.common import settled
from gaugeline.session import scratch_path

REVISIT_BYTES = 100
BLOCK = 1000
LEVEL = 1
DATE = "2026-01-01T00:00:00Z"
#: Archives and unpacked blocks that a look-up task keeps open at most.
OPEN = 8

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
ENTRY = "key string, page_id long, file string, start long, size long"


def open_folder(path: str):
    """The file system of a folder, and the folder's path there."""
    return pyarrow.fs.FileSystem.from_uri(path)


def clean_url(url: str | None) -> str:
    return quote(url or "", safe="%/:?#[]@!$&'()*+,;=~-._") if url else ""


def reversed_host(url: str | None) -> str:
    """The key of a URL: host labels in reverse, port, path and query; without scheme and part."""
    url = clean_url(url)
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower().removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def entry_key(url: str | None, page_id: int | None) -> str:
    """Sorts by reversed host, then by page id; a null id sorts first."""
    number = "-" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{reversed_host(url)} {number}"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    text = (record_id or "none").strip("<>").rpartition(":")[2]
    return None if text == "none" else int(text)


def make_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record; with `refers_to`, a revisit without the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", clean_url(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    head += [("Content-Type", HTTP), ("Content-Length", str(len(body)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head).encode()
    return VERSION + lines + b"\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers of a record, its HTTP headers and its payload."""
    if not raw.startswith(VERSION):
        raise ValueError("not a WARC record")
    head, _, rest = raw[len(VERSION) :].partition(b"\r\n\r\n")

    def fields(block: bytes) -> dict[str, str]:
        pairs = (line.split(":", 1) for line in block.decode().split("\r\n") if ":" in line)
        return {name.strip().lower(): value.strip() for name, value in pairs}

    warc = fields(head)
    body = rest[: int(warc["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return {"warc": warc, "http": fields(http), "payload": payload}


def _packed(raw: bytes) -> bytes:
    gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return gzip.compress(raw) + gzip.flush()


def _attempt_name() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def with_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to). The smallest id for each payload is found by
    an aggregation with map-side combine; only payloads that occur again are joined back."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest")
    )
    again = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("times"))
        .filter("times > 1 and first is not null")
        .select("digest", "first")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(again, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("first").isNotNull() & other, F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, digest, refers_to) to archives, one for each task. Returns
    (key, page_id, file, start, size) of every record, written to the shared folder."""

    def run(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name = f"pages-{_attempt_name()}.warc.gz"
        at = 0
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            info = b"software: gaugeline\r\nformat: WARC File Format 1.1\r\n"
            head = (
                f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {DATE}\r\n"
                f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
            )
            at += out.write(_packed(VERSION + head.encode() + info + b"\r\n\r\n"))
            for batch in batches:
                columns = [
                    batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")
                ]
                keys, starts, sizes = [], [], []
                for row in zip(*columns):
                    page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                    packed = _packed(make_record(page_id, url, payload, digest, refers_to))
                    out.write(packed)
                    keys.append(entry_key(url, page_id))
                    starts.append(at)
                    sizes.append(len(packed))
                    at += len(packed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        columns[0].cast(pa.int64()),
                        pa.array([name] * len(keys), pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                    ],
                    names=["key", "page_id", "file", "start", "size"],
                )

    return settled(records.mapInArrow(run, ENTRY))


def write_index(entries: DataFrame, folder: str, shards: int | None = None) -> list[dict]:
    """Sort the entries into shards of compressed blocks, each with its directory. Returns first
    and last key and the file of every shard, in order; as many as `shards` at most."""
    spark = entries.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name = f"index-{_attempt_name()}"
        first = last = None
        lines: list[bytes] = []
        blocks: list[list] = []
        at = 0
        with files.open_output_stream(f"{root}/{name}.cdx.gz", compression=None) as out:

            def flush():
                nonlocal at
                if lines:
                    packed = _packed(b"".join(lines))
                    out.write(packed)
                    blocks.append([lines[0].partition(b"\t")[0].decode(), at, len(packed)])
                    at += len(packed)
                    lines.clear()

            for batch in batches:
                for row in batch.to_pylist():
                    first = row["key"] if first is None else first
                    last = row["key"]
                    place = json.dumps([row["page_id"], row["file"], row["start"], row["size"]])
                    lines.append(f"{row['key']}\t{place}\n".encode())
                    if len(lines) >= BLOCK:
                        flush()
            flush()
        if blocks:
            with files.open_output_stream(f"{root}/{name}.dir", compression=None) as out:
                out.write("".join(f"{k}\t{s}\t{n}\n" for k, s, n in blocks).encode())
            yield pa.RecordBatch.from_pydict({"first": [first], "last": [last], "file": [name]})

    written = (
        entries.repartitionByRange(shards, "key")
        .sortWithinPartitions("key", "file", "start")
        .mapInArrow(run, "first string, last string, file string")
    )
    return sorted((row.asDict() for row in settled(written).collect()), key=lambda s: s["first"].encode())


class _Kept(OrderedDict):
    """The last OPEN values made."""

    def get_or(self, key, make):
        if key not in self:
            if len(self) >= OPEN:
                old = self.popitem(last=False)[1]
                if hasattr(old, "close"):
                    old.close()
            self[key] = make()
        self.move_to_end(key)
        return self[key]


class Index:
    """Look-ups in the shards of an index, within a task."""

    def __init__(self, folder: str):
        self.files, self.root = open_folder(folder)
        self.directories, self.blocks, self.open = _Kept(), _Kept(), _Kept()

    def _directory(self, shard: str):
        def load():
            with self.files.open_input_stream(f"{self.root}/{shard}.dir", compression=None) as f:
                rows = [line.split(b"\t") for line in f.read().split(b"\n")[:-1]]
            return [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]

        return self.directories.get_or(shard, load)

    def _range(self, file: str, start: int, size: int) -> bytes:
        stream = self.open.get_or(
            file, lambda: self.files.open_input_file(f"{self.root}/{file}")
        )
        return stream.read_at(size, start)

    def _block(self, shard: str, number: int):
        def load():
            start, size = self._directory(shard)[1][number]
            raw = zlib.decompress(self._range(f"{shard}.cdx.gz", start, size), 31)
            lines = [line.split(b"\t") for line in raw.split(b"\n")[:-1]]
            return [x[0] for x in lines], [x[1] for x in lines]

        return self.blocks.get_or((shard, number), load)

    def entries(self, shard: str, key: bytes):
        """Places of all records with the key, in one shard."""
        firsts = self._directory(shard)[0]
        # equal keys may begin in the block before the first one that starts with the key
        number = max(bisect.bisect_left(firsts, key) - 1, 0)
        while number < len(firsts) and firsts[number] <= key:
            keys, places = self._block(shard, number)
            for at in range(bisect.bisect_left(keys, key), len(keys)):
                if keys[at] != key:
                    break
                yield json.loads(places[at])
            number += 1

    def record(self, file: str, start: int, size: int) -> dict:
        return parse_record(zlib.decompress(self._range(file, start, size), 31))


RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def look_up(keys: DataFrame, shards: list[dict], folder: str, payload: bool = True) -> DataFrame:
    """Records for distinct keys (column `key`). A record's payload is that in the archive: none
    for a revisit, whose length and digest come from its headers. Digests of payloads that are
    there are computed from the bytes and must agree with the header."""
    spark = keys.sparkSession
    if not shards:
        return spark.createDataFrame([], RECORD)
    firsts = [s["first"].encode() for s in shards]
    lasts = [s["last"].encode() for s in shards]

    def route(batches):
        for batch in batches:
            found, numbers = [], []
            for key in batch.column("key").to_pylist():
                raw = key.encode()
                for number in range(bisect.bisect_left(lasts, raw), bisect.bisect_right(firsts, raw)):
                    found.append(key)
                    numbers.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(numbers, pa.int32())],
                names=["key", "shard"],
            )

    def read(batches):
        index = Index(folder)
        for batch in batches:
            rows = []
            for key, shard in zip(*(batch.column(c).to_pylist() for c in ("key", "shard"))):
                for _, *place in index.entries(shards[shard]["file"], key.encode()):
                    rows.append(_row(index.record(*place), payload))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = (
                pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()
            )
            names = [part.split()[0] for part in RECORD.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    routed = keys.select("key").mapInArrow(route, "key string, shard int")
    return (
        routed.repartitionByRange(len(shards), "shard", "key")
        .sortWithinPartitions("shard", "key")
        .mapInArrow(read, RECORD)
    )


def _row(record: dict, payload: bool) -> tuple:
    warc = record["warc"]
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    size = int(record["http"]["content-length"])
    if warc["warc-type"] == "response":
        if hashlib.sha256(record["payload"]).hexdigest() != digest or len(record["payload"]) != size:
            raise ValueError(f"payload of {warc['warc-record-id']} does not agree with its headers")
    return (
        _page_id(warc["warc-record-id"]),
        warc.get("warc-target-uri") or None,
        warc["warc-type"],
        size,
        digest,
        _page_id(warc.get("warc-refers-to")),
        record["payload"] if payload else None,
    )


def key_of(url: Column, page_id: Column) -> Column:
    """`entry_key` of columns."""

    @F.udf("string", useArrow=True)
    def keyed(url, page_id):
        return entry_key(url, page_id)

    return keyed(url, page_id)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None):
    """Write pages as archives and index. Returns (entries, shards, folder)."""
    folder = folder or scratch_path(spark, "warc")
    entries = write_archives(with_revisits(pages), folder)
    return entries, write_index(entries, folder), folder
