"""WARC archives: a writer with payload deduplication and a Python data source.

Writer: every page is a record of its own gzip member, a ``response`` or, if an equal payload
has a response with a smaller page_id, a ``revisit`` that names it. The gzip header's extra
field ``sl`` holds the member's compressed and plain length, so readers can step over it.

Reader (``spark.read.format("warc")``): one partition a file, planned on the driver from the
folder's listing. Equality, IN and null predicates on warc_type and the other header
columns are pushed down. Of each record the headers are parsed first; if a predicate fails
the rest of the member is stepped over by its length, undecoded. The payload itself is decoded
only with the option ``payload`` set to true.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull
from pyspark.sql.types import StructType

from . import common

#: Plain bytes after which a task starts its next file.
ROLL_BYTES = 256_000_000
CHARS = 4_000_000
LEVEL = 3
#: Bytes read at a time.
BLOCK = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

SCHEMA = "record_id string, warc_type string, target_uri string, payload_digest string, refers_to string, payload_bytes long, payload binary"
#: Column of each header that predicates can name.
HEADERS = {"record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def bare_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return "<urn:page:unknown>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(column):
    """The page_id in a record id, null if it has none."""
    digits = F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(digits != "", digits.cast("long"))


def member(plain: bytes) -> bytes:
    """One gzip member with its own lengths in the extra field."""
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = squeeze.compress(plain) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit of refers_to without it."""
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{bare_digest(payload)}"))
    fields.append(("X-Payload-Length", str(len(payload))))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record for every row of pages (page_id, url, html); returns the manifest.

    The payload is the html in UTF-8; a null html counts as empty. Among payloads that are
    equal and have at least min_bytes bytes the rows with the smallest page_id are responses
    and all others revisit them; smaller payloads are always responses, and so are rows
    without a page_id, which nothing can refer to. Repeated rows each have a record.
    Manifest: file and records of each file; an empty table has none.
    """
    spark = pages.sparkSession
    common.ship(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"), html.alias("html"))
    digests = common.stored(rows.filter("page_id is not null").filter(F.length("html") >= min_bytes).select("page_id", F.unhex(F.sha1("html")).alias("digest")), f"{folder}/_digests")
    # the groups shrink to one row each before they meet; only members of larger ones go on
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = digests.join(firsts, "digest").filter("page_id <> first").select("page_id", "digest", "first").distinct()
    joined = rows.join(again.withColumnRenamed("page_id", "__page"), (F.col("page_id") == F.col("__page")) & (F.unhex(F.sha1("html")) == F.col("digest")), "left")
    # in a fixed order, so that a task that runs again writes the same files
    joined = joined.select("page_id", "url", "html", "first").sortWithinPartitions("page_id", "url", "html")

    def run(batches):
        context = TaskContext.get()
        fs, root = common.filesystem(folder)
        fs.create_dir(f"{root}/_tmp", recursive=True)
        out, plain, n, k, done = None, 0, 0, 0, []

        def name() -> str:
            return f"part-{context.partitionId():06d}-{k:04d}.warc.gz"

        def close() -> None:
            out.close()
            common.put_in_place(fs, f"{root}/_tmp/{name()}-{context.taskAttemptId()}", f"{root}/{name()}")
            done.append({"file": f"{folder}/{name()}", "records": n})

        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{root}/_tmp/{name()}-{context.taskAttemptId()}")
                data = record(page_id, url, payload, first)
                out.write(member(data))
                plain, n = plain + len(data), n + 1
                if plain >= ROLL_BYTES:
                    close()
                    out, plain, n, k = None, 0, 0, k + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return common.stored(joined.mapInArrow(run, "file string, records long"), f"{folder}/_manifest")


class Members:
    """Steps through the gzip members of a stream."""

    def __init__(self, stream):
        self.stream, self.buffer, self.start = stream, b"", 0

    def more(self) -> bool:
        data = self.stream.read(BLOCK)
        self.buffer += data
        return bool(data)

    def need(self, n: int) -> bool:
        """Whether n bytes follow the member's start; reads them."""
        while len(self.buffer) < self.start + n:
            if not self.more():
                return False
        return True

    def __iter__(self) -> Iterator[Member]:
        while True:
            if self.start >= BLOCK:
                self.buffer, self.start = self.buffer[self.start :], 0
            if not self.need(1):
                return
            if not self.need(18) or self.buffer[self.start : self.start + 3] != b"\x1f\x8b\x08":
                raise ValueError("no gzip member where one should be")
            length, at, flags = None, 10, self.buffer[self.start + 3]
            if flags & ~4:
                raise ValueError("a gzip header with other fields than extra ones")
            if flags & 4:
                (extra,) = struct.unpack_from("<H", self.buffer, self.start + 10)
                self.need(12 + extra)
                if extra >= 12 and self.buffer[self.start + 12 : self.start + 14] == b"sl":
                    (length,) = struct.unpack_from("<I", self.buffer, self.start + 16)
                at = 12 + extra
            item = Member(self, at)
            yield item
            item.leave(length)


class Member:
    """One member, decompressed as far as it is asked for."""

    def __init__(self, owner: Members, at: int):
        self.owner, self.position = owner, at
        self.plain = zlib.decompressobj(-15)
        self.text = bytearray()

    def fill(self) -> bool:
        """Decompress a further block; false at the member's end."""
        if self.plain.eof:
            return False
        if not self.owner.need(self.position + 1):
            raise ValueError("a gzip member breaks off")
        at = self.owner.start + self.position
        data = self.owner.buffer[at : at + (65536 if self.text else 1024)]
        self.text += self.plain.decompress(data)
        self.position += len(data) - len(self.plain.unused_data)
        return True

    def until(self, mark: bytes) -> int:
        """Where mark begins in the text."""
        while (at := self.text.find(mark)) < 0:
            if not self.fill():
                raise ValueError("a record without an end of its headers")
        return at

    def upto(self, n: int) -> None:
        while len(self.text) < n and self.fill():
            pass

    def leave(self, length: int | None) -> None:
        """Go to the next member: by its length if known, else by decompressing the rest."""
        owner = self.owner
        if length is None:
            while self.fill():
                self.text = bytearray(b"\0")
            length = self.position + 8
        if owner.start + length > len(owner.buffer):
            owner.stream.seek(owner.start + length - len(owner.buffer), io.SEEK_CUR)
            owner.buffer, owner.start = b"", 0
        else:
            owner.start += length


def parse_headers(text: bytes) -> dict[str, str]:
    """Header fields of a record by lower-case name; continuation lines are joined."""
    out: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def columns_of(fields: dict[str, str]) -> dict[str, str | None]:
    found = {c: fields.get(h) for c, h in HEADERS.items()}
    if found["payload_digest"]:
        found["payload_digest"] = found["payload_digest"].rpartition(":")[2]
    return found


class FilePart(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, files: list[str], payload: bool):
        self.files, self.payload = files, payload
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, IsNull | IsNotNull):
                self.tests.append((column, "null", isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self):
        return [FilePart(f) for f in self.files]

    def passes(self, found: dict[str, str | None]) -> bool:
        return all(found[c] in v and found[c] is not None if kind == "in" else (found[c] is None) == v for c, kind, v in self.tests)

    def read(self, partition: FilePart | None):
        if partition is None:  # what Spark passes where there is no partition
            return
        fs, path = common.filesystem(partition.path)
        schema = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, size = [], 0
        with fs.open_input_file(path) as stream:
            for item in Members(stream):
                end = item.until(b"\r\n\r\n")
                fields = parse_headers(bytes(item.text[:end]))
                found = columns_of(fields)
                if not self.passes(found):
                    continue
                length = int(fields.get("content-length", 0))
                row = {**found, "payload_bytes": int(fields["x-payload-length"]) if "x-payload-length" in fields else None, "payload": None}
                if self.payload and found["warc_type"] == "response":
                    item.upto(end + 4 + length)
                    block = bytes(item.text[end + 4 : end + 4 + length])
                    row["payload"] = block[block.find(b"\r\n\r\n") + 4 :]
                    if found["payload_digest"] and bare_digest(row["payload"]) != found["payload_digest"]:
                        raise ValueError(f"{found['record_id']}: wrong payload digest")
                rows.append(row)
                size += len(row["payload"] or b"")
                if len(rows) >= 2000 or size > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """Options: path (folder or file) and payload (true to decode payloads)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        from pyarrow import fs as pafs

        base = self.options["path"]
        fs, root = common.filesystem(base)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            files = [base]
        else:
            found = fs.get_file_info(pafs.FileSelector(root, recursive=False))
            files = sorted(f"{base.rstrip('/')}/{f.base_name}" for f in found if f.base_name.endswith((".warc.gz", ".warc")))
        return WarcReader(files, self.options.get("payload", "false").lower() == "true")


def read_warc(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """Records of every archive in folder; see SCHEMA."""
    common.ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the records of pages say after a round trip. A null html is an empty payload; repeated
    rows each come out, an empty table gives no row, other columns are ignored."""
    folder = common.shared_dir(spark)
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    found = read_warc(spark, folder, payload=True)
    return found.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))
