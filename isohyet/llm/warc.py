"""WARC archives as a PySpark data source.

``spark.read.format("warc")`` plans partitions over files (small ones together), takes predicates on
record_type, target_uri, payload_digest and page_id down to the reader, parses a record's headers first
and passes over the payload of a record that the predicates reject, without unpacking it: every gzip member
says in its header how long it is (an extra field that other readers ignore). The option ``payload`` is
true, false (payloads are passed over) or digest (they are read and checked against their header, not
returned). ``df.write.format("warc")`` writes one archive per task. Files are reached through pyarrow's file systems, so the path may be on any store
that the cluster shares.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from isohyet.llm import common

SCHEMA = "record_id string, record_type string, target_uri string, page_id long, payload_bytes long, payload_digest string, refers_to long, payload binary"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_PUSHED = {"record_type", "target_uri", "payload_digest", "page_id"}
_BLOCK = 1 << 16
#: Bytes unpacked at a time while a header is looked for.
_HEADER = 256


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes | None, payload_bytes: int, payload_digest: str, refers_to, compress: bool) -> bytes:
    """One WARC/1.1 record; ``payload`` is None for a revisit, whose block has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "X-Payload-Length": payload_bytes,
        "Content-Length": len(block),
    }
    if url is not None:
        head["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if payload is None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["X-Refers-To-Page-ID"] = refers_to
    data = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    return member(data) if compress else data


#: Flags and bytes of a gzip header (RFC 1952) with an extra field 'ML' of 8 bytes: the length of the whole member.
_HEAD = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0ML\x08\0"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return _HEAD + struct.pack("<Q", len(_HEAD) + 16 + len(body)) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Stream:
    """Forward reading of a file or, member by member, of a gzip file."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed, self.buffer = raw, packed, b""
        self.rest = b""  # packed bytes that were read but not unpacked
        self.unpacked = 0  # bytes
        self.unzip, self.ends = None, None  # the member that is open, and where it ends in the file if it says so

    def _more(self, most: int = 0) -> bool:
        """Add to the buffer: of a packed file, ``most`` unpacked bytes at most (0: all of a block)."""
        data = self.rest or self.raw.read(_BLOCK)
        self.rest = b""
        if not self.packed:
            self.buffer += data
            return bool(data)
        if not data and not self.unzip:
            return False
        if not self.unzip:
            if len(data) < len(_HEAD) + 8:
                data += self.raw.read(_BLOCK)
            self.unzip, self.ends = zlib.decompressobj(31), None
            if data.startswith(_HEAD):
                self.ends = self.raw.tell() - len(data) + struct.unpack_from("<Q", data, len(_HEAD))[0]
        found = self.unzip.decompress(data, most)
        if not data and not found and not self.unzip.eof:
            raise EOFError("archive ends inside a record")
        self.unpacked += len(found)
        self.buffer += found
        self.rest = self.unzip.unconsumed_tail
        if self.unzip.eof:
            self.rest, self.unzip = self.unzip.unused_data, None
        return True

    def head(self) -> list[str] | None:
        """Header lines up to the empty one; None at the end."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more(_HEADER):
                if self.buffer.strip():
                    raise EOFError("archive ends inside a header")
                return None
        head, self.buffer = self.buffer[:at], self.buffer[at + 4 :]
        return head.decode("utf-8", "replace").split("\r\n")

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            self.buffer = b""
            if not self._more():
                raise EOFError("archive ends inside a record")
            parts.append(self.buffer)
            have += len(self.buffer)
        data = b"".join(parts)
        self.buffer = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        """Pass over the n bytes up to the end of a record: by seeking in a plain file or to the end of a member
        that says where it ends, else by unpacking without keeping."""
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
            return
        if self.packed and self.unzip and self.ends:
            if self.ends > self.raw.size():
                raise EOFError("archive ends inside a record")
            at = self.raw.tell()
            if self.ends <= at:  # in the block that has been read
                self.rest = self.rest[len(self.rest) - (at - self.ends) :]
            else:
                self.raw.seek(self.ends)
                self.rest = b""
            self.buffer, self.unzip = b"", None
            return
        n -= len(self.buffer)
        self.buffer = b""
        if not self.packed:
            end = self.raw.size()
            if self.raw.tell() + n > end:
                raise EOFError("archive ends inside a record")
            self.raw.seek(n, io.SEEK_CUR)
            return
        while n > len(self.buffer):
            n -= len(self.buffer)
            self.buffer = b""
            if not self._more():
                raise EOFError("archive ends inside a record")
        self.buffer = self.buffer[n:]


def records(raw, packed: bool, wanted, payloads: str):
    """Rows of SCHEMA for the records whose headers ``wanted`` accepts. An archive that ends early is an EOFError, a
    payload that is not what its header says (``payloads`` other than 'false') a ValueError."""
    stream = _Stream(raw, packed)
    while (lines := stream.head()) is not None:
        while lines and not lines[0]:
            lines = lines[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not head.get("content-length", "").isdigit():
            raise ValueError("a record's header has no length")
        length = int(head["content-length"])
        own = lambda k: int(head[k]) if k in head else None
        row = {
            "record_id": head.get("warc-record-id"),
            "record_type": head.get("warc-type"),
            "target_uri": head.get("warc-target-uri"),
            "page_id": own("x-page-id"),
            "payload_bytes": own("x-payload-length"),
            "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": own("x-refers-to-page-id"),
            "payload": None,
        }
        if not wanted(row):
            stream.skip(length + 4)
            continue
        if payloads != "false" and row["record_type"] == "response":
            block = stream.take(length)
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            said, row["payload_digest"], row["payload_bytes"] = row["payload_digest"], digest(payload), len(payload)
            if said not in (None, row["payload_digest"]):
                raise ValueError(f"payload of {row['record_id']} has another digest than its header says")
            row["payload"] = payload if payloads == "true" else None
            stream.skip(4)
        else:
            stream.skip(length + 4)
        yield row


@dataclass
class Files(InputPartition):
    paths: list[str] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(self.paths)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payloads = options["path"], options.get("payload", "true")
        self.together = int(options.get("partitionbytes", 32 << 20))
        self.tests: list[tuple[str, set]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in _PUSHED and isinstance(f, EqualTo):
                self.tests.append((column, {f.value}))
            elif column in _PUSHED and isinstance(f, In):
                self.tests.append((column, set(f.value)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, root = _fs(self.path)
        found = sorted((i.path, i.size) for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)) if i.is_file and ".warc" in i.base_name and not i.base_name.startswith((".", "_")))
        parts, size = [Files([])], 0
        for path, n in found:
            if parts[-1].paths and size + n > self.together:
                parts.append(Files([]))
                size = 0
            parts[-1].paths.append(path)
            size += n
        return parts

    def read(self, partition):
        import pyarrow as pa

        store, _ = _fs(self.path)
        tests, kinds = self.tests, pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in SCHEMA.split(", "))])
        wanted = lambda row: all(row[c] in values for c, values in tests)
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                rows, size = [], 0
                for row in records(raw, path.endswith(".gz"), wanted, self.payloads):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)


@dataclass
class Written(WriterCommitMessage):
    path: str
    name: str


class WarcWriter(DataSourceWriter):
    """Takes page_id, url, html, payload_digest, refers_to. A task writes to a name of its own and the commit
    gives it the final one, so a retried or lost task leaves no half archive among the results; what such tasks
    have left goes when the job ends."""

    def __init__(self, options, overwrite):
        self.path, self.compress, self.overwrite = options["path"], options.get("compression", "gzip") == "gzip", overwrite
        self.job = uuid.uuid4().hex

    def write(self, rows):
        from pyspark import TaskContext

        store, root = _fs(self.path)
        name = f"part-{self.job}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc" + ".gz" * self.compress
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/.{name}", compression=None) as out:
            for row in rows:
                payload = (row["html"] or "").encode()
                out.write(record(row["page_id"], row["url"], None if row["revisit"] else payload, len(payload), digest(payload), row["refers_to"], self.compress))
        return Written(root, name)

    def commit(self, messages):
        store, root = _fs(self.path)
        if self.overwrite:
            from pyarrow import fs

            for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if i.is_file and ".warc" in i.base_name and not i.base_name.startswith("."):
                    store.delete_file(i.path)
        for m in messages:
            if m:
                store.move(f"{m.path}/.{m.name}", f"{m.path}/{m.name}")
        self._clean(store, root)

    def abort(self, messages):
        self._clean(*_fs(self.path))

    def _clean(self, store, root):
        from pyarrow import fs

        for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if i.base_name.startswith(f".part-{self.job}-"):
                store.delete_file(i.path)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, *, least_bytes: int = 0, broadcast_rows: int = 500_000) -> DataFrame:
    """page_id, url, html, revisit, refers_to: which pages repeat a payload of at least ``least_bytes``.

    Of rows with equal payloads those with the largest page_id are responses, all others revisit it; a
    null id sorts below all others, and where no row of a group has an id all are responses. A null html
    is an empty payload. Repeated rows are decided alike. Payloads stay where they are if at most
    ``broadcast_rows`` of them (40 bytes of digest and an id each) occur more than once.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    keyed = source.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    light = keyed.where(F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null")
    light = common.materialise(light.select(F.col("sha").alias("g_sha"), "top"), "payloads")
    if light.count() <= broadcast_rows:
        light = F.broadcast(light)
    found = keyed.join(light, F.col("sha") == F.col("g_sha"), "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return found.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("top")).alias("refers_to"))


def write_pages(pages: DataFrame, path: str, *, compression: str = "gzip", least_bytes: int = 0) -> None:
    """Write every row of ``pages`` as a response or revisit record under ``path``; empty tables write nothing."""
    register(pages.sparkSession)
    with_revisits(pages, least_bytes=least_bytes).write.format("warc").mode("append").option("compression", compression).save(path)


def read_archives(spark: SparkSession, path: str, *, payload: bool | str = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back: one row per page.

    Lengths and digests of responses are those of the payload as read, those of revisits are from their headers.
    """
    spark = pages.sparkSession
    path = common.new_path(spark, "warc")
    write_pages(pages, path)
    return read_archives(spark, path, payload="digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
